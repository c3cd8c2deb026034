"""Property test: range-bucketed running sums equal a brute-force ordering."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rarelab.operators.ordered import running_sum

rows_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(-5, 5)), min_size=1, max_size=300)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, per_bucket=st.sampled_from([16, 40, 10**6]))
def test_running_sum_matches_brute_force(spark, rows, per_bucket):
    data = [(g, v, i, w) for i, (g, v, w) in enumerate(rows)]  # i: unique tie-break key
    df = spark.createDataFrame(data, "g int, v int, k int, w int").withColumn("w", F.col("w").cast("bigint"))
    got = {r["k"]: r["cum_w"] for r in running_sum(df, ["g"], ["v", "k"], ["w"],
                                                    rows_per_bucket=per_bucket).collect()}
    exp = {}
    for g in {r[0] for r in data}:
        acc = 0
        for r in sorted((r for r in data if r[0] == g), key=lambda r: (r[1], r[2])):
            acc += r[3]
            exp[r[2]] = acc
    assert got == exp


def test_groups_over_many_partitions(spark):
    """A group that fills most partitions, groups within one, null groups, doubles, nulls among the summed values."""
    rows = [(None if i % 50 == 0 else "hot" if i % 3 else f"g{i % 11}", i % 7, i, float(i % 5), None if i % 13 == 0 else i)
            for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v int, k int, x double, w int").withColumn("__b", F.lit("kept"))
    out = running_sum(df.drop("__b"), ["g"], ["v", "k"], ["x", "w"], rows_per_bucket=90)
    assert out.columns == ["g", "v", "k", "x", "w", "cum_x", "cum_w"] and dict(out.dtypes)["cum_w"] == "bigint"
    got = {r["k"]: (r["cum_x"], r["cum_w"]) for r in out.collect()}
    want, acc = {}, {}
    for g, v, k, x, w in sorted(rows, key=lambda r: (r[1], r[2])):
        a, b = acc.get(g, (0.0, 0))
        acc[g] = want[k] = (a + x, b + (w or 0))
    assert got == want


def test_no_rows_and_one_row(spark):
    df = spark.createDataFrame([], "g int, k int, w bigint")
    assert running_sum(df, ["g"], ["k"], ["w"]).collect() == []
    one = spark.createDataFrame([(1, 2, 3)], "g int, k int, w bigint")
    assert [tuple(r) for r in running_sum(one, [], ["k"], ["w"]).collect()] == [(1, 2, 3, 3)]
