"""Profiles and features on edge tables: zero variance, nulls, constants."""
import pytest
from pyspark.sql import functions as F

from rarelab.functions.quantile import exact_percentile
from rarelab.operators.features import fit_scaler, one_hot
from rarelab.operators.ordered import dense_position, running_sum
from rarelab.operators.profile import class_histogram, correlation_long


def test_zero_variance_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, 1.0), (3.0, 5.0, 2.0)], "a double, c double, n double")
    r = {(x["feature_a"], x["feature_b"]): x["r"] for x in correlation_long(df, ["a", "c", "n"]).collect()}
    assert r[("a", "c")] is None
    assert r[("a", "n")] == pytest.approx(1.0)  # pairwise complete: the null row is skipped


def test_one_hot_null_is_all_zero(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, c string")
    out = {r["id"]: (r["c_x"], r["c_y"]) for r in one_hot(df, ["c"]).collect()}
    assert out == {1: (1, 0), 2: (0, 0), 3: (0, 1)}


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0), (6.0, 2.0)], "a double, k double")
    sc = fit_scaler(df, ["a", "k"])
    m, s = sc.stats["a"]
    assert m == pytest.approx(3.0) and s == pytest.approx((14 / 4) ** 0.5)
    assert all(r["k"] == 0.0 for r in sc.transform(df).collect())  # zero std scales by 1


def test_histogram_constant_class_centred(spark):
    df = spark.createDataFrame([(True, 4.0)] * 3 + [(False, 1.0), (False, 11.0)], "c boolean, v double")
    h = {(r["c"], r["bin"]): r["count"] for r in class_histogram(df, "v", "c").collect()}
    assert h[(True, 5)] == 3 and sum(v for (c, _), v in h.items() if c) == 3
    assert h[(False, 0)] == 1 and h[(False, 9)] == 1 and len(h) == 20


def test_exact_percentile_matches_numpy(spark):
    import numpy as np
    vals = [float(x) for x in np.random.default_rng(0).integers(0, 1000, 5000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for p in (0.0, 0.25, 0.92, 1.0):
        assert exact_percentile(df, "x", p, accuracy=100) == pytest.approx(float(np.quantile(vals, p)))


def test_running_sum_many_buckets_with_hot_value(spark):
    rows = [(i % 2, 7 if i % 3 else i, i) for i in range(3000)]  # value 7 holds two thirds
    df = spark.createDataFrame(rows, "g int, v int, k int").withColumn("one", F.lit(1).cast("bigint"))
    out = running_sum(df, ["g"], ["v", "k"], ["one"], rows_per_bucket=100).collect()
    exp = {}
    for g in (0, 1):
        srt = sorted([r for r in rows if r[0] == g], key=lambda r: (r[1], r[2]))
        exp.update({r[2]: i + 1 for i, r in enumerate(srt)})
    assert all(r["cum_one"] == exp[r["k"]] for r in out)
    pos = dense_position(df, ["v", "k"], rows_per_bucket=64).select("pos").collect()
    assert sorted(r["pos"] for r in pos) == list(range(3000))


def test_exact_percentile_heavy_ties(spark, monkeypatch):
    import numpy as np
    import rarelab.functions.quantile as qm
    monkeypatch.setattr(qm, "FETCH_ROWS", 50)  # force the per-value path
    vals = [0.0] * 4000 + [float(x) for x in np.random.default_rng(1).integers(1, 500, 2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for p in (0.1, 0.5, 0.66, 0.67, 0.92):
        assert qm.exact_percentile(df, "x", p) == pytest.approx(float(np.quantile(vals, p)))


def test_describe_and_key_profile(spark):
    import numpy as np
    from rarelab.operators.profile import describe, key_profile
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)] + [(99, None)], "id long, x double")
    d = describe(df, "x").first()
    assert d["count"] == 8 and d["mean"] == pytest.approx(np.mean(vals))
    assert d["std"] == pytest.approx(np.std(vals, ddof=1))  # sample std, as a describe reports
    for col, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert d[col] == pytest.approx(float(np.quantile(vals, p)))
    kp = {r["column"]: r for r in key_profile(df.withColumn("dup", F.col("id") % 3), "id", "dup").collect()}
    assert kp["id"]["is_unique"] and (kp["id"]["min_value"], kp["id"]["max_value"]) == (0, 99)
    assert not kp["dup"]["is_unique"] and kp["dup"]["n_distinct"] == 3
