"""Resampling: worked counts, segment property, refusal of impossible targets."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from rarelab.operators import resample
from rarelab.operators.cuts import hash_cuts
from rarelab.operators.resample import over_under, smote, undersample
from rarelab.operators.splits import stratified_folds


def _frame(spark, n_maj=735, n_min=65):
    rows = [(i, False, float(i % 97)) for i in range(n_maj)] + \
           [(n_maj + i, True, 200.0 + (i * 7) % 31) for i in range(n_min)]
    return spark.createDataFrame(rows, "entity_id long, label boolean, x double")


def _counts(df):
    return {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}


def test_worked_counts(spark):
    df = _frame(spark)
    assert _counts(smote(df, ["x"], k=5)) == {False: 735, True: 735}
    assert _counts(smote(df, ["x"], ratio=0.1, k=5)) == {False: 735, True: 73}
    assert _counts(over_under(df, ["x"], 0.1, 0.5, k=5)) == {False: 146, True: 73}
    assert _counts(over_under(df, ["x"], 0.1, 1.0, k=5)) == {False: 73, True: 73}


def test_synthetic_points_on_segments(spark):
    df = _frame(spark)
    out = smote(df, ["x"], ratio=0.5, k=3).where("is_synthetic")
    lo, hi = df.where("label").agg(F.min("x"), F.max("x")).first()
    rows = out.collect()
    assert len(rows) == int(735 * 0.5) - 65
    assert all(lo <= r["x"] <= hi for r in rows)
    assert all(r["label"] for r in rows) and all(r["entity_id"] < 0 for r in rows)


def test_deterministic(spark):
    df = _frame(spark)
    a = sorted(tuple(r) for r in smote(df, ["x"], ratio=0.2, k=4).collect())
    b = sorted(tuple(r) for r in smote(df.repartition(5), ["x"], ratio=0.2, k=4).collect())
    assert a == b


def test_impossible_targets_raise(spark):
    df = _frame(spark)
    with pytest.raises(ValueError):
        smote(df, ["x"], ratio=0.01, k=5)  # would remove minority rows
    with pytest.raises(ValueError):
        smote(df, ["x"], k=65)  # k above minority - 1
    with pytest.raises(ValueError):
        undersample(df, 0.05)  # needs more majority rows than exist


def test_undersample_keeps_minority_and_ratio(spark):
    df = _frame(spark)
    out = undersample(df, 0.5, seed=3)
    assert _counts(out) == {False: 130, True: 65}
    assert out.where("label").count() == 65


def test_per_split(spark):
    df = _frame(spark).withColumn("split_id", F.col("entity_id") % 2)
    out = smote(df, ["x"], ratio=0.1, k=3, split="split_id")
    c = {(r["split_id"], r["label"]): r["count"] for r in out.groupBy("split_id", "label").count().collect()}
    for s in (0, 1):
        n_maj = df.where(f"split_id = {s} and not label").count()
        assert c[(s, True)] == int(n_maj * 0.1)


def test_grid_equals_per_config(spark):
    from rarelab.operators.resample import resample_grid
    df = _frame(spark).withColumn("split_id", (F.col("entity_id") % 3).cast("int"))
    configs = [dict(over_ratio=0.1, over_k=2, under_ratio=0.5), dict(over_ratio=0.3, over_k=4, under_ratio=1.0),
               dict(over_ratio=None, over_k=3, under_ratio=None)]
    grid = resample_grid(df, ["x"], configs, split="split_id")
    cols = ["split_id", "entity_id", "label", "x", "is_synthetic"]
    for i, c in enumerate(configs):
        one = smote(df, ["x"], ratio=c["over_ratio"], k=c["over_k"], split="split_id")
        if c["under_ratio"] is not None:
            one = undersample(one, c["under_ratio"], split="split_id")
        a = sorted(tuple(r) for r in grid.where(F.col("config") == i).select(*cols).collect())
        b = sorted(tuple(r) for r in one.select(*cols).collect())
        assert a == b, i


def test_members_equal_resampled_copies(spark):
    """What rows list is what resampling copied training rows gives, for every configuration and split."""
    rng = np.random.default_rng(6)
    rows = [(i, bool(i % 5 == 0), float(rng.integers(0, 15)), float(rng.normal())) for i in range(150)]
    df = spark.createDataFrame(rows, "entity_id long, label boolean, x double, z double")
    folds = stratified_folds(df, "label", "entity_id", 4, seed=2, n_repeats=2)
    copies = folds.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(3)))).where("g <> fold").withColumn(
        "split_id", F.col("repeat") * 4 + F.col("g"))
    configs = [dict(over_ratio=0.4, over_k=3, under_ratio=0.9), dict(over_ratio=None, over_k=4, under_ratio=None),
               dict(over_ratio=0.5, over_k=1, under_ratio=0.6)]
    for features in (["x"], ["x", "z"]):
        want = resample.resample_grid(copies, features, configs, seed=7, split="split_id")
        want = {(r["config"], r["split_id"], r["entity_id"], r["label"], *(round(r[f], 9) for f in features)) for r in want.collect()}
        got = set()
        for r in resample.resampled_members(folds, 4, features, configs, seed=7).collect():
            for m in r["__in"]:
                row = (m // 4, r["repeat"] * 4 + m % 4, r["entity_id"], r["label"], *(round(r[f], 9) for f in features))
                assert row not in got
                got.add(row)
        assert got == want
    members = resample.resampled_members(folds, 4, ["x"], configs[:1], seed=7)
    assert members.where("entity_id >= 0").count() <= 300  # a row once per repeat


def test_members_refuse_as_resampling_does(spark):
    df = spark.createDataFrame([(i, i < 8, float(i)) for i in range(60)], "entity_id long, label boolean, x double")
    folds = stratified_folds(df, "label", "entity_id", 4)
    for config, message in ((dict(over_ratio=0.01), "remove minority"), (dict(over_ratio=0.5, over_k=9), "more minority"),
                            (dict(over_ratio=0.5, under_ratio=0.1), "cannot be met")):
        with pytest.raises(ValueError, match=message):
            resample.resampled_members(folds, 4, ["x"], [config])


@pytest.mark.parametrize("distinct", [True, False])
def test_hash_cuts_are_exact(spark, distinct):
    """Unique keys, and keys that repeat so that the bracket fails and is widened."""
    rows = [(g, i if distinct else i % 2) for g in range(3) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, __k long").withColumn("__h", F.md5(F.concat_ws(":", "g", "__k")))
    want = spark.createDataFrame([(0, 400, 1), (1, 400, 200), (2, 400, 400), (3, 0, 0)], "g int, n long, take long")
    cuts = {r["g"]: (r["__cut_h"], r["__cut_k"]) for r in hash_cuts(df, ["g"], want).collect()}
    ordered = {g: sorted((r["__h"], r["__k"]) for r in df.where(F.col("g") == g).collect()) for g in range(3)}
    assert cuts == {0: ordered[0][0], 1: ordered[1][199], 2: ordered[2][399]}


def test_draws_are_not_sent_to_every_task(spark):
    """Counts that expand look like a few rows to Spark; the points drawn must not be broadcast."""
    plan = spark.createDataFrame([(0, 40, 50_000, 3)], "split_id int, n_min bigint, n_new bigint, __k int")
    bases = spark.range(40).select(F.lit(0).alias("split_id"), F.col("id").alias("__i"), F.array(F.col("id").cast("double")).alias("__base"),
                                   F.array_repeat(F.array(F.lit(1.0)), 3).alias("__near"))
    points = resample.synthetic_points(plan, bases, ["split_id"], 1)
    assert points.count() == 50_000
    assert "Broadcast" not in points._jdf.queryExecution().executedPlan().toString()


def test_hash_cuts_of_groups_that_share_rows(spark):
    """Several cuts of the same rows, found without a copy of the rows for each; brackets that overlap or fail."""
    for distinct in (True, False):
        rows = spark.createDataFrame([(s, i if distinct else i % 2) for s in range(3) for i in range(400)], "s int, __k long").withColumn(
            "__h", F.md5(F.concat_ws(":", "s", "__k")))
        takes = [(c, s, 400, t) for s in range(3) for c, t in enumerate((1, 150, 155, 200, 399, 400, 0))]
        want = spark.createDataFrame(takes, "config int, s int, n long, take long")
        copies = rows.withColumn("config", F.explode(F.sequence(F.lit(0), F.lit(6))))
        one = {tuple(r) for r in hash_cuts(copies, ["config", "s"], want).select("config", "s", "__cut_h", "__cut_k").collect()}
        shared = {tuple(r) for r in hash_cuts(rows, ["config", "s"], want, ["s"]).select("config", "s", "__cut_h", "__cut_k").collect()}
        assert one == shared and len(one) == 18


def test_cuts_meet_the_rows_where_they_lie(spark):
    """Joined by repeat (or split), as many tasks as there are repeats would hash every majority row."""
    df = spark.createDataFrame([(i, i < 20, float(i)) for i in range(200)], "entity_id long, label boolean, x double")
    folds = stratified_folds(df, "label", "entity_id", 4, n_repeats=2, seed=1)
    members = resample.resampled_members(folds, 4, ["x"], [dict(over_ratio=0.2, over_k=3, under_ratio=0.5)])
    plan = members._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line and "repeat#" in line]
    assert any("broadcast" in line for line in joins), plan
