"""Split invariants: exact size, balance, each key tested once, determinism."""
import math

from pyspark.sql import functions as F

from rarelab.operators.splits import holdout_split, stratified_folds


def _df(spark, n=503):
    return spark.createDataFrame([(i * 7 + 3, i % 11 == 0) for i in range(n)], "entity_id long, label boolean")


def test_holdout_exact_and_stable(spark):
    df = _df(spark)
    a = holdout_split(df, "entity_id", 0.2, 5)
    assert a.where("is_test").count() == math.ceil(0.2 * 503)
    b = holdout_split(df.repartition(7), "entity_id", 0.2, 5)
    assert sorted(a.where("is_test").select("entity_id").collect()) == sorted(
        b.where("is_test").select("entity_id").collect())


def test_stratified_balance(spark):
    f = stratified_folds(_df(spark), "label", "entity_id", 5)
    c = f.groupBy("label", "fold").count().collect()
    for lab in (True, False):
        sizes = [r["count"] for r in c if r["label"] == lab]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_unshuffled_blocks_are_contiguous(spark):
    f = stratified_folds(_df(spark), "label", "entity_id", 5).where("not label").orderBy("entity_id").collect()
    folds = [r["fold"] for r in f]
    assert folds == sorted(folds)


def test_repeated_each_key_tested_once_per_repeat(spark):
    f = stratified_folds(_df(spark), "label", "entity_id", 10, seed=1, n_repeats=3)
    assert f.groupBy("repeat", "entity_id").count().where("count <> 1").count() == 0
    assert f.select("repeat").distinct().count() == 3
    per = f.groupBy("repeat", "label", "fold").count().groupBy("repeat", "label").agg(
        (F.max("count") - F.min("count")).alias("spread")).collect()
    assert all(r["spread"] <= 1 for r in per)
