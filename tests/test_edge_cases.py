"""Nulls, ties, clashing names, small constants: answers that must not depend on the path or the size."""
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rarelab.functions import quantile
from rarelab.operators import metrics, resample
from rarelab.operators.features import one_hot, one_hot_vector, scale
from rarelab.operators.knn import knn_k_sweep, knn_neighbors
from rarelab.operators.logistic import fit_logistic_groups, predict_groups
from rarelab.operators.ordered import running_sum
from rarelab.operators.splits import fold_of, holdout_split, stratified_folds

NAN = float("nan")


@pytest.mark.parametrize("method", ["sorted", "pivots"])
def test_null_features_are_neither_found_nor_answered(spark, method):
    tr = spark.createDataFrame([(1, True, None), (2, False, 5.0), (3, True, 6.0), (4, False, NAN), (5, True, 9.0)],
                               "entity_id long, label boolean, x double")
    qu = spark.createDataFrame([(10, 5.4), (11, None), (12, NAN), (13, 5.4)], "entity_id long, x double")
    got = sorted((r["entity_id"], r["neighbor_key"], r["rank"]) for r in knn_neighbors(tr, qu, ["x"], 3, method=method).collect())
    assert got == [(q, n, k + 1) for q in (10, 13) for k, n in enumerate((2, 3, 5))]


@pytest.mark.parametrize("exclude", [False, True])
def test_string_keys_and_ties_on_both_paths(spark, exclude):
    rows = [(f"k{i:03d}", i % 3 == 0, float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "entity_id string, label boolean, x double")
    out = [sorted((r["entity_id"], r["neighbor_key"], r["rank"]) for r in
                  knn_neighbors(df, df, ["x"], 4, exclude_self=exclude, method=m).collect()) for m in ("sorted", "pivots")]
    assert out[0] == out[1] and len(out[0]) == 240


def test_excluded_folds_on_both_paths(spark):
    rng = random.Random(6)
    rows = [(r, i, i % 4, rng.random() < 0.3, float(rng.randrange(15))) for r in range(2) for i in range(120)]
    df = spark.createDataFrame(rows, "repeat int, entity_id long, fold int, label boolean, x double")
    out = [sorted((r["repeat"], r["entity_id"], r["neighbor_key"], r["rank"]) for r in knn_neighbors(
        df, df, ["x"], 6, split="repeat", exclude_col="fold", method=m).collect()) for m in ("sorted", "pivots")]
    assert out[0] == out[1] and len(out[0]) == 2 * 120 * 6


def test_a_sweep_beyond_the_training_rows_raises(spark):
    tr = spark.createDataFrame([(i, i % 2 == 0, float(i)) for i in range(4)], "entity_id long, label boolean, x double")
    qu = spark.createDataFrame([(9, 1.2)], "entity_id long, x double")
    for arrays in (False, True):
        nb = knn_neighbors(tr, qu, ["x"], 9, as_arrays=arrays)
        with pytest.raises(Exception, match="fewer neighbours"):
            knn_k_sweep(nb, [3, 5, 9]).collect()
        assert knn_k_sweep(nb, [1, 3]).count() == 2


def test_missing_predictions_are_wrong_not_gone(spark):
    df = spark.createDataFrame([(True, True), (True, None), (False, False), (False, None), (None, True)],
                               "label boolean, pred boolean")
    row = metrics.accuracy(df).first()
    assert (row["accuracy"], row["error"], row["n"]) == (0.5, 0.5, 4)
    with pytest.raises(Exception, match="no prediction"):
        metrics.confusion_counts(df).collect()


def test_one_hot_names(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a-b"), (3, None), (4, "a.b")], "id int, c string")
    got = one_hot(df, ["c"])
    assert got.columns == ["id", "c_a b", "c_a-b", "c_a.b"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 0, 0), (2, 0, 1, 0), (3, 0, 0, 0), (4, 0, 0, 1)]
    with pytest.raises(ValueError):
        one_hot(spark.createDataFrame([("x", 1), ("X", 2)], "c string, id int"), ["c"])
    levels = spark.createDataFrame([("a b", 0), ("a-b", 1)], "level string, index long")
    assert {r["id"]: r["indices"] for r in one_hot_vector(df, "c", levels).collect()} == {1: [0], 2: [1], 3: [], 4: []}


def test_quantiles_by_narrowing(spark, monkeypatch):
    rng = np.random.default_rng(0)
    sets = [rng.standard_normal(4000), rng.integers(0, 5, 4000).astype(float), np.r_[np.zeros(3000), rng.random(1000)],
            np.r_[rng.random(500), np.ones(3000) * 0.5, rng.random(500)]]
    monkeypatch.setattr(quantile, "FETCH_ROWS", 20)
    for vals in sets:
        df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(4)
        ps = [0.0, 0.1, 0.25, 0.5, 0.92, 1.0]
        got = quantile.exact_percentiles(df, "x", ps, accuracy=50)
        assert [got[p] for p in ps] == pytest.approx([float(np.quantile(vals, p)) for p in ps])
    assert quantile.exact_percentile(df.where("x > 99"), "x", 0.5) is None


def test_one_bucket_and_many_agree(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(2), rng.randrange(4), i, rng.randrange(9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g int, v int, k int, w long")
    run = lambda parts: sorted((r["k"], r["cum_w"]) for r in running_sum(
        df, ["g"], ["v", "k"], ["w"], rows_per_bucket=parts).collect())
    assert run(5) == run(10**7)


def test_fold_of_matches_positions(spark):
    for k in (2, 3, 10):
        for start, n in ((0, 1), (3, 17), (7, 40), (10, 10)):
            sizes = [sum((start + r) % k == f for r in range(n)) for f in range(k)]
            want = [f for f, s in enumerate(sizes) for _ in range(s)]
            got = spark.range(n).select("id", fold_of(F.col("id"), F.lit(start), F.lit(n), k).alias("f")).orderBy("id").collect()
            assert [r["f"] for r in got] == want


def test_many_classes_and_splits(spark):
    df = spark.createDataFrame([(i, i % 1500) for i in range(7500)], "entity_id long, label long")
    f = stratified_folds(df, "label", "entity_id", 5)
    assert f.count() == 7500 and f.groupBy("label", "fold").count().where("count <> 1").count() == 0
    two = spark.range(4000).select(F.col("id").alias("entity_id"), (F.col("id") % 400).alias("split_id"), (F.col("id") < 800).alias("label"))
    kept = resample.undersample(two, 1.0, split="split_id")
    assert kept.groupBy("split_id", "label").count().where("count <> 2").count() == 0 and kept.count() == 1600


def test_synthetic_rows_over_many_chunks(spark, monkeypatch):
    df = spark.createDataFrame([(i, i < 12, float(i % 12), float(i % 5)) for i in range(300)],
                               "entity_id long, label boolean, x double, z double")
    whole = sorted(tuple(r) for r in resample.smote(df, ["x", "z"], k=3).collect())
    monkeypatch.setattr(resample, "CHUNK", 7)
    assert sorted(tuple(r) for r in resample.smote(df, ["x", "z"], k=3).collect()) == whole
    assert len(whole) == 576
    with pytest.raises(ValueError, match="negative"):
        resample.smote(df.withColumn("entity_id", F.col("entity_id") - 5), ["x"], k=3)


def test_holdout_ties_at_the_cut(spark, monkeypatch):
    import rarelab.operators.splits as splits
    df = spark.range(500).withColumnRenamed("id", "entity_id")
    # digests that repeat: the key decides
    monkeypatch.setattr(splits, "hash_string", lambda seed, key: (F.col(key) % 3).cast("string"))
    digest = {k: hashlib.md5(str(k).encode()).hexdigest() for k in range(3)}
    want = sorted(range(500), key=lambda i: (digest[i % 3], i))[:150]
    assert {r[0] for r in holdout_split(df, "entity_id", 0.3, 2).where("is_test").collect()} == set(want)


def test_scale_scopes(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 10.0), (2, 30.0), (3, 5.0)], "g int, x double")
    out = {s: sorted(r["x"] for r in scale(df, ["x"], F.col("g") == 1, s, "g").collect()) for s in ("train", "all", "cohort")}
    assert out["train"] == [-1.0, 1.0, 3.0, 8.0, 28.0]
    assert out["cohort"] == [-1.0, -1.0, 0.0, 1.0, 1.0]
    x = np.array([1, 3, 10, 30, 5.0])
    assert out["all"] == pytest.approx(sorted((x - x.mean()) / x.std()))
    with pytest.raises(ValueError):
        scale(df, ["x"], F.col("g") == 1, "some")


def test_grouped_logistic_on_two_features(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 2))
    y = rng.random(400) < 1 / (1 + np.exp(-(0.4 + x @ [1.5, -0.7])))
    rows = [(i % 2, float(a), float(b), bool(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "g int, a double, b double, label boolean")
    coefs = {r["g"]: np.array([r["intercept"], r["a"], r["b"]]) for r in fit_logistic_groups(df, ["a", "b"], "label", ["g"]).collect()}
    for g in (0, 1):
        X, t = np.c_[np.ones(200), x[g::2]], y[g::2].astype(float)
        w = np.zeros(3)
        for _ in range(50):
            p = 1 / (1 + np.exp(-X @ w))
            grad = X.T @ (p - t) + np.r_[0, w[1:]]
            w -= np.linalg.solve((X * (p * (1 - p))[:, None]).T @ X + np.diag([0, 1, 1]), grad)
        assert coefs[g] == pytest.approx(w, abs=1e-6)
    with pytest.raises(RuntimeError, match="converge"):
        fit_logistic_groups(df, ["a", "b"], "label", ["g"], max_iter=2)
    scored = predict_groups(fit_logistic_groups(df, ["a", "b"], "label", ["g"]), df, ["a", "b"], ["g"]).first()
    assert 0 < scored["proba"] < 1


def test_logistic_cv_and_sweep_agree(spark):
    from rarelab.plans.crossval import cv_logistic_scores, score_summary, sweep_resampled
    rng = np.random.default_rng(4)
    rows = [(i, bool(i % 6 == 0), float(rng.normal(2.0 * (i % 6 == 0)))) for i in range(240)]
    df = spark.createDataFrame(rows, "entity_id long, label boolean, x double")
    folds = stratified_folds(df, "label", "entity_id", 3, seed=1, n_repeats=2)
    one = score_summary(cv_logistic_scores(folds, 3, ["x"], [dict(over_ratio=0.4, over_k=3, under_ratio=0.8)], 42)).first()
    sweep = sweep_resampled(folds, 3, ["x"], [dict(param=1, over_ratio=0.4, over_k=3, under_ratio=0.8)], model="logistic").first()
    assert one["mean_roc_auc"] == pytest.approx(sweep["mean_roc_auc"]) and one["error"] == pytest.approx(1 - one["mean_accuracy"])
    assert one["mean_roc_auc"] > 0.8


def test_grid_without_splits_equals_single_configurations(spark):
    df = spark.createDataFrame([(i, i < 30, float(i % 13)) for i in range(300)], "entity_id long, label boolean, x double")
    configs = [dict(over_ratio=0.3, over_k=2, under_ratio=0.5), dict(over_ratio=None, over_k=3, under_ratio=None)]
    grid = resample.resample_grid(df, ["x"], configs)
    cols = ["entity_id", "label", "x", "is_synthetic"]
    one = [resample.undersample(resample.smote(df, ["x"], ratio=0.3, k=2), 0.5), resample.smote(df, ["x"], k=3)]
    for i, rows in enumerate(one):
        assert sorted(tuple(r) for r in grid.where(F.col("config") == i).select(*cols).collect()) == sorted(
            tuple(r) for r in rows.select(*cols).collect())
