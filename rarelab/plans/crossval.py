"""Cross-validation, cohort scoring and parameter sweeps (inventory H7, I9,
I10, I12, J1-J5).

A split is a column, not a loop: ``split_id = repeat * n_splits + fold``.  No
training row is copied for its splits: a search leaves out the rows of the
query's own fold, and a resampled training row lists the (configuration, fold)
pairs that it trains for.  Test rows of equal features, fold and repeat share
their prediction, so each such set is scored once, with the numbers of its
positive and negative rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarelab.operators import metrics
from rarelab.operators.knn import knn_k_sweep, knn_neighbors, knn_vote
from rarelab.operators.logistic import fit_logistic_groups, predict_groups
from rarelab.operators.resample import resampled_members
from rarelab.session import cut_lineage


def cv_knn_sweep(folds: DataFrame, n_splits: int, features, ks: list[int], key: str = "entity_id",
                 label: str = "label", weights=None) -> DataFrame:
    """Per (split, k): accuracy of a kNN classifier, every k from one
    neighbour search of depth ``max(ks)``."""
    feats = [features] if isinstance(features, str) else list(features)
    several = isinstance(features, str) or len(feats) > 1
    keys = folds.groupBy("repeat", F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("n"))
    if several and not keys.where("n > 1").isEmpty():
        # rows of one key are answered together: one search per repeat with same-fold pairs masked
        rows = folds.select("repeat", "fold", key, label, *feats)
        nb = knn_neighbors(rows, rows, features, max(ks), key=key, label=label, split="repeat", weights=weights,
                           exclude_col="fold", as_arrays=True)
        test = folds.select("repeat", key, label, (F.col("repeat") * n_splits + F.col("fold")).alias("split_id"))
        preds = knn_k_sweep(nb, ks, key, "repeat").join(test, ["repeat", key])
        return metrics.accuracy(preds, label, "pred", by=["split_id", "k"])
    # rows of equal features and fold share their neighbours, so these sets are searched and weighted
    # with the labels that have them; no training row is copied
    y = F.col(label)
    named = [F.col(c) if isinstance(features, str) else F.col(c).cast("double").alias(c) for c in feats]
    values = folds.groupBy("repeat", "fold", *named).agg(
        F.count(F.when(y, 1)).alias("__pos"), F.count(F.when(~y, 1)).alias("__neg")).withColumn("__pair", F.monotonically_increasing_id())
    train = folds.select("repeat", "fold", key, label, *named)
    search = dict(key=key, label=label, query_key="__pair", split="repeat", weights=weights, exclude_col="fold", as_arrays=True)
    whole = all(isinstance(folds.schema[c].dataType, T.IntegralType) for c in ("repeat", "fold", key))
    if several and whole and isinstance(folds.schema[label].dataType, T.BooleanType) and keys.where("__key IS NULL").isEmpty():
        # a set's numbers go through the search with it: no list of neighbours is written
        own = ["fold", "__pos", "__neg"]
        nb = knn_neighbors(train, values, features, max(ks), method="blocks", carry=own, **search)
        hits = knn_k_sweep(nb, ks, "__pair", ["repeat", *own])
    else:
        values = cut_lineage(values)
        nb = knn_neighbors(train, values, features, max(ks), **search)
        hits = knn_k_sweep(nb, ks, "__pair", "repeat").join(values, ["repeat", "__pair"])
    hits = hits.withColumn("split_id", F.col("repeat") * n_splits + F.col("fold"))
    right, n = F.sum(F.when(F.col("pred"), F.col("__pos")).otherwise(F.col("__neg"))), F.sum(F.col("__pos") + F.col("__neg"))
    return hits.groupBy("split_id", "k").agg((right / n).alias("accuracy"), n.alias("n")).withColumn(
        "error", 1.0 - F.col("accuracy"))


def grid_summary(scores: DataFrame, param: str = "k", score: str = "accuracy") -> DataFrame:
    """Mean and population std of the split scores per parameter value
    (the unweighted mean over splits, as a grid search reports)."""
    return scores.groupBy(param).agg(F.avg(score).alias("mean_test_score"),
                                     F.stddev_pop(score).alias("std_test_score"))


def best_param(summary: DataFrame, param: str = "k") -> DataFrame:
    """The best mean score; the first (smallest) parameter wins ties."""
    return summary.orderBy(F.desc("mean_test_score"), param).limit(1)


def cv_knn_predictions(folds: DataFrame, n_splits: int, features, k: int, key: str = "entity_id",
                       label: str = "label", weights=None) -> DataFrame:
    """Out-of-fold kNN predictions ``(split_id, key, label, pred, proba)``: one search per repeat
    with same-fold pairs left out."""
    rows = folds.select("repeat", "fold", key, label, *([features] if isinstance(features, str) else features))
    nb = knn_neighbors(rows, rows, features, k, key=key, label=label, split="repeat", weights=weights,
                       exclude_col="fold")
    votes = knn_vote(nb, key, "repeat")
    test = folds.select("repeat", "fold", key, label).withColumn(
        "split_id", F.col("repeat") * n_splits + F.col("fold"))
    # one row per test row and split, scored by several metrics: materialise once
    return cut_lineage(test.join(votes, ["repeat", key], "left").select("split_id", key, label, "pred", "proba"))


def split_scores(preds: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy and ROC AUC per split."""
    acc = metrics.accuracy(preds, label, "pred", by="split_id").select("split_id", "accuracy")
    auc = metrics.roc_auc(preds, label, "proba", by="split_id")
    return acc.join(auc, "split_id")


def score_summary(scores: DataFrame, cols=("accuracy", "roc_auc")) -> DataFrame:
    """Mean and population std (numpy's default) of split scores, and
    ``error`` = 1 - mean accuracy where accuracy is among them."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.stddev_pop(c).alias(f"std_{c}")]
    out = scores.agg(*aggs)
    return out.withColumn("error", 1.0 - F.col("mean_accuracy")) if "accuracy" in cols else out


def _test_sets(folds: DataFrame, n_splits: int, features: list[str], label: str, n_configs: int) -> DataFrame:
    """Test rows of equal features as one: ``(repeat, fold, features..., __pos, __neg, config, __in, __pair)``, once
    per configuration; ``__in`` is the member of the training rows, ``__pair`` a key."""
    y = F.col(label).cast("boolean")
    sets = folds.groupBy("repeat", "fold", *[F.col(f).cast("double").alias(f) for f in features]).agg(
        F.count(F.when(y, 1)).alias("__pos"), F.count(F.when(~y, 1)).alias("__neg"))
    sets = sets.withColumn("config", F.explode(F.sequence(F.lit(0), F.lit(n_configs - 1))))
    sets = sets.withColumn("__in", (F.col("config") * F.lit(n_splits) + F.col("fold")).cast("int"))
    return cut_lineage(sets.withColumn("__pair", F.concat_ws(":", "__in", *features)))


def _set_scores(preds: DataFrame, n_splits: int) -> DataFrame:
    """``(config, split_id, accuracy, n, error, roc_auc)`` of scored sets of test rows; a set without a prediction is wrong."""
    by = ["config", "split_id"]
    preds = cut_lineage(preds.withColumn("split_id", F.col("repeat") * n_splits + F.col("fold")).select(
        *by, "pred", "proba", "__pos", "__neg"))
    right = F.coalesce(F.sum(F.when(F.col("pred"), F.col("__pos")).when(~F.col("pred"), F.col("__neg"))), F.lit(0))
    n = F.sum(F.col("__pos") + F.col("__neg"))
    acc = preds.groupBy(*by).agg((right / n).alias("accuracy"), n.alias("n")).withColumn("error", 1.0 - F.col("accuracy"))
    counts = preds.where(F.col("proba").isNotNull()).groupBy(*by, F.col("proba").alias("__s")).agg(
        F.sum("__pos").alias("pos"), F.sum("__neg").alias("neg"))
    return acc.join(metrics.auc_of_counts(counts, by), by)


def cv_knn_scores(folds: DataFrame, n_splits: int, features: list[str], k: int, configs: list[dict] | None = None,
                  seed: int = 42, key: str = "entity_id", label: str = "label", weights=None) -> DataFrame:
    """``(config, split_id, accuracy, n, error, roc_auc)`` of a kNN classifier on every split; with ``configs``
    (see :func:`rarelab.operators.resample.resampled_members`) on resampled training rows, once per
    configuration.  Test rows are never resampled."""
    sets = _test_sets(folds, n_splits, features, label, len(configs or [None]))
    if configs is None:
        train = folds.select("repeat", key, label, *features, F.col("fold").alias("__in"))
        nb = knn_neighbors(train, sets, features, k, key=key, label=label, query_key="__pair", split="repeat",
                           weights=weights, exclude_col="__in")
    else:
        train = resampled_members(folds, n_splits, features, configs, label, key, seed)
        nb = knn_neighbors(train, sets, features, k, key=key, label=label, query_key="__pair", split="repeat",
                           weights=weights, exclude_col="__in", member_col="__in")
    votes = knn_vote(nb, "__pair", "repeat")
    return _set_scores(sets.join(votes, ["repeat", "__pair"], "left"), n_splits)


def cv_logistic_scores(folds: DataFrame, n_splits: int, features: list[str], configs: list[dict] | None = None,
                       seed: int = 42, key: str = "entity_id", label: str = "label", C: float = 1.0) -> DataFrame:
    """I9 for L2 logistic regression, as :func:`cv_knn_scores`: the models of all configurations and splits in
    one batched Newton fit.  A row is counted for every model that it trains, equal rows of a model as one;
    it is not written down for each."""
    sets = _test_sets(folds, n_splits, features, label, len(configs or [None]))
    if configs is None:
        others = F.filter(F.sequence(F.lit(0), F.lit(n_splits - 1)), lambda f: f != F.col("fold"))
        train = folds.withColumn("__in", others)
    else:
        train = resampled_members(folds, n_splits, features, configs, label, key, seed)
    train = train.select("repeat", label, *features, F.explode("__in").alias("__in"))
    coefs = fit_logistic_groups(train, features, label, ["repeat", "__in"], C=C)
    return _set_scores(predict_groups(coefs, sets, features, ["repeat", "__in"]), n_splits)


def sweep_resampled(folds: DataFrame, n_splits: int, features: list[str], configs: list[dict],
                    model: str = "knn", k: int = 5, seed: int = 42, label: str = "label",
                    key: str = "entity_id") -> DataFrame:
    """Mean and population std of split ROC AUC and accuracy for each
    resampling configuration ``{"param", "over_ratio", "over_k",
    "under_ratio"}``.

    The configuration is part of what a training row lists and a test set asks for:
    one resampling pass, one neighbour search (or one batched logistic fit) and one AUC pass serve them all."""
    if model == "knn":
        per_split = cv_knn_scores(folds, n_splits, features, k, configs, seed, key, label)
    else:
        per_split = cv_logistic_scores(folds, n_splits, features, configs, seed, key, label)
    cfg = folds.sparkSession.createDataFrame(
        [(i, float(c["param"])) for i, c in enumerate(configs)], "config int, param double")
    summary = per_split.groupBy("config").agg(
        F.avg("accuracy").alias("mean_accuracy"), F.stddev_pop("accuracy").alias("std_accuracy"),
        F.avg("roc_auc").alias("mean_roc_auc"), F.stddev_pop("roc_auc").alias("std_roc_auc"))
    return summary.join(cfg, "config").select(
        "param", "mean_accuracy", "std_accuracy", "mean_roc_auc", "std_roc_auc")
