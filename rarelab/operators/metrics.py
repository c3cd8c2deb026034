"""Evaluation of predictions (inventory I1-I8, I11, I13).

Input: a DataFrame of predictions with a label, a hard prediction and
(for AUC) a score, optionally keyed by ``by`` columns (split, cohort, model).
Everything aggregates first to the confusion table - (groups x classes x
classes) rows - so the metrics cost one pass over the predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelab.operators.ordered import running_sum


def _by(by):
    return [by] if isinstance(by, str) else list(by or [])


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "pred", by=None) -> DataFrame:
    """Accuracy and its complement, per group.  Rows without a label
    are left out; a labelled row without a prediction is counted as wrong."""
    by = _by(by)
    pred = pred.where(F.col(label).isNotNull())
    hit = F.coalesce((F.col(label) == F.col(prediction)).cast("double"), F.lit(0.0))
    aggs = [F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n")]
    g = pred.groupBy(*by).agg(*aggs) if by else pred.agg(*aggs)
    return g.withColumn("error", 1.0 - F.col("accuracy"))


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "pred", by=None) -> DataFrame:
    """True x predicted counts, every cell of the observed class set
    (classes seen as label or prediction within the group), empty cells 0.
    The grid comes from exploding the per-group class set twice - no join
    of the predictions with anything; it has classes^2 cells, so it is meant
    for labels of few classes.  A missing prediction raises: it would vanish
    from every metric read off the table."""
    by = _by(by)
    missing = F.col(label).isNotNull() & F.col(prediction).isNull()
    checked = F.when(missing, F.raise_error(F.lit("a labelled row has no prediction"))).otherwise(F.col(prediction))
    pred = pred.where(F.col(label).isNotNull()).withColumn(prediction, checked)
    counts = pred.groupBy(*by, F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("count"))
    classes = counts.select(*by, F.explode(F.array("actual", "predicted")).alias("cls")).groupBy(*by).agg(
        F.array_sort(F.collect_set("cls")).alias("classes"))
    grid = (classes.select(*by, F.explode("classes").alias("actual"), "classes")
            .select(*by, "actual", F.explode("classes").alias("predicted")))
    return (grid.join(counts, [*by, "actual", "predicted"], "left")
            .select(*by, "actual", "predicted", F.coalesce("count", F.lit(0).cast("bigint")).alias("count")))


def per_class(pred: DataFrame, label: str = "label", prediction: str = "pred", by=None) -> DataFrame:
    """Per class: tp, support (true count), predicted count, precision,
    recall, F1 (0 where undefined, as scikit-learn reports)."""
    by = _by(by)
    cm = confusion_counts(pred, label, prediction, by)
    true_n = cm.groupBy(*by, F.col("actual").alias("cls")).agg(
        F.sum("count").alias("support"),
        F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0)).alias("tp"))
    pred_n = cm.groupBy(*by, F.col("predicted").alias("cls")).agg(F.sum("count").alias("n_predicted"))
    t = true_n.join(pred_n, [*by, "cls"])
    return t.select(
        *by, "cls", "tp", "support", "n_predicted",
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_predicted")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("support") + F.col("n_predicted")), F.lit(0.0)).alias("f1"),
    )


def weighted_prf(pred: DataFrame, label: str = "label", prediction: str = "pred", by=None) -> DataFrame:
    """Support-weighted precision, recall and F1 (F1 weighted per
    class, not the F1 of the averages)."""
    by = _by(by)
    pc = per_class(pred, label, prediction, by)
    w = F.col("support").cast("double")
    aggs = [(F.sum(w * F.col(m)) / F.sum(w)).alias(m) for m in ("precision", "recall", "f1")]
    return pc.groupBy(*by).agg(*aggs) if by else pc.agg(*aggs)


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "pred",
                          by=None) -> DataFrame:
    """Per-class rows plus ``accuracy``, ``macro avg``, ``weighted avg``;
    the accuracy row carries accuracy in ``f1`` and nulls elsewhere."""
    by = _by(by)
    pc = per_class(pred, label, prediction, by)
    classes = pc.select(*by, F.col("cls").cast("string").alias("row"), "precision", "recall", "f1",
                        F.col("support").cast("bigint").alias("support"))
    w = F.col("support").cast("double")

    def agg(df, *aggs):
        return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)

    macro = agg(pc, F.lit("macro avg").alias("row"), F.avg("precision").alias("precision"),
                F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                F.sum("support").cast("bigint").alias("support"))
    weighted = agg(pc, F.lit("weighted avg").alias("row"),
                   (F.sum(w * F.col("precision")) / F.sum(w)).alias("precision"),
                   (F.sum(w * F.col("recall")) / F.sum(w)).alias("recall"),
                   (F.sum(w * F.col("f1")) / F.sum(w)).alias("f1"),
                   F.sum("support").cast("bigint").alias("support"))
    acc = agg(pc, F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
              F.lit(None).cast("double").alias("recall"),
              (F.sum("tp") / F.sum("support")).alias("f1"), F.sum("support").cast("bigint").alias("support"))
    return classes.unionByName(acc).unionByName(macro).unionByName(weighted)


def roc_auc(pred: DataFrame, label: str = "label", score: str = "score", by=None) -> DataFrame:
    """I8: exact ROC AUC per group; tied scores get half credit (trapezoid).

    AUC = sum over distinct scores s of pos(s) * (neg(<s) + neg(s)/2) / (P N).
    Scores aggregate to distinct values first; the running count of
    negatives is a range-partitioned running sum, so neither a huge group nor
    a continuous score lands in one task.  NULL when a class is missing."""
    by = _by(by)
    y = F.col(label).cast("boolean")
    per_score = pred.where(F.col(score).isNotNull() & y.isNotNull()).groupBy(
        *by, F.col(score).cast("double").alias("__s")).agg(
        F.count(F.when(y, 1)).alias("pos"), F.count(F.when(~y, 1)).alias("neg"))
    return auc_of_counts(per_score, by)


def auc_of_counts(per_score: DataFrame, by: list[str]) -> DataFrame:
    """I8 from ``(by..., __s, pos, neg)``, one row per group and distinct score."""
    cum = running_sum(per_score, by, ["__s"], ["neg"])  # materialises the per-score table
    contrib = F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg"))
    aggs = [F.try_divide(F.sum(contrib), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc")]
    return cum.groupBy(*by).agg(*aggs) if by else cum.agg(*aggs)


def agreement(a: DataFrame, b: DataFrame, key: str, pred_a: str = "pred", pred_b: str = "pred",
              by=None) -> DataFrame:
    """Do two models predict the same?  Joint counts of their
    predictions, joined on the row key."""
    by = _by(by)
    x = a.select(*by, key, F.col(pred_a).alias("pred_a"))
    y = b.select(*by, key, F.col(pred_b).alias("pred_b"))
    return x.join(y, [*by, key]).groupBy(*by, "pred_a", "pred_b").agg(F.count(F.lit(1)).alias("count"))
