"""Aggregation and profiling (inventory D, E).

All profiles are single aggregates (partial + final), so a column of any size
costs one scan; outputs are small (per class, per column pair, per bin).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rarelab.functions.comoments import pair_correlations
from rarelab.functions.quantile import exact_percentiles
from rarelab.session import cut_lineage


def frequency(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Value counts, most frequent first, nulls excluded."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.desc(name), col))


def class_share(df: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """Relative frequency, nulls excluded.

    Without ``by`` the total is one sum over the written counts, so the rows are
    scanned once and never funnelled through a global window.  With ``by`` the shares are per
    group: the grouped table has (groups x classes) rows and is windowed by
    group."""
    keyed = df.where(F.col(col).isNotNull())
    keys = [by, col] if by else [col]
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    if by:
        return counts.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy(by)))
    counts = cut_lineage(counts)  # one row per class: the total is read off it, not off the rows again
    total = counts.agg(F.sum("count")).first()[0] or 0
    return counts.withColumn("share", F.try_divide(F.col("count"), F.lit(float(total))))


def majority_baseline(df: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """Accuracy of always predicting the most frequent class (per group)."""
    shares = class_share(df, col, by)
    aggs = [F.max("share").alias("baseline_accuracy"),
            F.max_by(col, F.struct("count", F.col(col))).alias("majority_class")]
    return shares.groupBy(by).agg(*aggs) if by else shares.agg(*aggs)


def key_profile(df: DataFrame, *cols: str) -> DataFrame:
    """D3: min, max, count and distinct count of key-like columns, one row
    per column."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("bigint").alias(f"{c}__min"), F.max(c).cast("bigint").alias(f"{c}__max"),
                 F.count(c).alias(f"{c}__n"), F.count_distinct(c).alias(f"{c}__nd")]
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__min").alias("min_value"),
                 F.col(f"{c}__max").alias("max_value"), F.col(f"{c}__n").alias("n_values"),
                 F.col(f"{c}__nd").alias("n_distinct"),
                 (F.col(f"{c}__n") == F.col(f"{c}__nd")).alias("is_unique"))
        for c in cols])).alias("s")).select("s.*")


def describe(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, sample std, min, exact linear quartiles, max."""
    x = F.col(col).cast("double")
    q = exact_percentiles(df, col, [0.25, 0.5, 0.75])
    return df.agg(
        F.lit(col).alias("column"),
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"), F.lit(q[0.25]).cast("double").alias("p25"),
        F.lit(q[0.5]).cast("double").alias("p50"), F.lit(q[0.75]).cast("double").alias("p75"),
        F.max(x).alias("max"))


def reconcile(facts: DataFrame, derived: DataFrame, count_col: str) -> DataFrame:
    """Number of fact rows equals the sum of the derived counts.  One
    aggregate over a union, no join."""
    u = (facts.select(F.lit(1).cast("bigint").alias("f"), F.lit(0).cast("bigint").alias("w"))
         .unionByName(derived.select(F.lit(0).cast("bigint").alias("f"), F.col(count_col).cast("bigint").alias("w"))))
    return u.agg(F.sum("f").alias("n_facts"), F.sum("w").alias("total_derived")).withColumn(
        "matches", F.col("n_facts") == F.col("total_derived"))


def correlation_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete Pearson r for every ordered pair, long form
    ``(feature_a, feature_b, r)``.

    A pair is computed over the rows that have both values.  A task sends one
    state of co-moments, whatever its rows and columns
    (:mod:`rarelab.functions.comoments`).  A constant column and a pair without
    rows give NULL."""
    names = F.array(*[F.lit(c) for c in cols])
    return pair_correlations(df, cols).select(F.get(names, F.col("i")).alias("feature_a"),
                                              F.get(names, F.col("j")).alias("feature_b"), "r")


def label_correlation(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """R of every column with the label, ranked by signed r (desc, nulls
    last, name as tie-break).  The ranked input has one row per column."""
    long = correlation_long(df, cols + [label] if label not in cols else cols)
    lc = long.where(F.col("feature_b") == label).select(F.col("feature_a").alias("feature"), "r")
    w = Window.orderBy(F.desc_nulls_last("r"), "feature")
    return lc.withColumn("rank", F.row_number().over(w))


def select_top_correlated(df: DataFrame, cols: list[str], label: str, n: int = 6) -> DataFrame:
    """Ranks 2..n+1 of D7 (rank 1 is the label itself)."""
    ranked = label_correlation(df, cols, label)
    return (ranked.orderBy("rank").offset(1).limit(n))


def correlation_wide(df: DataFrame, cols: list[str]) -> DataFrame:
    """The correlation matrix, one row per feature, one column per
    feature (the table behind a heatmap)."""
    long = correlation_long(df, cols)
    return long.groupBy("feature_a").pivot("feature_b", cols).agg(F.first("r")).withColumnRenamed(
        "feature_a", "feature")


def class_histogram(df: DataFrame, value: str, cls: str, bins: int = 10) -> DataFrame:
    """Per class, equal-width histogram over that class's own range.

    The range table holds one row per class; Spark broadcasts it where its
    measured size allows.  Every bin appears, empty ones with 0.  A constant
    class is centred in a unit range, as numpy does."""
    x = F.col(value).cast("double")
    rng = (df.where(x.isNotNull()).groupBy(cls)
           .agg(F.min(x).alias("mn"), F.max(x).alias("mx"))
           .select(cls,
                   F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                   F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi")))
    scale = F.lit(float(bins)) / (F.col("hi") - F.col("lo"))
    binned = (df.where(x.isNotNull()).select(cls, x.alias("x"))
              .join(rng, cls)
              .select(cls, F.least(F.floor((F.col("x") - F.col("lo")) * scale).cast("int"),
                                   F.lit(bins - 1)).alias("bin")))
    counts = binned.groupBy(cls, "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(cls, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (grid.join(counts, [cls, "bin"], "left")
            .select(cls, "bin",
                    (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0).cast("bigint")).alias("count")))
