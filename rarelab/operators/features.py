"""Joins, projections and feature engineering (inventory B, C, F)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# ------------------------------------------------------------------ joins (C)
def left_join_counts(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str,
                     name: str = "count") -> DataFrame:
    """Every dimension row with the number of fact rows pointing at it (0
    when none).  The fact side is aggregated before the join, so only one row
    per key crosses the shuffle; a hot key is combined map-side."""
    counts = fact.groupBy(F.col(fact_key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    j = dim.join(counts, dim[dim_key] == counts["__k"], "left")
    return j.select(*[dim[c] for c in dim.columns],
                    F.coalesce(F.col("__n"), F.lit(0).cast("bigint")).alias(name))


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           columns: dict[str, str]) -> DataFrame:
    """Keep every fact row, bring dimension columns (renamed) by key.

    No broadcast hint: the dimension grows with the data, so Spark's size
    estimate (``autoBroadcastJoinThreshold``, AQE at runtime) decides."""
    d = dim.select(F.col(dim_key).alias("__k"), *[F.col(src).alias(dst) for src, dst in columns.items()])
    j = fact.join(d, fact[fact_key] == d["__k"], "left")
    return j.drop("__k")


# ------------------------------------------------------- projections (B)
def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First ``n`` rows in key order (a top-n, planned as TakeOrderedAndProject)."""
    return df.orderBy(key).limit(n)


def assemble(cols: list[str], name: str = "features") -> Column:
    """Feature columns as one ``array<double>`` (the dense matrix row)."""
    return F.array(*[F.col(c).cast("double") for c in cols]).alias(name)


def facet_long(df: DataFrame, ids: list[str], features: list[str],
               name: str = "feature", value: str = "value") -> DataFrame:
    """Wide features to long ``(ids..., feature, value)``."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in features]).unpivot(
        ids, features, name, value)


# ----------------------------------------------------- one-hot encoding (F1)
def dummy_name(col: str, level) -> str:
    """``<col>_<level>`` with the level spelled as it is, so that two levels
    never share a column; refer to it in backticks."""
    return f"{col}_{level}"


def category_levels(df: DataFrame, col: str) -> list:
    """Distinct non-null levels, sorted.  They become columns, so the list is
    as long as the result is wide; :func:`one_hot_vector` encodes a vocabulary
    too large for columns."""
    return [r[0] for r in df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col).collect()]


def one_hot(df: DataFrame, cols: list[str], levels: dict | None = None,
            keep: bool = False) -> DataFrame:
    """one 0/1 column ``<col>_<level>`` per level (all levels kept);
    a null gets zeros everywhere.  ``levels`` fixes the vocabulary (fit on
    training rows and reuse it on later cohorts).  Names that clash raise."""
    levels = levels or {c: category_levels(df, c) for c in cols}
    kept = [c for c in df.columns if keep or c not in cols]
    names = kept + [dummy_name(c, lv) for c in cols for lv in levels[c]]
    if len({n.lower() for n in names}) != len(names):
        raise ValueError("two of the columns would have one name: " + ", ".join(sorted(
            {n for n in names if [m.lower() for m in names].count(n.lower()) > 1})))
    out = [F.col(f"`{c}`") for c in kept]
    for c in cols:
        for lv in levels[c]:
            out.append(F.coalesce((F.col(c) == F.lit(lv)).cast("int"), F.lit(0)).alias(dummy_name(c, lv)))
    return df.select(*out)


def one_hot_vector(df: DataFrame, col: str, levels: DataFrame, name: str = "indices") -> DataFrame:
    """F1 for a vocabulary of any size: ``levels`` (``level, index``, see
    :mod:`rarelab.sources.keys` for dense indices) is joined, and the row's
    vector is the sparse ``array<bigint>`` of its index; a null or unknown
    level has an empty one."""
    v = levels.select(F.col("level").alias("__level"), F.col("index").cast("bigint").alias("__index"))
    j = df.join(v, F.col(col) == F.col("__level"), "left")
    none = F.array().cast("array<bigint>")
    return j.withColumn(name, F.when(F.col("__index").isNull(), none).otherwise(F.array("__index"))).drop(
        "__level", "__index")


# --------------------------------------------------- standard scaler
class ScalerModel:
    """Mean and population std per column, held on the driver (two numbers a
    column).  A zero std scales by 1, like scikit-learn."""

    def __init__(self, stats: dict[str, tuple[float, float]]):
        self.stats = stats

    def transform(self, df: DataFrame, cols: list[str] | None = None) -> DataFrame:
        cols = cols or list(self.stats)
        repl = {}
        for c in cols:
            mean, std = self.stats[c]
            scale = std if std and std > 0 else 1.0
            repl[c] = (F.col(c).cast("double") - F.lit(mean)) / F.lit(scale)
        return df.withColumns(repl)


def fit_scaler(df: DataFrame, cols: list[str]) -> ScalerModel:
    """one aggregate of ``avg`` and ``stddev_pop`` per column."""
    row = df.agg(*[e for c in cols for e in (
        F.avg(F.col(c).cast("double")).alias(f"{c}__m"),
        F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__s"))]).first()
    return ScalerModel({c: (row[f"{c}__m"], row[f"{c}__s"]) for c in cols})


def scale(df: DataFrame, cols: list[str], train: Column, fit_scope: str = "train", cohort: str | None = None) -> DataFrame:
    """F2, F3 with an explicit fit: ``train`` (statistics of the training rows
    for all rows), ``all`` (of all rows), or ``cohort`` (training rows by their
    own statistics, and every later cohort by its own)."""
    if fit_scope == "train":
        return fit_scaler(df.where(train), cols).transform(df)
    if fit_scope == "all":
        return fit_scaler(df, cols).transform(df)
    if fit_scope != "cohort" or cohort is None:
        raise ValueError("fit_scope is train, all, or cohort with a cohort column")
    group = F.when(train, F.lit(None)).otherwise(F.col(cohort).cast("string"))
    stats = df.groupBy(group.alias("__g")).agg(*[e for c in cols for e in (
        F.avg(F.col(c).cast("double")).alias(f"__m_{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"__s_{c}"))])
    j = df.withColumn("__own", group).join(stats, F.col("__own").eqNullSafe(F.col("__g")))
    scaled = {c: (F.col(c).cast("double") - F.col(f"__m_{c}")) / F.when(F.col(f"__s_{c}") > 0, F.col(f"__s_{c}")).otherwise(1.0)
              for c in cols}
    return j.withColumns(scaled).select(*df.columns)


# ----------------------------------------------------- named feature sets
def model_matrix(df: DataFrame, stats: list[str], levels: dict[str, list], ids: list[str]) -> DataFrame:
    """F4 as data: the id columns, the numeric stats as doubles and every dummy
    as ``<column>_<number of the level>``, 0.0 or 1.0."""
    coded = one_hot(df.select(*ids, *stats, *levels), list(levels), levels)
    dummies = [(dummy_name(c, lv), f"{c}_{i}") for c in levels for i, lv in enumerate(levels[c])]
    return coded.select(*ids, *[F.col(c).cast("double").alias(c) for c in stats],
                        *[F.col(f"`{a}`").cast("double").alias(b) for a, b in dummies])


def feature_sets(stats: list[str], total: str, wins: str, dummies: list[str],
                 top_correlated: list[str]) -> dict[str, list[str]]:
    """the study's named feature sets.

    * ``all_no_total``   - every stat except the total, wins, dummies
    * ``total_dummies``  - the total instead of the single stats, dummies
    * ``top_correlated`` - the columns most correlated with the label
    * ``total_wins``     - the total and the win count
    * ``total_only``     - the total alone
    """
    singles = [s for s in stats if s not in (total, wins)]
    return {
        "all_no_total": singles + [wins] + dummies,
        "total_dummies": [total] + dummies,
        "top_correlated": list(top_correlated),
        "total_wins": [total, wins],
        "total_only": [total],
    }
