"""Deterministic splits (inventory G1-G3).

All randomness is key-hashed (:mod:`rarelab.functions.hashing`): a split is a
pure function of (seed, key), independent of partitioning and reproducible in
SQL.  No global window is used: exact cuts are read off a verified bracket of
the hash, class ranks come from range-partitioned running sums.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelab.functions.hashing import hash_string
from rarelab.operators.cuts import before_cut, hash_cuts
from rarelab.operators.ordered import running_sum
from rarelab.session import cut_lineage


def holdout_split(df: DataFrame, key: str, test_size: float, seed: int,
                  name: str = "is_test") -> DataFrame:
    """G1: shuffled, unstratified holdout of exact size ``ceil(n * test_size)``.

    Test rows are the first ones in (md5(seed:key), key) order.  After the count,
    one scan finds the cut (:func:`rarelab.operators.cuts.hash_cuts`); the result
    is a condition on the rows, read with them."""
    n = df.count()
    n_test = min(n, math.ceil(test_size * n))
    if n_test in (0, n):
        return df.withColumn(name, F.lit(n_test > 0))
    h = F.md5(hash_string(seed, key))
    want = df.sparkSession.createDataFrame([(n, n_test)], "n bigint, take bigint")
    cut = hash_cuts(df.select(h.alias("__h"), F.col(key).alias("__k")), [], want).first()
    return df.withColumn(name, before_cut(h, F.col(key), F.lit(cut["__cut_h"]), F.lit(cut["__cut_k"])))


def class_table(df: DataFrame, label: str, key: str) -> DataFrame:
    """``(label, __code, __n, __start)``: classes numbered in order of first
    appearance by key - the class encoding of scikit-learn's stratified
    splitters - with their sizes and the rows of the classes before them."""
    sizes = df.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.min(key).alias("__first"), F.count(F.lit(1)).alias("__n"))
    coded = running_sum(sizes.withColumn("__one", F.lit(1).cast("bigint")), [], ["__first"], ["__n", "__one"])
    return coded.select(label, (F.col("cum___one") - 1).alias("__code"), "__n",
                        (F.col("cum___n") - F.col("__n")).alias("__start"))


def fold_of(rank, start, n, n_splits: int):
    """Fold of a class's row at 0-based ``rank``.  Classes occupy consecutive
    ranges of the sorted label vector and fold ``i`` takes every
    ``n_splits``-th position from ``i``; so of a class that starts at ``start``
    the folds after ``start mod n_splits`` come first in taking one row more."""
    extra, base = n % F.lit(n_splits), F.floor(n / F.lit(n_splits))
    # folds (start + j) mod n_splits, j < extra, hold base + 1 rows, the others base
    sizes = [base + (F.pmod(F.lit(i) - start, F.lit(n_splits)) < extra).cast("bigint") for i in range(n_splits)]
    fold, filled = F.lit(n_splits - 1), F.lit(0).cast("bigint")
    for i in reversed(range(n_splits - 1)):
        filled = sizes[0]
        for s in sizes[1:i + 1]:
            filled = filled + s
        fold = F.when(rank < filled, F.lit(i)).otherwise(fold)
    return fold


def stratified_folds(df: DataFrame, label: str, key: str, n_splits: int = 5,
                     seed: int | None = None, n_repeats: int = 1,
                     fold: str = "fold", repeat: str = "repeat") -> DataFrame:
    """G2 (``seed=None``): stratified k-fold without shuffling - each class,
    in key order, is cut into contiguous blocks.
    G3 (``seed`` given): repeated stratified k-fold - ``n_repeats`` copies of
    every row, each class ordered by md5(seed:repeat:key) per repeat.

    Returns the input columns plus ``repeat`` and ``fold``."""
    df = cut_lineage(df)
    classes = cut_lineage(class_table(df, label, key))
    largest = classes.agg(F.max("__n")).first()[0]
    if largest is None or largest < n_splits:
        raise ValueError(f"n_splits={n_splits} exceeds the members of every class")
    base = df.join(classes, label)
    if seed is None:
        if n_repeats != 1:
            raise ValueError("repeats need a seed")
        base = base.withColumn(repeat, F.lit(0))
        order = [key]
    else:
        base = base.withColumn(repeat, F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1))))
        base = base.withColumn("__h", F.md5(hash_string(seed, repeat, key)))
        order = ["__h", key]
    ranked = running_sum(base.withColumn("__one", F.lit(1).cast("bigint")), [repeat, "__code"], order, ["__one"],
                         materialize=False)
    out = ranked.withColumn(fold, fold_of(F.col("cum___one") - 1, F.col("__start"), F.col("__n"), n_splits).cast("int"))
    return out.select(*df.columns, repeat, fold)
