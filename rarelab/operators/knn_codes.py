"""Exact nearest neighbours by one number and level codes, without comparing pairs.

A code of a query is the same as a training row's, or the row has some other level, or none.  For every
choice of these per code column the rows that fit lie on a line of their own - the rows of one level, those of
any level, those without - where the codes' part of the distance is one number, so
:func:`rarelab.operators.knn_line.line_search` answers all of them in one shuffle.  The line of any level
also holds the query's own level, whose rows are nearer than that line says: they can only stand before
rows that are no neighbours then, and are left to the line of that level.  So a row among the ``k``
nearest is among the first ``k`` of the line that it differs on in just its own way."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rarelab.operators.knn_line import line_search
from rarelab.session import cut_lineage

NONE, ANY = -1, -2  # beside the levels 0, 1, ...


def code_search(train: DataFrame, query: DataFrame, k: int, split: list[str], weights: np.ndarray,
                code_weights: np.ndarray) -> DataFrame:
    """Candidates ``(split..., __qk, __nb)`` as :func:`rarelab.operators.knn_pivots.pivot_search` gives them, of rows
    with one number at most; weights above zero.  Of equal rows of a line the first ``k`` by key are searched."""
    columns = range(len(code_weights))
    lines = [*split, *[f"__g{j}" for j in columns]]
    code = lambda c, j: F.greatest(F.col(c)[j], F.lit(NONE).cast("bigint"))
    kind = lambda x: F.lit(x).cast("bigint")
    number = (lambda c: F.col(c)[0]) if len(weights) else (lambda c: F.lit(0.0))
    weight = float(weights[0]) if len(weights) else 1.0

    t = train.select(*split, "__tk", F.struct(F.col("__ty").alias("y"), F.col("__tz").alias("z")).alias("__ty"),
                     number("__tx").alias("__v"), F.lit(None).cast("int").alias("__tc"))
    for j in columns:
        z = F.greatest(F.col("__ty.z")[j], kind(NONE))
        t = t.withColumn(f"__g{j}", F.explode(F.when(z == NONE, F.array(kind(NONE))).otherwise(F.array(z, kind(ANY)))))
    equal = Window.partitionBy(*lines, "__v").orderBy(F.col("__tk").asc_nulls_last())
    t = cut_lineage(t.withColumn("__at", F.row_number().over(equal)).where(F.col("__at") <= k).drop("__at"))

    asks = query.select(*split, "__qk", "__qz", number("__qx").alias("__v"))
    for j, w in zip(columns, code_weights, strict=True):
        z, w = code("__qz", j), float(w)
        of = lambda line, gap: F.struct(line.alias("line"), F.lit(gap).alias("gap"))
        asks = asks.withColumn(f"__a{j}", F.explode(F.when(z == NONE, F.array(of(kind(NONE), 0.0), of(kind(ANY), w))).otherwise(
            F.array(of(z, 0.0), of(kind(NONE), w), of(kind(ANY), 2.0 * w)))))
    gap = F.lit(0.0)
    for j in columns:
        gap = gap + F.col(f"__a{j}.gap")
    asks = asks.select(*split, "__qk", "__qz", "__v", *[F.col(f"__a{j}.line").alias(f"__g{j}") for j in columns], gap.alias("__gap"))
    # a line that no training row is on has no answers
    there = t.select(*lines).distinct()
    asks = cut_lineage(_joined(asks, there, lines, "left_semi"))
    values = cut_lineage(asks.select(*lines, "__v").distinct().withColumn("__c", F.lit(None).cast("int")))
    found = _joined(asks, line_search(t, values, k, lines, 1.0).drop("__c"), [*lines, "__v"])
    differs = lambda n, j: (F.col(f"__g{j}") != ANY) | (n["__ty"]["z"][j] != code("__qz", j))
    near = F.filter("__nb", lambda n: _all([differs(n, j) for j in columns]))
    near = F.transform(near, lambda n: F.struct((n["__d2"] * F.lit(weight) + F.col("__gap")).alias("__d2"),
                                                n["__tk"].alias("__tk"), n["__ty"]["y"].alias("__ty")))
    return found.select(*split, "__qk", near.alias("__nb")).where(F.size("__nb") > 0)


def _all(conditions: list):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join by columns that may be null."""
    other = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    out = left.join(other, _all([F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on]), how)
    return out.drop(*[f"__r_{c}" for c in on])
