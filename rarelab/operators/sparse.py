"""Categorical columns of any number of levels as sparse rows (inventory F1, F4).

The levels of a column are a table with dense codes, never a list on the driver
and never columns.  A row carries one code per column.  Models take it as what
it stands for, a one-hot row: the neighbour search compares codes
(``knn_neighbors(codes=...)``), the logistic model of several columns gets Spark's
sparse vectors, and that of one column keeps its weights as a table."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelab.operators.ordered import running_sum
from rarelab.session import cut_lineage


def level_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, level, code)``: every distinct non-null level (as a string) of each column with its 0-based
    code in the order of levels."""
    cells = [df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols]
    every = cells[0]
    for other in cells[1:]:
        every = every.unionAll(other)
    levels = every.where(F.col("level").isNotNull()).distinct().withColumn("one", F.lit(1).cast("bigint"))
    coded = running_sum(levels, ["column"], ["level"], ["one"])
    return cut_lineage(coded.select("column", "level", (F.col("cum_one") - 1).alias("code")))


def encode_levels(df: DataFrame, cols: list[str], levels: DataFrame, suffix: str = "_code") -> DataFrame:
    """Append ``<col>_code`` for each column; null for a null level and one that the table lacks."""
    for c in cols:
        mine = levels.where(F.col("column") == F.lit(c)).select(F.col("level").alias("__level"), F.col("code").alias(f"{c}{suffix}"))
        df = df.join(mine, F.col(c).cast("string") == F.col("__level"), "left").drop("__level")
    return df


class SparseLogisticModel:
    """L2 logistic regression on one-hot columns of any width and numeric columns."""

    def __init__(self, codes: list[str], numbers: list[str], encoder: OneHotEncoderModel, fitted: LogisticRegressionModel):
        self.codes, self.numbers, self.encoder, self.fitted = codes, numbers, encoder, fitted

    def _vectors(self, df: DataFrame) -> DataFrame:
        return _assembled(df, self.codes, self.numbers, self.encoder)

    def transform(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        """``proba`` and ``pred`` appended; a row without a known level has none of its weight."""
        scored = self.fitted.transform(self._vectors(df))
        return scored.withColumn("proba", vector_to_array("probability")[1]).withColumn(
            "pred", F.col("proba") > F.lit(threshold)).select(*df.columns, "proba", "pred")

    def level_weights(self, levels: DataFrame, column: str) -> DataFrame:
        """``(level, coef)`` of a column: each level's margin beside the row of zeros, computed where the levels are."""
        rows = levels.where(F.col("column") == F.lit(column)).select("level", *[
            (F.col("code") if c == f"{column}_code" else F.lit(None).cast("bigint")).alias(c) for c in self.codes],
            *[F.lit(0.0).alias(n) for n in self.numbers])
        margin = vector_to_array("rawPrediction")[1] - F.lit(float(self.fitted.intercept))
        return self.fitted.transform(self._vectors(rows)).select("level", margin.alias("coef"))

    @property
    def intercept(self) -> float:
        return float(self.fitted.intercept)


def _assembled(df: DataFrame, codes: list[str], numbers: list[str], encoder: OneHotEncoderModel) -> DataFrame:
    # a code that the encoder does not know is the extra level, which is the one dropped: a row of zeros
    sizes = dict(zip(codes, encoder.categorySizes, strict=True))
    doubles = {f"__d_{c}": F.coalesce(F.col(c).cast("double"), F.lit(float(sizes[c]))) for c in codes}
    nums = {f"__n_{n}": F.col(n).cast("double") for n in numbers}
    vectors = VectorAssembler(inputCols=[*[f"__v_{c}" for c in codes], *nums], outputCol="__features", handleInvalid="error")
    return vectors.transform(encoder.transform(df.withColumns({**doubles, **nums})))


def fit_sparse_logistic(df: DataFrame, codes: list[str], levels: DataFrame, label: str = "label", numbers: list[str] | None = None,
                        C: float = 1.0, max_iter: int = 200, tol: float = 1e-10) -> SparseLogisticModel:
    """H4 on sparse rows: ``codes`` are columns of :func:`encode_levels` with ``levels`` their table, ``numbers`` numeric
    columns.  The driver holds one weight per level, as any Spark ML model does; rows never leave the executors."""
    numbers = list(numbers or [])
    # the widths come from the table: a level that no training row has keeps its place (and a weight of 0)
    sizes = {r["column"]: r["n"] for r in levels.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    widths = df.sparkSession.createDataFrame([tuple(float(sizes[c.removesuffix("_code")] - 1) for c in codes)],
                                             ", ".join(f"`__d_{c}` double" for c in codes))
    encoder = OneHotEncoder(inputCols=[f"__d_{c}" for c in codes], outputCols=[f"__v_{c}" for c in codes],
                            handleInvalid="keep", dropLast=True).fit(widths)
    data = cut_lineage(df.select(*codes, *numbers, F.col(label).cast("double").alias("__y")).where(F.col("__y").isNotNull()))
    n = data.count()
    lr = LogisticRegression(featuresCol="__features", labelCol="__y", regParam=1.0 / (C * n), elasticNetParam=0.0,
                            standardization=False, fitIntercept=True, maxIter=max_iter, tol=tol)
    return SparseLogisticModel(codes, numbers, encoder, lr.fit(_assembled(data, codes, numbers, encoder)))


class LevelLogisticModel:
    """L2 logistic regression on one categorical column of any number of levels and numeric columns; the weights
    of the levels are a table ``(level, w)``."""

    def __init__(self, column: str, numbers: list[str], weights: DataFrame, coefficients: list[float], intercept: float):
        self.column, self.numbers, self.weights = column, numbers, weights
        self.coefficients, self.intercept = coefficients, intercept

    def transform(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        """``proba`` and ``pred`` appended; a row without a known level has none of its weight."""
        j = df.join(self.weights.select(F.col("level").alias("__level"), F.col("w").alias("__w")),
                    F.col(self.column).cast("string") == F.col("__level"), "left")
        eta = F.lit(float(self.intercept)) + F.coalesce("__w", F.lit(0.0))
        for c, n in zip(self.coefficients, self.numbers, strict=True):
            eta = eta + F.lit(float(c)) * F.col(n).cast("double")
        return j.withColumn("proba", F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))).withColumn(
            "pred", F.col("proba") > F.lit(threshold)).select(*df.columns, "proba", "pred")


def fit_level_logistic(df: DataFrame, column: str, numbers: list[str] | None = None, label: str = "label", C: float = 1.0,
                       max_iter: int = 50, tol: float = 1e-9) -> LevelLogisticModel:
    """H4 on the one-hot columns of ``column`` and numeric ``numbers``, with the weights where the levels are.

    Objective: ``0.5 |w|^2 + C sum(logloss)``, the intercept free.  No row has two levels, so the Hessian
    is diagonal in the levels, bordered by the few dense columns: every Newton step sums per level, solves the
    border's complement (the only thing that the driver sees, one row) and then each level by itself.
    A null level has no weight; rows with a null number or label are left out.  A step that makes the
    objective worse is taken back by half; without convergence in ``max_iter`` steps it raises."""
    numbers = list(numbers or [])
    d = len(numbers) + 1
    x = [F.lit(1.0), *[F.col(f"__x{i}") for i in range(1, d)]]
    rows = df.select(F.col(column).cast("string").alias("level"), F.col(label).cast("double").alias("__y"),
                     *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(numbers, 1)]).dropna(
        subset=["__y", *[f"__x{i}" for i in range(1, d)]])
    # equal rows are one with a count
    rows = cut_lineage(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("double").alias("__n")))
    weights = cut_lineage(rows.select("level").distinct().select("level", F.lit(0.0).alias("w"), F.lit(0.0).alias("dw")))
    theta, step, best = np.zeros(d), np.zeros(d), math.inf
    pairs = [(a, b) for a in range(d) for b in range(a, d)]
    own = F.col("level").isNotNull()
    for _ in range(max_iter):
        now = weights.select(F.col("level").alias("__level"), "w")
        eta = F.col("w")
        for t, c in zip(theta, x, strict=True):
            eta = eta + F.lit(float(t)) * c
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("eta")))
        softplus = F.when(F.col("eta") > 0, F.col("eta") + F.log1p(F.exp(-F.col("eta")))).otherwise(F.log1p(F.exp(F.col("eta"))))
        j = rows.join(now, F.col("level").eqNullSafe(F.col("__level"))).withColumn("eta", eta)
        j = j.withColumns({"r": F.col("__n") * (p - F.col("__y")), "s": F.col("__n") * p * (F.lit(1.0) - p),
                           "loss": F.col("__n") * (softplus - F.col("__y") * F.col("eta"))})
        sums = [F.sum("loss").alias("loss"), F.sum("r").alias("r"), F.sum("s").alias("s")]
        sums += [F.sum(F.col("s") * x[a]).alias(f"b{a}") for a in range(d)] + [F.sum(F.col("r") * x[a]).alias(f"g{a}") for a in range(d)]
        sums += [F.sum(F.col("s") * x[a] * x[b]).alias(f"a{a}_{b}") for a, b in pairs]
        per = j.groupBy("level", "w").agg(*sums).withColumns({
            "h": F.lit(1.0) + F.lit(C) * F.col("s"), "gl": F.col("w") + F.lit(C) * F.col("r")})
        per = cut_lineage(per)  # one row per level
        share = lambda e: F.sum(F.when(own, e / F.col("h")).otherwise(F.lit(0.0)))
        border = per.agg(F.sum("loss").alias("loss"), F.sum(F.col("w") * F.col("w")).alias("ww"),
                         *[F.sum(f"g{a}").alias(f"g{a}") for a in range(d)], *[F.sum(f"a{a}_{b}").alias(f"a{a}_{b}") for a, b in pairs],
                         *[share(F.col(f"b{a}") * F.col("gl")).alias(f"u{a}") for a in range(d)],
                         *[share(F.col(f"b{a}") * F.col(f"b{b}")).alias(f"v{a}_{b}") for a, b in pairs]).first()
        if border["loss"] is None:
            raise ValueError("no rows to fit on")
        objective = 0.5 * border["ww"] + 0.5 * float(theta[1:] @ theta[1:]) + C * border["loss"]
        if objective > best + 1e-12 * abs(best) and float(np.max(np.abs(step))) > tol:
            step = step / 2
            theta = theta - step
            weights = cut_lineage(weights.select("level", (F.col("w") - F.col("dw") / 2).alias("w"), (F.col("dw") / 2).alias("dw")))
            continue
        best = objective
        penalty = np.eye(d)
        penalty[0, 0] = 0
        hessian, right = penalty.copy(), penalty @ theta
        for a, b in pairs:
            hessian[a, b] += C * border[f"a{a}_{b}"] - C * C * border[f"v{a}_{b}"]
            hessian[b, a] = hessian[a, b]
        right = right + np.asarray([C * border[f"g{a}"] - C * border[f"u{a}"] for a in range(d)])
        step = -np.linalg.solve(hessian, right)
        lean = F.col("gl")
        for a in range(d):
            lean = lean + F.lit(C * float(step[a])) * F.col(f"b{a}")
        dw = F.when(own, -lean / F.col("h")).otherwise(F.lit(0.0))
        weights = cut_lineage(per.select("level", (F.col("w") + dw).alias("w"), dw.alias("dw")))
        theta = theta + step
        largest = weights.agg(F.max(F.abs("dw"))).first()[0]
        if max(float(np.max(np.abs(step))), largest) < tol:
            return LevelLogisticModel(column, numbers, weights.where(own).select("level", "w"), theta[1:].tolist(), float(theta[0]))
    raise RuntimeError(f"not converged in {max_iter} steps")
