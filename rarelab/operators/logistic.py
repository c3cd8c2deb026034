"""Logistic regression (inventory H3-H6).

* :func:`fit_logistic` - L2-penalised logistic regression with intercept in
  the ``C`` parametrisation (``0.5 |w|^2 + C * sum logloss``): Spark ML
  ``LogisticRegression`` with ``regParam = 1 / (C n)``, no standardisation.
* :func:`logit_inference` - unpenalised MLE (optionally without intercept)
  with standard errors, z, p-values and log-likelihoods, via Spark ML
  ``GeneralizedLinearRegression`` (binomial, logit, IRLS).
* :func:`fit_logistic_groups` - the same L2 model fitted for many groups at
  once (cross-validation splits, sweep configurations, or 10,000 segments):
  damped Newton on one array of sums per group, solved on the executors.

Single fitted models hold their coefficients on the driver, those of groups are
a table; both score with plain column expressions, so prediction stays inside
whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rarelab.operators.newton import gram, merge, newton, packer
from rarelab.session import cut_lineage, expose_package


def _sigmoid(eta: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))


def _softplus(eta: Column) -> Column:
    return F.when(eta > 0, eta + F.log1p(F.exp(-eta))).otherwise(F.log1p(F.exp(eta)))


class LogisticModel:
    """Intercept and coefficients of a binary logistic model."""

    def __init__(self, features: list[str], coefficients: list[float], intercept: float = 0.0):
        self.features, self.coefficients, self.intercept = list(features), list(coefficients), intercept

    def margin(self) -> Column:
        eta = F.lit(float(self.intercept))
        for f, c in zip(self.features, self.coefficients):
            eta = eta + F.lit(float(c)) * F.col(f).cast("double")
        return eta

    def transform(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        """H5, H6: ``proba`` (positive class), ``proba_negative`` (column 0 of
        a two-class probability matrix) and ``pred``."""
        p = _sigmoid(self.margin())
        return df.withColumns({"proba": p, "proba_negative": 1.0 - p}).withColumn(
            "pred", F.col("proba") > F.lit(threshold))

    def table(self) -> list[tuple[str, float]]:
        return [("intercept", float(self.intercept))] + [(f, float(c)) for f, c in zip(self.features, self.coefficients)]


def _xy(df: DataFrame, features: list[str], label: str) -> DataFrame:
    va = VectorAssembler(inputCols=features, outputCol="__features", handleInvalid="error")
    return va.transform(df.select(*[F.col(f).cast("double").alias(f) for f in features],
                                  F.col(label).cast("double").alias("__y")))


def fit_logistic(df: DataFrame, features: list[str], label: str = "label", C: float = 1.0,
                 max_iter: int = 200, tol: float = 1e-10) -> LogisticModel:
    """H4: L2 logistic regression with intercept (``C`` = inverse strength)."""
    n = df.count()
    lr = LogisticRegression(featuresCol="__features", labelCol="__y", regParam=1.0 / (C * n),
                            elasticNetParam=0.0, standardization=False, fitIntercept=True,
                            maxIter=max_iter, tol=tol)
    m = lr.fit(_xy(df, features, label))
    return LogisticModel(features, m.coefficients.toArray().tolist(), float(m.intercept))


def logit_inference(df: DataFrame, features: list[str], label: str = "label",
                    fit_intercept: bool = False) -> tuple[LogisticModel, DataFrame]:
    """H3: maximum-likelihood logit with an inference table ``(term, coef,
    std_err, z, p_value, conf_lo, conf_hi, log_likelihood, ll_null,
    pseudo_r2, n_obs)``.  ``ll_null`` is the base-rate (intercept-only)
    model, computed by one aggregate; note that without an intercept the sign
    of a positive-valued feature's coefficient mostly reflects the base rate."""
    glr = GeneralizedLinearRegression(family="binomial", link="logit", fitIntercept=fit_intercept,
                                      regParam=0.0, maxIter=100, tol=1e-10,
                                      featuresCol="__features", labelCol="__y")
    data = _xy(cut_lineage(df.select(*features, label)), features, label)  # read once per iteration
    m = glr.fit(data)
    s = m.summary
    terms = list(features) + (["intercept"] if fit_intercept else [])
    coefs = m.coefficients.toArray().tolist() + ([float(m.intercept)] if fit_intercept else [])
    se, z, p = s.coefficientStandardErrors, s.tValues, s.pValues
    ll = -s.deviance / 2.0
    stats = data.agg(F.count(F.lit(1)).alias("n"), F.avg("__y").alias("p")).first()
    n, pbar = stats["n"], stats["p"]
    ll0 = 0.0 if pbar in (0.0, 1.0) else n * (pbar * math.log(pbar) + (1 - pbar) * math.log(1 - pbar))
    rows = [(t, float(c), float(e), float(zz), float(pp), float(c - 1.959963984540054 * e),
             float(c + 1.959963984540054 * e), ll, ll0, 1.0 - ll / ll0 if ll0 else None, int(n))
            for t, c, e, zz, pp in zip(terms, coefs, se, z, p)]
    schema = ("term string, coef double, std_err double, z double, p_value double, conf_lo double, "
              "conf_hi double, log_likelihood double, ll_null double, pseudo_r2 double, n_obs bigint")
    model = LogisticModel(features, m.coefficients.toArray().tolist(), float(m.intercept) if fit_intercept else 0.0)
    return model, df.sparkSession.createDataFrame(rows, schema)


# ------------------------------------------------------- many models at once
def fit_logistic_groups(df: DataFrame, features: list[str], label: str, group: list[str],
                        C: float = 1.0, max_iter: int = 50, tol: float = 1e-9) -> DataFrame:
    """H4 for every group: ``(group..., intercept, <feature>...)``.

    Objective per group: ``0.5 |w|^2 + C sum(softplus(eta) - y eta)``.  Rows with a null feature or label
    are left out.  The distinct rows of each group are packed once into blocks, with their counts.  An iteration joins the coefficient table to the blocks;
    a task sends one array per group (loss, gradient, Hessian), a group's arrays are summed and solved where they
    meet, and the result is the next coefficient table.  The driver learns only whether a group is
    left that has not converged; if so after ``max_iter`` steps it raises."""
    d = len(features)
    spark = df.sparkSession
    xs = [f"__x{i}" for i in range(d)]
    data = df.select(*group, *[F.col(f).cast("double").alias(x) for x, f in zip(xs, features, strict=True)],
                     F.col(label).cast("double").alias("__y")).dropna(subset=[*xs, "__y"])
    # equal rows of a group are one row with a count: the copies that splits make of a row end here
    data = data.groupBy(*data.columns).agg(F.count(F.lit(1)).cast("double").alias("__n"))
    data = data.select(*group, F.array(*xs).alias("__x"), "__y", "__n")
    keys = [data.schema[g] for g in group]
    numbers = T.ArrayType(T.DoubleType())
    typed = lambda *fields: T.StructType([*keys, *[T.StructField(n, t) for n, t in fields]])
    packed = typed(("__x", numbers), ("__y", numbers), ("__n", numbers))
    expose_package(spark)
    # groups lie together, and Spark cuts a partition that a large one makes too big
    blocks = cut_lineage(data.hint("rebalance", *group).mapInArrow(packer(group, d, to_arrow_schema(packed)), packed))
    zeros = F.array_repeat(F.lit(0.0), d + 1)
    coefs = cut_lineage(blocks.select(*group).distinct().select(
        *group, zeros.alias("theta"), zeros.alias("step"), F.lit(math.inf).alias("objective"), F.lit(False).alias("done")))
    model = (("theta", numbers), ("step", numbers), ("objective", T.DoubleType()))
    sent, solved = typed(("state", numbers), *model, ("salt", T.IntegerType())), typed(*model, ("done", T.BooleanType()))
    for _ in range(max_iter):
        live = coefs.where("NOT done")
        if live.isEmpty():
            theta = F.col("theta")
            return coefs.select(*group, theta[0].alias("intercept"), *[theta[i + 1].alias(f) for i, f in enumerate(features)])
        renamed = live.select(*[F.col(g).alias(f"__m_{g}") for g in group], "theta", "step", "objective")
        same = F.lit(True)
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"__m_{g}"))
        states = blocks.join(renamed, same).drop(*[f"__m_{g}" for g in group]).mapInArrow(gram(group, d, to_arrow_schema(sent)), sent)
        merged = states.groupBy(*group, "salt").applyInArrow(merge, sent)
        stepped = merged.groupBy(*group).applyInArrow(newton(group, d, C, tol, to_arrow_schema(solved)), solved)
        coefs = cut_lineage(stepped.unionByName(coefs.where("done")))
    left = coefs.where("NOT done").select(*group).limit(1).collect()
    raise RuntimeError(f"not all fits converged in {max_iter} steps, e.g. {tuple(left[0]) if left else ()}")


def predict_groups(coefs: DataFrame, df: DataFrame, features: list[str], group: list[str],
                   threshold: float = 0.5) -> DataFrame:
    """Score rows with their group's coefficients (one row per group)."""
    c = coefs.select(*group, F.col("intercept").alias("__b"), *[F.col(f).alias(f"__w_{f}") for f in features])
    j = df.join(c, group)
    eta = F.col("__b")
    for f in features:
        eta = eta + F.col(f"__w_{f}") * F.col(f).cast("double")
    p = _sigmoid(eta)
    return j.withColumns({"proba": p, "proba_negative": 1.0 - p}).withColumn(
        "pred", F.col("proba") > F.lit(threshold)).drop("__b", *[f"__w_{f}" for f in features])
