"""Logistic fits against a numpy Newton solution of the same objective."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from rarelab.operators.logistic import fit_logistic, fit_logistic_groups, logit_inference


def _newton(x, y, C=1.0):
    X = np.c_[np.ones(len(x)), x]
    th = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-X @ th))
        g = C * X.T @ (p - y)
        g[1:] += th[1:]
        H = C * X.T @ (X * (p * (1 - p))[:, None])
        H[1:, 1:] += 1.0
        th -= np.linalg.solve(H, g)
    return th


def _data(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 2, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x - 2)))).astype(float)
    rows = [(i, float(x[i]), bool(y[i]), i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "entity_id long, x double, label boolean, g int"), x, y


def test_spark_ml_and_batched_match_newton(spark):
    df, x, y = _data(spark)
    th = _newton(x, y)
    m = fit_logistic(df, ["x"])
    assert m.intercept == pytest.approx(th[0], abs=1e-5) and m.coefficients[0] == pytest.approx(th[1], abs=1e-5)
    groups = {r["g"]: r for r in fit_logistic_groups(df, ["x"], "label", ["g"]).collect()}
    for g in range(3):
        sel = np.arange(len(x)) % 3 == g
        tg = _newton(x[sel], y[sel])
        assert groups[g]["intercept"] == pytest.approx(tg[0], abs=1e-6)
        assert groups[g]["x"] == pytest.approx(tg[1], abs=1e-6)


def test_inference_no_intercept(spark):
    df, x, y = _data(spark, seed=1)
    _, tab = logit_inference(df, ["x"], fit_intercept=False)
    r = tab.first()
    b = 0.0
    for _ in range(100):  # unpenalised Newton, no intercept
        p = 1 / (1 + np.exp(-x * b))
        b -= (x @ (p - y)) / (x @ (x * p * (1 - p)))
    p = 1 / (1 + np.exp(-x * b))
    assert r["coef"] == pytest.approx(b, abs=1e-6)
    assert r["std_err"] == pytest.approx(1 / np.sqrt(x @ (x * p * (1 - p))), rel=1e-4)
    ll = float(np.sum(y * np.log(p) + (1 - y) * np.log(1 - p)))
    assert r["log_likelihood"] == pytest.approx(ll, rel=1e-6)


def test_proba_columns(spark):
    df, _, _ = _data(spark, seed=2)
    out = fit_logistic(df, ["x"]).transform(df).select(
        (F.abs(F.col("proba") + F.col("proba_negative") - 1) < 1e-12).alias("ok"), "pred", "proba").collect()
    assert all(r["ok"] and r["pred"] == (r["proba"] > 0.5) for r in out)


def test_many_groups_and_features(spark):
    """Each group's model equals a Newton fit of its own; one group holds most rows, one has a constant feature."""
    from rarelab.operators.logistic import fit_logistic_groups
    rng = np.random.default_rng(12)
    d, rows = 12, []
    for g in range(40):
        n = 6000 if g == 7 else 30
        x = rng.standard_normal((n, d)) * (0 if g == 3 else 1)
        y = rng.random(n) < 1 / (1 + np.exp(-(x @ np.linspace(-1, 1, d))))
        rows += [(f"g{g}" if g else None, bool(t), *map(float, r)) for r, t in zip(x, y)]
    rows += [("g1", None, *[0.0] * d), ("g1", True, *[None] * d)]  # left out
    names = [f"f{i}" for i in range(d)]
    df = spark.createDataFrame(rows, "seg string, label boolean, " + ", ".join(f"{n} double" for n in names))
    got = {r["seg"]: np.array(r[1:]) for r in fit_logistic_groups(df, names, "label", ["seg"], C=0.7).collect()}
    assert len(got) == 40
    for seg in (None, "g1", "g3", "g7", "g20"):
        mine = [r for r in rows if r[0] == seg and None not in r[1:]]
        X, t = np.array([[1.0, *r[2:]] for r in mine]), np.array([r[1] for r in mine], float)
        w, pen = np.zeros(d + 1), np.diag([0.0] + [1.0] * d)
        for _ in range(60):
            p = 1 / (1 + np.exp(-X @ w))
            w -= np.linalg.solve(0.7 * (X * (p * (1 - p))[:, None]).T @ X + pen, 0.7 * X.T @ (p - t) + pen @ w)
        assert got[seg] == pytest.approx(w, abs=1e-6)
