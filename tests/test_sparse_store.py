"""Level codes against dense dummies; models stored, read by name and scored."""
import tempfile

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rarelab.operators.features import fit_scaler, one_hot
from rarelab.operators.knn import KnnModel, knn_neighbors
from rarelab.operators.logistic import fit_logistic
from rarelab.operators.model_store import load_model, save_model, stored_models
from rarelab.operators.sparse import encode_levels, fit_level_logistic, fit_sparse_logistic, level_table


def _rows(spark, n=240, seed=3):
    rng = np.random.default_rng(seed)
    colours = ["red", "green", "blue", None, "Red ", ""]
    rows = [(i, bool(rng.random() < (0.7 if i % 6 == 0 else 0.2)), float(rng.integers(0, 6)), colours[i % 6], int(rng.integers(0, 40)))
            for i in range(n)]
    return spark.createDataFrame(rows, "entity_id long, label boolean, x double, colour string, shop long")


def test_level_table_is_dense(spark):
    levels = level_table(_rows(spark), ["colour", "shop"])
    got = {}
    for r in levels.collect():
        got.setdefault(r["column"], {})[r["level"]] = r["code"]
    assert got["colour"] == {v: i for i, v in enumerate(sorted(["red", "green", "blue", "Red ", ""]))}
    assert sorted(got["shop"].values()) == list(range(len(got["shop"]))) and set(got["shop"]) == {
        str(r[0]) for r in _rows(spark).select("shop").distinct().collect()}


def test_codes_find_the_neighbours_of_dense_dummies(spark):
    df = _rows(spark)
    cols = ["colour", "shop"]
    coded = encode_levels(df, cols, level_table(df, cols))
    assert coded.where("colour IS NULL").select("colour_code").distinct().collect() == [(None,)]
    dense = one_hot(df.withColumn("c2", F.col("colour")).withColumn("s2", F.col("shop")), ["c2", "s2"])
    names = [c for c in dense.columns if c.startswith(("c2_", "s2_"))]
    arrayed = dense.select("entity_id", "label", F.array("x", *[F.col(f"`{c}`").cast("double") for c in names]).alias("v"))
    key = lambda r: (r["entity_id"], r["neighbor_key"], r["rank"], round(r["distance"], 9))
    got = {key(r) for r in knn_neighbors(coded, coded, ["x"], 4, codes=["colour_code", "shop_code"], exclude_self=True,
                                         train_block_rows=70).collect()}
    assert got == {key(r) for r in knn_neighbors(arrayed, arrayed, "v", 4, exclude_self=True).collect()}
    only = {key(r) for r in knn_neighbors(coded, coded, [], 3, codes=["shop_code"], code_weights=[0.5]).collect()}
    assert {r[3] for r in only} <= {0.0, 1.0} and len(only) == 3 * df.count()


def test_sparse_logistic_equals_dense(spark):
    df = _rows(spark, 600).where("colour IS NOT NULL")
    levels = level_table(df, ["colour"])
    coded = encode_levels(df, ["colour"], levels)
    model = fit_sparse_logistic(coded, ["colour_code"], levels, numbers=["x"], C=0.5)
    names = sorted(r["level"] for r in levels.collect())
    dense = df.select("label", "x", *[(F.col("colour") == v).cast("double").alias(f"d{i}") for i, v in enumerate(names)])
    want = fit_logistic(dense, ["x", *[f"d{i}" for i in range(len(names))]], C=0.5)
    got = {r["level"]: r["coef"] for r in model.level_weights(levels, "colour").collect()}
    assert [got[v] for v in names] == pytest.approx(want.coefficients[1:], abs=1e-4)
    assert model.intercept == pytest.approx(want.intercept, abs=1e-4)
    # a level that the model does not know counts as none
    odd = spark.createDataFrame([("violet", 0.0), (None, 0.0), ("red", 0.0)], "colour string, x double")
    p = [r["proba"] for r in model.transform(encode_levels(odd, ["colour"], levels)).orderBy("colour").collect()]
    assert p[0] == pytest.approx(p[2]) == pytest.approx(1 / (1 + np.exp(-model.intercept))) and p[1] != pytest.approx(p[0])


def test_level_weights_equal_a_dense_newton_fit(spark):
    df = _rows(spark, 500).withColumn("z", (F.col("entity_id") % 7) * 3.0 + F.rand(2)).cache()
    odd = spark.createDataFrame([(900, None, 1.0, "red", 1, 2.0), (901, True, None, "red", 1, 2.0)], df.schema)
    model = fit_level_logistic(df.unionByName(odd), "shop", ["x", "z"], C=0.8)
    rows = df.collect()
    shops = sorted({r["shop"] for r in rows})
    X = np.array([[1.0, r["x"], r["z"], *[float(r["shop"] == s) for s in shops]] for r in rows])
    y, w, pen = np.array([r["label"] for r in rows], float), np.zeros(3 + len(shops)), np.diag([0.0] + [1.0] * (2 + len(shops)))
    for _ in range(60):
        p = 1 / (1 + np.exp(-X @ w))
        w -= np.linalg.solve(0.8 * (X * (p * (1 - p))[:, None]).T @ X + pen, 0.8 * X.T @ (p - y) + pen @ w)
    got = {int(r["level"]): r["w"] for r in model.weights.collect()}
    assert [model.intercept, *model.coefficients, *(got[s] for s in shops)] == pytest.approx(w, abs=1e-7)
    p = 1 / (1 + np.exp(-X @ w))
    scored = {r["entity_id"]: r["proba"] for r in model.transform(df).collect()}
    assert [scored[r["entity_id"]] for r in rows] == pytest.approx(p, abs=1e-7)
    # null levels have no weight: with all of them null an intercept is left
    none = fit_level_logistic(df.withColumn("shop", F.lit(None).cast("long")), "shop")
    assert none.weights.count() == 0 and 1 / (1 + np.exp(-none.intercept)) == pytest.approx(y.mean(), abs=1e-9)
    with pytest.raises(RuntimeError):
        fit_level_logistic(df, "shop", ["x"], max_iter=2)
    with pytest.raises(ValueError):
        fit_level_logistic(df.limit(0), "shop")


def test_models_are_stored_once_and_score_alike(spark):
    root = tempfile.mkdtemp(prefix="rarelab-models-")
    df = _rows(spark)
    scaler = fit_scaler(df, ["x"])
    plain, scaled = fit_logistic(df, ["x"]), fit_logistic(scaler.transform(df), ["x"])
    knn = KnnModel(df, ["x", "shop"], k=3, weights=[1.0, 0.01])
    save_model(plain, root, "a", 1)
    save_model(scaled, root, "a", 2, scaler=scaler)
    save_model(knn, root, "b", 7)
    with pytest.raises(AnalysisException):
        save_model(plain, root, "a", 2)
    with pytest.raises(AnalysisException):
        save_model(knn, root, "b", 7)
    for bad in ("", "a/b", "*"):
        with pytest.raises(ValueError):
            save_model(plain, root, bad, 1)
    table = {(r["name"], r["version"]): r for r in stored_models(spark, root).collect()}
    assert sorted(table) == [("a", 1), ("a", 2), ("b", 7)] and table["b", 7]["n_rows"] == 240 and table["b", 7]["k"] == 3
    rows = df.select("entity_id", "x", "shop")
    scores = lambda d: {r["entity_id"]: (r["pred"], round(r["proba"], 9), r["x"]) for r in d.collect()}
    assert scores(load_model(spark, root, "a", 1).transform(rows)) == scores(plain.transform(rows))
    latest = load_model(spark, root, "a")
    assert latest.row["version"] == 2 and scores(latest.transform(rows)) == {
        k: (*v[:2], x) for (k, v), (_, x) in zip(sorted(scores(scaled.transform(scaler.transform(rows))).items()),
                                                 sorted((r["entity_id"], r["x"]) for r in rows.collect()))}
    assert scores(load_model(spark, root, "b").transform(rows)) == scores(knn.transform(rows))
    with pytest.raises(LookupError):
        load_model(spark, root, "c")
    with pytest.raises(LookupError):
        load_model(spark, root, "a", 9)


def test_codes_of_many_levels_compare_no_pairs(spark):
    """Levels as many as rows are equally far from each other, which no pivot prunes: no distance of a pair is computed."""
    rng = np.random.default_rng(5)
    rows = [(i, bool(rng.random() < 0.3), float(rng.integers(0, 5)), int(rng.integers(-1, 3)), int(rng.integers(-1, 150))) for i in range(400)]
    rows += [(400 + i, True, 2.0, None, i) for i in range(20)]  # null is no level either
    df = spark.createDataFrame(rows, "entity_id long, label boolean, x double, a int, b int")
    tr, qu = df.where("entity_id % 3 <> 0"), df.where("entity_id % 3 = 0")
    for feats, x_weight in ((["x"], 0.3), ([], 0.0)):
        counter = spark.sparkContext.accumulator(0)
        nb = knn_neighbors(tr, qu, feats, 4, codes=["a", "b"], code_weights=[1.0, 0.5], weights=[x_weight] * len(feats), counter=counter)
        got = {(r["entity_id"], r["neighbor_key"], r["rank"], round(r["distance"], 9)) for r in nb.collect()}
        level = lambda z: -1 if z is None else z
        gap = lambda p, q: (level(p) != level(q)) * ((level(p) >= 0) + (level(q) >= 0))
        want = set()
        for q in rows[::3]:
            near = sorted((x_weight * (q[2] - t[2]) ** 2 + gap(q[3], t[3]) + 0.5 * gap(q[4], t[4]), t[0]) for t in rows if t[0] % 3)[:4]
            want |= {(q[0], key, rank + 1, round(d ** 0.5, 9)) for rank, (d, key) in enumerate(near)}
        assert got == want
        assert counter.value == 0
