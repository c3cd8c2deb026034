"""Neighbours among other classes, block by block: against brute force, and what a grid search writes."""
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from rarelab.operators import knn_blocks
from rarelab.operators.knn import knn_neighbors
from rarelab.plans.crossval import cv_knn_sweep


def _frame(spark, x, fold, label, repeat=None):
    names = [f"f{j}" for j in range(x.shape[1])]
    rows = [(int(r), i, int(c) if c is not None else None, bool(y), *[None if v is None else float(v) for v in values])
            for i, (r, c, y, values) in enumerate(zip(repeat if repeat is not None else [0] * len(x), fold, label, x, strict=True))]
    return spark.createDataFrame(rows, "repeat int, entity_id long, fold int, label boolean, " + ", ".join(f"{n} double" for n in names)), names


def _brute(x, fold, label, k, w, repeat=None):
    """Per row the (key, label, squared distance) of its neighbours in (distance, key) order."""
    repeat = np.zeros(len(x), int) if repeat is None else np.asarray(repeat)
    fold = np.array([-1 if c is None else c for c in fold])
    known = np.array([all(v is not None and v == v for v in row) for row in x])
    out = {}
    for i in np.flatnonzero(known):
        other = np.flatnonzero(known & (fold != fold[i]) & (repeat == repeat[i]))
        d = np.zeros(len(other))
        with np.errstate(all="ignore"):
            for j in range(x.shape[1]):
                diff = float(x[i, j]) - np.array([float(x[o, j]) for o in other])
                d += (diff * diff) * w[j]
        ok = np.isfinite(d)
        other, d = other[ok], d[ok]
        first = np.lexsort((other, d))[:k]
        if len(first):
            out[int(i)] = [(int(other[a]), bool(label[other[a]])) for a in first]
    return out


def _found(df, names, k, w, **kw):
    nb = knn_neighbors(df, df.withColumnRenamed("entity_id", "q"), names, k, query_key="q", split="repeat", weights=w,
                       exclude_col="fold", as_arrays=True, method="blocks", **kw)
    return {r["q"]: [(n["neighbor_key"], n["neighbor_label"]) for n in r["neighbors"]] for r in nb.collect()}


def _case(kind, n=500):
    rng = np.random.default_rng(7)
    fold, label, repeat = rng.integers(0, 4, n), rng.random(n) < 0.2, None
    x = rng.normal(size=(n, 3))
    if kind == "ties":
        x = rng.integers(0, 4, (n, 2)).astype(float)
    elif kind == "hot":
        x[: n // 2] = 0.25
    elif kind == "folds apart":  # a leaf's own rows are mostly of the queries' fold
        fold = (x[:, 0] > 0).astype(int)
    elif kind == "far":
        x[:, 0] = 1e9 + x[:, 0]
    elif kind == "huge":
        x[::50, 1] = 1e200
        x[::70, 2] = np.inf
        x[1::70, 2] = -np.inf
    elif kind == "repeats":
        repeat = np.arange(n) % 3
    elif kind == "gaps":
        x = x.astype(object)
        x[::9, 0], x[::11, 1] = None, float("nan")
        fold = [None if i % 13 == 0 else int(c) for i, c in enumerate(fold)]
    elif kind == "wide":
        x = np.concatenate((x, np.eye(6)[rng.integers(0, 6, n)], np.eye(5)[rng.integers(0, 5, n)]), axis=1)
    return x, fold, label, repeat


@pytest.mark.parametrize("kind", ["plain", "ties", "hot", "folds apart", "far", "huge", "repeats", "gaps", "wide"])
def test_blocks_match_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(knn_blocks, "LEAF_QUERIES", 20)
    x, fold, label, repeat = _case(kind)
    df, names = _frame(spark, x, fold, label, repeat)
    w = [1.0, 0.3, 2.0, *[1.0] * 20][:len(names)]
    assert _found(df, names, 9, w, query_block_rows=60) == _brute(x, fold, label, 9, w, repeat)


def test_fewer_rows_than_neighbours(spark):
    x, fold, label, _ = _case("plain", 12)
    df, names = _frame(spark, x, fold, label)
    assert _found(df, names, 50, [1.0] * 3) == _brute(x, fold, label, 50, [1.0] * 3)
    assert _found(df.where("fold = 1"), names, 3, [1.0] * 3) == {}
    assert _found(df.limit(0), names, 3, [1.0] * 3) == {}


def test_grid_of_several_features_equals_brute_force(spark):
    x, fold, label, _ = _case("wide", 300)
    x[:, :3] = np.round(x[:, :3], 1)  # some test rows are equal
    x[150:200] = x[100:150]
    df, names = _frame(spark, x, fold, label)
    ks = [1, 3, 8]
    got = {(r["split_id"], r["k"]): (r["accuracy"], r["n"]) for r in cv_knn_sweep(df, 4, names, ks).collect()}
    near = _brute(x, fold, label, max(ks), [1.0] * len(names))
    for f in range(4):
        mine = [i for i in range(len(x)) if fold[i] == f]
        for k in ks:
            right = [(2 * sum(y for _, y in near[i][:k]) > k) == bool(label[i]) for i in mine]
            assert got[f, k] == (pytest.approx(np.mean(right)), len(mine))


def test_a_training_row_goes_to_few_blocks():
    rng = np.random.default_rng(1)
    root, x, k = np.ones(2), rng.random((8000, 2)), 10
    tree = knn_blocks.Tree(x, 160)
    leaf = tree.place(x)
    assert tree.leaves == 160 and np.bincount(leaf).max() <= 100
    leaves = []
    for m in range(tree.leaves):
        one, at = knn_blocks._Leaf(root), leaf == m
        one.rows(x[at], np.arange(at.sum()) % 5)
        one.queries(x[at], np.arange(at.sum()) % 5, k)
        leaves.append(one.summary(0, m))
    plan = knn_blocks._Plan(leaves, tree.leaves, k, 400, 0)
    rows = pa.RecordBatch.from_pydict({"__s": np.zeros(len(x), np.int64), "__x": x.tolist()})
    schema = pa.schema([("__s", pa.int64()), ("__m", pa.int64()), ("__o", pa.int32()), ("__b", pa.int64()), ("__x", pa.list_(pa.float64()))])
    sent = pa.Table.from_batches(knn_blocks._sender(tree, root, {0: plan}, schema)([rows]))
    home = sent.filter(pa.compute.equal(sent["__o"], knn_blocks.HOME))
    assert plan.end >= 20 and home.num_rows == len(x) and sent.num_rows < 4 * len(x)


def _shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()))


def test_a_grid_writes_less_than_its_lists_of_neighbours(spark):
    """Distinct rows: what a search leaves in the shuffle folder is of the size of its rows, not of rows times neighbours."""
    n, k = 20000, 99
    df = spark.range(n).select(
        F.lit(0).alias("repeat"), F.col("id").alias("entity_id"), (F.col("id") % 5).cast("int").alias("fold"), (F.rand(3) < 0.1).alias("label"),
        *[F.randn(10 + j).alias(f"f{j}") for j in range(2)])
    df = df.checkpoint()
    before = _shuffled(spark)
    scores = cv_knn_sweep(df, 5, ["f0", "f1"], list(range(3, k + 1, 2))).collect()
    assert len(scores) == 5 * 49 and sum(r["n"] for r in scores) == n * 49
    assert _shuffled(spark) - before < n * k * 8  # a key for every neighbour, once
