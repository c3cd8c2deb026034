"""Exact kNN: both strategies against brute force, tie rules, votes."""
import numpy as np
from pyspark.sql import functions as F

from rarelab.operators.knn import knn_k_sweep, knn_neighbors, knn_vote


def _brute(train, query, cols, k, w=None, self_ex=False):
    w = w or [1.0] * len(cols)
    T = np.array([[r[c] for c in cols] for r in train], float)
    tk = np.array([r["entity_id"] for r in train])
    out = set()
    for r in query:
        d = sum(w[j] * (r[c] - T[:, j]) ** 2 for j, c in enumerate(cols))
        if self_ex:
            d = np.where(tk == r["entity_id"], np.inf, d)
        for rank, i in enumerate(np.lexsort((tk, d))[:k]):
            out.add((r["entity_id"], int(tk[i]), rank + 1))
    return out


def _data(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, bool(rng.random() < 0.2), float(rng.integers(0, 12)), float(rng.integers(0, 4)))
            for i in range(n)]  # integer features: many exact ties
    return spark.createDataFrame(rows, "entity_id long, label boolean, a double, b double")


def test_strategies_match_brute_force(spark):
    df = _data(spark)
    tr, qu = df.where("entity_id % 3 <> 0"), df.where("entity_id % 3 = 0")
    trr, qur = tr.collect(), qu.collect()
    for cols, method in ((["a"], "sorted"), (["a"], "pivots"), (["a", "b"], "pivots")):
        nb = knn_neighbors(tr, qu, cols, 7, method=method, train_block_rows=50, query_block_rows=30)
        got = {(r["entity_id"], r["neighbor_key"], r["rank"]) for r in nb.collect()}
        assert got == _brute(trr, qur, cols, 7), (cols, method)


def test_weighted_and_leave_one_out(spark):
    df = _data(spark, 200, 1)
    rows = df.collect()
    nb = knn_neighbors(df, df, ["a", "b"], 5, weights=[0.5, 3.0], exclude_self=True, method="pivots",
                       train_block_rows=64)
    got = {(r["entity_id"], r["neighbor_key"], r["rank"]) for r in nb.collect()}
    assert got == _brute(rows, rows, ["a", "b"], 5, [0.5, 3.0], self_ex=True)
    nb1 = knn_neighbors(df, df, ["a"], 5, exclude_self=True, method="sorted")
    got1 = {(r["entity_id"], r["neighbor_key"], r["rank"]) for r in nb1.collect()}
    assert got1 == _brute(rows, rows, ["a"], 5, self_ex=True)


def test_vote_tie_goes_to_lower_class(spark):
    nb = spark.createDataFrame([(1, 10, True, 1.0, 1), (1, 11, False, 1.0, 2)],
                               "entity_id long, neighbor_key long, neighbor_label boolean, distance double, rank int")
    r = knn_vote(nb).first()
    assert r["pred"] is False and r["proba"] == 0.5


def test_k_sweep_equals_separate_votes(spark):
    df = _data(spark, 150, 2)
    tr, qu = df.where("entity_id % 2 = 0"), df.where("entity_id % 2 = 1")
    nb = knn_neighbors(tr, qu, ["a"], 9)
    sweep = {(r["entity_id"], r["k"]): r["pred"] for r in knn_k_sweep(nb, [3, 5, 9]).collect()}
    for k in (3, 5, 9):
        for r in knn_vote(nb, k=k).collect():
            assert sweep[(r["entity_id"], k)] == r["pred"]


def test_split_keyed_search(spark):
    df = _data(spark, 120, 3).withColumn("split_id", (F.col("entity_id") % 3).cast("int"))
    nb = knn_neighbors(df, df, ["a"], 4, split="split_id", exclude_self=True)
    rows = df.collect()
    got = {(r["split_id"], r["entity_id"], r["neighbor_key"], r["rank"]) for r in nb.collect()}
    exp = set()
    for s in range(3):
        part = [r for r in rows if r["split_id"] == s]
        exp |= {(s,) + t for t in _brute(part, part, ["a"], 4, self_ex=True)}
    assert got == exp


def test_array_form_equals_long_form(spark):
    df = _data(spark, 120, 4)
    tr, qu = df.where("entity_id % 4 <> 0"), df.where("entity_id % 4 = 0")
    for cols in (["a"], ["a", "b"]):
        long = {(r["entity_id"], r["rank"], r["neighbor_key"]) for r in knn_neighbors(tr, qu, cols, 6).collect()}
        arr = set()
        for r in knn_neighbors(tr, qu, cols, 6, as_arrays=True).collect():
            arr |= {(r["entity_id"], i + 1, n["neighbor_key"]) for i, n in enumerate(r["neighbors"])}
        assert long == arr
        sweep = {(r["entity_id"], r["k"]): r["pred"] for r in knn_k_sweep(
            knn_neighbors(tr, qu, cols, 6, as_arrays=True), [1, 3, 5]).collect()}
        ref = {(r["entity_id"], r["k"]): r["pred"] for r in knn_k_sweep(knn_neighbors(tr, qu, cols, 6), [1, 3, 5]).collect()}
        assert sweep == ref


def test_cv_fold_exclusion_equals_replication(spark):
    from rarelab.operators.splits import stratified_folds
    from rarelab.plans.crossval import cv_knn_predictions
    df = _data(spark, 200, 5)
    folds = stratified_folds(df, "label", "entity_id", 5, seed=3, n_repeats=2)
    fast = {(r["split_id"], r["entity_id"]): (r["pred"], r["proba"])
            for r in cv_knn_predictions(folds, 5, ["a", "b"], 5).collect()}
    test = folds.withColumn("split_id", F.col("repeat") * 5 + F.col("fold"))
    train = folds.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(4)))).where("g <> fold").withColumn(
        "split_id", F.col("repeat") * 5 + F.col("g"))
    nb = knn_neighbors(train, test, ["a", "b"], 5, split="split_id", method="pivots")
    slow = {(r["split_id"], r["entity_id"]): (r["pred"], r["proba"])
            for r in knn_vote(nb, "entity_id", "split_id").collect()}
    assert fast == slow and len(fast) == 400


def _members(spark, n, seed, cols=2):
    """Rows that each train for some of four classes, integer features with many ties."""
    rng = np.random.default_rng(seed)
    rows = [(i, bool(rng.random() < 0.3), *(float(x) for x in rng.integers(0, 9, cols)), int(i % 4),
             [int(c) for c in range(4) if rng.random() < 0.6]) for i in range(n)]
    names = "abc"[:cols]
    return spark.createDataFrame(rows, "entity_id long, label boolean, " + ", ".join(f"{c} double" for c in names)
                                 + ", cls int, listed array<int>"), rows, list(names)


def test_listed_and_excluded_training_rows(spark):
    for method, cols in (("sorted", 1), ("pivots", 1), ("pivots", 2)):
        df, rows, names = _members(spark, 250, 8, cols)
        for member in ("listed", None):
            nb = knn_neighbors(df, df, names, 4, exclude_col="cls", member_col=member, method=method,
                               train_block_rows=40, query_block_rows=60)
            got = {(r["entity_id"], r["neighbor_key"], r["rank"]) for r in nb.collect()}
            want = set()
            for q in rows:
                ok = [t for t in rows if (q[-2] in t[-1] if member else q[-2] != t[-2])]
                near = sorted((sum((a - b) ** 2 for a, b in zip(q[2:2 + cols], t[2:2 + cols])), t[0]) for t in ok)[:4]
                want |= {(q[0], key, rank + 1) for rank, (_, key) in enumerate(near)}
            assert got == want, (method, cols, member)


def test_line_search_over_partitions_of_one_value(spark):
    """A third of the rows share a value, so its run fills several partitions; others hold a handful."""
    rng = np.random.default_rng(9)
    rows = [(i, bool(i % 3), 5.0 if i % 3 == 0 else float(rng.normal(5, 0.01) if i % 3 == 1 else rng.integers(-50, 50)), 0.0)
            for i in range(900)]
    df = spark.createDataFrame(rows, "entity_id long, label boolean, a double, b double")
    tr, qu = df.where("entity_id % 5 <> 0"), df.where("entity_id % 5 = 0 OR entity_id < 40")
    trr, qur = tr.collect(), qu.collect()
    for k in (1, 3, 60):
        got = {(r["entity_id"], r["neighbor_key"], r["rank"]) for r in knn_neighbors(tr, qu, ["a"], k).collect()}
        assert got == _brute(trr, qur, ["a"], k)
    words = tr.withColumn("entity_id", F.format_string("k%04d", "entity_id"))
    got = {(r["entity_id"], int(r["neighbor_key"][1:]), r["rank"]) for r in knn_neighbors(
        words, qu.withColumnRenamed("entity_id", "q"), ["a"], 3, query_key="q").withColumnRenamed("q", "entity_id").collect()}
    assert got == _brute(trr, qur, ["a"], 3)


def test_pivots_prune_and_lose_nothing(spark):
    """Clustered vectors: far fewer distances than pairs, the same neighbours; noise: the same neighbours."""
    rng = np.random.default_rng(10)
    centres = rng.standard_normal((12, 6)) * 10
    for spread, bound in ((0.3, 0.2), (30.0, 1.01)):
        rows = [(i, bool(i % 2), (centres[i % 12] + spread * rng.standard_normal(6)).tolist()) for i in range(600)]
        rows += [(600 + i, True, rows[0][2]) for i in range(150)]  # one vector many times
        df = spark.createDataFrame(rows, "entity_id long, label boolean, v array<double>")
        counter = spark.sparkContext.accumulator(0)
        nb = knn_neighbors(df, df, "v", 5, exclude_self=True, train_block_rows=150, query_block_rows=200, counter=counter)
        got = {(r["entity_id"], r["neighbor_key"], r["rank"]) for r in nb.collect()}
        x = np.array([r[2] for r in rows])
        want = set()
        for i in range(len(rows)):
            d = np.zeros(len(rows))
            for j in range(6):
                d += (x[i, j] - x[:, j]) ** 2
            d[i] = np.inf
            want |= {(i, int(t), rank + 1) for rank, t in enumerate(np.lexsort((np.arange(len(rows)), d))[:5])}
        assert got == want and counter.value <= bound * len(rows) ** 2, counter.value / len(rows) ** 2


def test_pivots_without_rows_or_neighbours(spark):
    df, _, _ = _members(spark, 30, 1)
    assert knn_neighbors(df.limit(0), df, ["a", "b"], 3).collect() == []
    assert knn_neighbors(df, df.limit(0), ["a", "b"], 3).collect() == []
    few = knn_neighbors(df.where("entity_id < 2"), df, ["a", "b"], 5)
    assert few.count() == 60 and knn_neighbors(df.where("entity_id < 2"), df, ["a"], 5).count() == 60
    alone = df.withColumn("cls", F.lit(1))
    assert knn_neighbors(alone, alone, ["a", "b"], 3, exclude_col="cls").collect() == []
    assert knn_neighbors(alone, alone, ["a"], 3, exclude_col="cls").collect() == []


def test_equal_rows_are_compared_once(spark):
    """Rows of few different points: the distances computed follow the points, not the pairs of rows, and a
    training block of equal rows leaves k of them."""
    rng = np.random.default_rng(11)
    rows = [(i, bool(i % 3 == 0), float(rng.integers(0, 4)), float(rng.integers(0, 3)), i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "entity_id long, label boolean, a double, b double, cls int")
    tr, qu = df.where("entity_id % 2 = 0"), df.where("entity_id % 2 = 1")
    counter = spark.sparkContext.accumulator(0)
    got = {(r["entity_id"], r["neighbor_key"], r["rank"]) for r in knn_neighbors(tr, qu, ["a", "b"], 4, counter=counter).collect()}
    assert got == _brute(tr.collect(), qu.collect(), ["a", "b"], 4)
    assert counter.value <= 12 * 12 * 4  # 12 points, four rows of each
    nb = knn_neighbors(df, df, ["a", "b"], 4, exclude_col="cls", counter=counter, as_arrays=True).collect()
    for r in nb[::97]:
        q = rows[r["entity_id"]]
        near = sorted(((q[2] - t[2]) ** 2 + (q[3] - t[3]) ** 2, t[0]) for t in rows if t[4] != q[4])[:4]
        assert [n["neighbor_key"] for n in r["neighbors"]] == [key for _, key in near]
    assert len(nb) == 3000 and counter.value <= 12 * 12 * 4 + 60 * 12 * 20


def test_queries_of_one_key_are_answered_together(spark):
    tr = spark.createDataFrame([(i, True, float(i), 0.0) for i in range(9)], "entity_id long, label boolean, a double, b double")
    qu = spark.createDataFrame([(1, 0.0, 0.0), (1, 8.0, 0.0), (None, 4.0, 0.0)], "entity_id long, a double, b double")
    got = {(r["entity_id"], r["neighbor_key"]) for r in knn_neighbors(tr, qu, ["a", "b"], 2).collect()}
    assert got == {(1, 0), (1, 8), (None, 4), (None, 3)}


def test_wide_vectors_sum_few_distances(spark):
    """Noise of many dimensions: a matrix product rules out nearly all pairs, near ties and copies lose nothing."""
    rng, counter = np.random.default_rng(12), spark.sparkContext.accumulator(0)
    x = rng.standard_normal((500, 24)) * 3 + 100
    x[400:450] = x[:50]  # copies
    x[450:] = x[:50] + 1e-9 * rng.standard_normal((50, 24))  # all but copies
    w = np.linspace(0.5, 2.0, 24)
    d = np.zeros((500, 500))
    for j in range(24):
        d += w[j] * ((x[:, None, j] - x[None, :, j]) * (x[:, None, j] - x[None, :, j]))
    df = spark.createDataFrame([(i, bool(i % 2), v.tolist()) for i, v in enumerate(x)], "entity_id long, label boolean, v array<double>")
    for own in (True, False):
        nb = knn_neighbors(df, df, "v", 5, weights=w, exclude_self=own, train_block_rows=200, query_block_rows=150, counter=counter)
        far = np.where(np.eye(500, dtype=bool), np.inf, d) if own else d
        want = {(i, int(t), rank + 1) for i in range(500) for rank, t in enumerate(np.lexsort((np.arange(500), far[i]))[:5])}
        assert {(r["entity_id"], r["neighbor_key"], r["rank"]) for r in nb.collect()} == want
    assert counter.value < 500 * 500 / 2  # of both searches
