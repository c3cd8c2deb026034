import numpy as np
import pytest

from rarelab.llm import embedding_dedup as m
from tests.conftest import SF_CV

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    ok = [i for i, (k, v, label) in enumerate(rows) if k is not None and v and label is not None and None not in v
          and np.isfinite(v).all() and np.any(np.asarray(v) != 0)]
    unit = {i: np.asarray(rows[i][1], np.float32).astype(np.float64) for i in ok}
    unit = {i: x / np.linalg.norm(x) for i, x in unit.items()}
    links, root = {i: 0 for i in range(len(rows))}, list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p, a in enumerate(ok):
        for b in ok[p + 1:]:
            if rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    out = []
    for i, (k, _, _) in enumerate(rows):
        low = min((rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None), default=None)
        out.append((k, links[i], low, k is None or k == low))
    return sorted(out, key=repr)


def clusters(rng, dim, sizes, spread):
    rows = []
    for size in sizes:
        centre = rng.standard_normal(dim)
        for _ in range(size):
            v = centre + spread * rng.standard_normal(dim) * np.linalg.norm(centre) / np.sqrt(dim)
            rows.append((len(rows) * 3, (v * rng.uniform(0.5, 2)).astype(np.float32).tolist(), int(rng.integers(0, 2))))
    return rows


@pytest.mark.parametrize("block", [1024, 6])
def test_clusters(spark, monkeypatch, block):
    monkeypatch.setattr(m, "BLOCK", block)
    rng = np.random.default_rng(1)
    rows = clusters(rng, 24, [40, 25, 10, *[2] * 20, *[1] * 100], 0.2)
    rows += [(5000 + i, rows[0][1], rows[0][2]) for i in range(30)]  # equal vectors
    got = sorted([tuple(r) for r in m.embedding_dedup(spark.createDataFrame(rows, SCHEMA)).collect()], key=repr)
    truth = brute(rows)
    total, found = sum(r[1] for r in truth), sum(r[1] for r in got)
    assert total > 1000 and 0.99 * total <= found <= total
    assert all(a[1] <= b[1] for a, b in zip(got, truth))  # nothing below the threshold
    assert sum(a == b for a, b in zip(got, truth)) >= 0.97 * len(rows)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    n, dim = 1500, 64
    a = rng.standard_normal((n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((n, dim))
    b -= (b * a).sum(1, keepdims=True) * a
    b = 0.93 * a + np.sqrt(1 - 0.93 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    for size in (1000, 50_000, 1_000_000):
        plan = m.plan(size, 0.93, dim)
        one, two = m.passed_filters(a, plan), m.passed_filters(b, plan)
        assert np.mean([len(np.intersect1d(x, y)) > 0 for x, y in zip(one, two)]) >= 0.995
        # a filter is passed by about the planned share of unrelated vectors
        assert np.mean([len(x) for x in one]) / (plan.tables * plan.words ** 2) < 2 * min(0.02, m.UNRELATED / size)


def test_passed_filters_are_the_listed_directions():
    rng = np.random.default_rng(3)
    unit = rng.standard_normal((30, 10))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    plan = m.Filters(words=7, bar=0.38, tables=2)
    got = m.passed_filters(unit, plan)
    for k, u in enumerate(unit):
        expected = set()
        for table in range(2):
            rotation, one, two = m._code(10, 7, 3 + table)
            t = u @ rotation
            scores = {49 * table + 7 * i + j: (t[:5] @ one[i] + t[5:] @ two[j]) / np.sqrt(2) for i in range(7) for j in range(7)}
            expected |= {f for f, s in scores.items() if s >= 0.38} | {max(scores, key=scores.get)}
        assert set(got[k].tolist()) == expected


def test_table(spark):
    df = spark.read.parquet(f"{SF_CV}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert sorted([tuple(r) for r in m.embedding_dedup(df).collect()], key=repr) == brute(rows)


def test_messy_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [2.0, 0.0], 1), (4, [2.0, -0.0], 0), (5, None, 0), (6, [], 0), (7, [0.0, 0.0], 0),
            (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [None, 1.0], 0), (11, [1.0, 0.0], None), (None, [1.0, 0.0], 0),
            (12, [1.0, 0.0, 0.0], 0), (12, [1.0, 0.0, 0.0], 0), (13, [-1.0, 0.0], 0), (14, [1.0], 3), (15, [5.0], 3), (16, [1e-30, 0.0], 0),
            (17, [1e30, 1e29], 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS node", "'x' AS vec", "1 AS copies", "2 AS filter", "3 AS n")
    assert sorted([tuple(r) for r in m.embedding_dedup(df).collect()], key=repr) == brute(rows)
    assert m.embedding_dedup(spark.createDataFrame([], SCHEMA)).collect() == []
