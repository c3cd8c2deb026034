import hashlib
import math

import duckdb
import numpy as np
import pytest

from rarelab.llm import centroids as m
from rarelab.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, centroids, rounds, dim):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    at = [list(v) for _, v in start[:centroids]]
    dist = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min((dist(v, c), k) for k, c in enumerate(at))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for k in range(len(at)):
            mine = [v for (_, v), o in zip(kept, of) if o == k]
            if mine:
                at[k] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [(i, *near(v)) for i, v in kept]
    own = [sum(d for _, d, k in last if k == j) for j in range(len(at))]
    return sorted([(i, k, d, own[k], sum(own), hashlib.sha256(",".join(map(str, at[k])).encode()).hexdigest())
                   for i, d, k in last], key=repr)


def rows_of(df):
    return sorted([tuple(r)[:6] for r in df.collect()], key=repr)


def sample(rng, n, dim, spread=0.1):
    centres = rng.standard_normal((7, dim))
    return [(i, (centres[i % 7] + spread * rng.standard_normal(dim)).tolist(), i % 3) for i in range(n)]


def test_clusters_and_pruning(spark):
    rows = sample(np.random.default_rng(3), 400, 64)
    got = m.centroid_clusters(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(got) == brute(rows, 40, 5, 64)
    assert got.agg({"n_verified": "avg"}).first()[0] < 20  # of 40 centroids


@pytest.mark.parametrize("spread", [0.0, 3.0])
def test_ties_and_noise(spark, spread):
    """Equal vectors give equal centroids: the smaller number wins and the others stay empty."""
    rows = sample(np.random.default_rng(4), 90, 6, spread)
    assert rows_of(m.centroid_clusters(spark.createDataFrame(rows, SCHEMA), 12, 4, 6)) == brute(rows, 12, 4, 6)


def test_messy_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, (rng.standard_normal(4) * 50).tolist(), None) for i in range(20)]
    rows = good + [(30, None, 1), (31, [], 1), (32, [1.0] * 3, 1), (33, [1.0, None, 1.0, 1.0], 1), (34, [float("nan")] * 4, 1),
                   (35, [float("inf"), 0.0, 0.0, 0.0], 1), (None, [1.0, 2.0, 3.0, 4.0], 1), (None, None, None),
                   (3, good[3][1], 1), (3, [0.0] * 4, 1), (36, [-0.001, -0.0, 0.0, 0.001], 1), (-7, [1000.0] * 4, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("v", "x", "lead", "rest", "cluster", "distance", "n", "total", "i"):
        df = df.withColumn(c, df["label"])
    assert rows_of(m.centroid_clusters(df, 8, 3, 4)) == brute(rows, 8, 3, 4)
    assert rows_of(m.centroid_clusters(df, 50, 2, 4)) == brute(rows, 50, 2, 4)  # fewer vectors than centroids
    huge = spark.createDataFrame([(1, [3e5] * 4, 0), (2, [1e6, 0.0, 0.0, 0.0], 0), (3, [-5e5] * 4, 0)], SCHEMA)
    assert rows_of(m.centroid_clusters(huge, 1, 2, 4)) == brute([(1, [3e5] * 4), (3, [-5e5] * 4)], 1, 2, 4)


def test_nothing(spark):
    got = m.centroid_clusters(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns[:3] == ["vec_id", "cluster", "distance"]


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    got = QUERIES["op11_centroid_clusters"](spark, SF_SMALL)
    want = con.execute(ORACLES["op11_centroid_clusters"])
    assert [d[0] for d in want.description] == got.columns
    assert rows_of(got) == sorted(want.fetchall(), key=repr)
