"""Centroid clustering of vectors in integers, with PCA-rotated filtering.

Components become integers, so sums, means and distances are exact and do not
depend on how Spark deals the rows.  One pass gathers the co-moments of all
vectors; their principal axes give a rotation.  Every vector is written down
with its leading rotated coordinates and the norm of the others.  In a round,

    |lead(x) - lead(c)|^2 + (rest(x) - rest(c))^2  <=  |x - c|^2

bounds a vector's distance to every centroid from below.  The centroid of the
lowest bound is measured in integers, and only centroids whose bound does not
exceed that distance are measured after it: the rotation changes the work, never
the result.  A task sends one row of sums per cluster; centroids are the only
thing the driver holds."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelab.llm.common import column, map_arrow, pieces
from rarelab.session import cut_lineage

DIM, CENTROIDS, ROUNDS = 64, 40, 5
SCALE = 256  # a component x becomes floor(SCALE * x)
LARGEST = 1 << 27  # integers below it: every squared distance of 64 components fits 64 bits
LEAD = 16  # rotated coordinates kept beside the norm of the others
SLACK = 1e-6  # of both squared norms: above the rounding of coordinates kept as 32-bit floats
STEP = 1024  # vectors filtered at a time


def _matrix(table: pa.Table, name: str, width: int) -> np.ndarray:
    """A list column whose lists all have ``width`` members as rows of a matrix."""
    return column(table, name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _moments(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, cross = 0, np.zeros(dim), np.zeros((dim, dim))
        for piece in pieces(batches):
            x = _matrix(piece, "v", dim).astype(np.float64)
            n, total, cross = n + len(x), total + x.sum(axis=0), cross + x.T @ x
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array(total),
                pa.array(list(cross), pa.list_(pa.float64()))], ["i", "n", "total", "cross"])
    return run


def principal_axes(kept: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray] | None:
    """``(mean, axes)`` of all vectors, the axis of the largest variance first; None without vectors."""
    part = map_arrow(kept.select("v"), _moments(dim), "i int, n bigint, total double, cross array<double>")
    rows = part.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.array(
        *[F.sum(F.col("cross")[j]) for j in range(dim)]).alias("cross")).orderBy("i").collect()  # dim rows
    if not rows:
        return None
    n = rows[0]["n"]
    mean = np.asarray([r["total"] for r in rows]) / n
    spread = np.asarray([r["cross"] for r in rows]) / n - np.outer(mean, mean)
    return mean, np.linalg.eigh((spread + spread.T) / 2)[1][:, ::-1]


def rotated(x: np.ndarray, mean: np.ndarray, axes: np.ndarray, lead: int = LEAD) -> tuple[np.ndarray, np.ndarray]:
    """The leading rotated coordinates of rows and the norm of the others."""
    y = (x - mean) @ axes
    return y[:, :lead], np.linalg.norm(y[:, lead:], axis=1)


def _rotate(dim: int, mean: np.ndarray, axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            lead, rest = rotated(_matrix(piece, "v", dim).astype(np.float64), mean, axes)
            yield pa.RecordBatch.from_arrays([
                column(piece, "vec_id"), column(piece, "v"), pa.array(list(lead.astype(np.float32)), pa.list_(pa.float32())),
                pa.array(rest.astype(np.float32))], ["vec_id", "v", "lead", "rest"])
    return run


class Nearest:
    """Exact nearest centroids; ``verified`` counts the centroids measured for each vector."""

    def __init__(self, centroids: np.ndarray, mean: np.ndarray, axes: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        self.lead, self.rest = rotated(self.centroids.astype(np.float64), mean, axes)
        self.norm = (self.lead ** 2).sum(axis=1) + self.rest ** 2

    def _exact(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        diff = x - self.centroids[which]
        return np.einsum("ij,ij->i", diff, diff)

    def find(self, x: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(cluster, distance, verified)`` of integer rows; ties go to the smaller number."""
        parts = [self._find(x[a:a + STEP], lead[a:a + STEP], rest[a:a + STEP]) for a in range(0, len(x), STEP)]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _find(self, x, lead, rest):
        own = (lead ** 2).sum(axis=1)
        low = own[:, None] + (self.lead ** 2).sum(axis=1) - 2 * (lead @ self.lead.T) + (rest[:, None] - self.rest) ** 2
        low -= SLACK * ((own + rest ** 2)[:, None] + self.norm) + SLACK
        first = low.argmin(axis=1)
        upper = self._exact(x, first)
        open_ = low <= upper[:, None]
        open_[np.arange(len(x)), first] = False
        found = np.full(low.shape, np.iinfo(np.int64).max)
        found[np.arange(len(x)), first] = upper
        i, j = np.nonzero(open_)
        found[i, j] = self._exact(x[i], j)
        best = found.argmin(axis=1)
        return best, found[np.arange(len(x)), best], open_.sum(axis=1) + 1


def _reader(dim: int, shared) -> Callable:
    def nearest(piece: pa.Table):
        x = _matrix(piece, "v", dim).astype(np.int64)
        rest = column(piece, "rest").to_numpy(zero_copy_only=False).astype(np.float64)
        return x, shared.value.find(x, _matrix(piece, "lead", min(LEAD, dim)).astype(np.float64), rest)
    return nearest


def _sums(dim: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest, k = _reader(dim, shared), len(shared.value.centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for piece in pieces(batches):
            x, (cluster, _, _) = nearest(piece)
            count += np.bincount(cluster, minlength=k)
            np.add.at(total, cluster, x)
        some = np.flatnonzero(count)
        if len(some):
            yield pa.RecordBatch.from_arrays([
                pa.array(some.astype(np.int32)), pa.array(count[some]),
                pa.array(list(total[some]), pa.list_(pa.int64()))], ["cluster", "n", "total"])
    return run


def _assigner(dim: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = _reader(dim, shared)
        for piece in pieces(batches):
            _, (cluster, distance, verified) = nearest(piece)
            yield pa.RecordBatch.from_arrays([
                column(piece, "vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance),
                pa.array(verified.astype(np.int32))], ["vec_id", "cluster", "distance", "n_verified"])
    return run


def centroid_clusters(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM,
                      id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, n_verified``.

    Kept are vectors of exactly ``dim`` components, none null or non-finite
    (nor of 2^19 or more, whose squared distances need not fit a long); each
    component becomes ``floor(256 * x)``.  The first centroids are the vectors
    with the smallest sha256 of ``2:<id>``, in that order; of rows that repeat an
    id the one with the smaller components comes first, and rows without an id
    come after all others.  With fewer vectors there are fewer centroids.  In
    each round vectors go to the nearest centroid (squared Euclidean distance,
    ties to the smaller number) and centroids become ``floor(sum / count)`` of
    theirs; an empty one stays.  Then vectors are assigned once more.

    ``n_verified`` is the number of centroids measured for the row in that last
    pass.  Sums that a long cannot hold are null.  Repeated rows count each; an
    empty table gives an empty result."""
    x = F.col("x")
    small = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float(LARGEST // SCALE))))
    kept = (vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
            .where((F.size(x) == dim) & small)
            .select("vec_id", F.transform(x, lambda c: F.floor(c * F.lit(float(SCALE))).cast("int")).alias("v")))
    spark = vectors.sparkSession
    axes = principal_axes(kept, dim)
    if axes is None:
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, "
                                         "inertia bigint, centroid_sha256 string, n_verified int")
    rows = cut_lineage(map_arrow(kept, _rotate(dim, *axes), "vec_id bigint, v array<int>, lead array<float>, rest float"))
    key = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(key.asc_nulls_last(), "v").limit(centroids).select("v").collect()
    at = np.asarray([r["v"] for r in first], dtype=np.int64)
    share = spark.sparkContext.broadcast  # `centroids` vectors
    for _ in range(rounds):
        part = map_arrow(rows, _sums(dim, share(Nearest(at, *axes))), "cluster int, n bigint, total array<bigint>")
        for r in part.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(
                *[F.sum(F.col("total")[j]) for j in range(dim)]).alias("total")).collect():  # one row per centroid
            at[r["cluster"]] = [t // r["n"] for t in r["total"]]
    found = cut_lineage(map_arrow(rows, _assigner(dim, share(Nearest(at, *axes))),
                                  "vec_id bigint, cluster int, distance bigint, n_verified int"))
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    sums = {r["cluster"]: int(r["d"]) for r in sums}
    fits = lambda n: n if n < 1 << 63 else None
    table = spark.createDataFrame(
        [(k, fits(d), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, at[k].tolist())).encode()).hexdigest())
         for k, d in sums.items()], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select(  # a row per centroid at most
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_verified")


def sql_clusters(centroids: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM) -> str:
    """DuckDB SQL of :func:`centroid_clusters`, every vector measured against every centroid, over ``embeddings``."""
    nearest = """a{r} AS (
  SELECT vec_id, v, min_by(k, (d, k)) AS k, min(d) AS d FROM (
    SELECT vec_id, v, rid, k, CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM kept, c{r}) GROUP BY rid, vec_id, v)"""
    update = """c{s} AS (
  SELECT k, CASE WHEN any_value(m.c) IS NULL THEN any_value(c{r}.c) ELSE any_value(m.c) END AS c
  FROM c{r} LEFT JOIN (
    SELECT k, list(m ORDER BY i) AS c FROM (
      SELECT k, i, CAST(sum(v[i]) // count(*) - CASE WHEN sum(v[i]) < 0 AND sum(v[i]) % count(*) <> 0 THEN 1 ELSE 0 END
                        AS BIGINT) AS m
      FROM a{r}, range(1, {dim} + 1) t(i) GROUP BY k, i) GROUP BY k) m USING (k) GROUP BY k)"""
    steps = []
    for r in range(rounds):
        steps += [nearest.format(r=r), update.format(r=r, s=r + 1, dim=dim)]
    return f"""
WITH kept AS (
  SELECT vec_id, row_number() OVER () AS rid,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS k, v AS c FROM kept
  QUALIFY k < {centroids}),
{", ".join(steps)},
{nearest.format(r=rounds)}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (k)"""
