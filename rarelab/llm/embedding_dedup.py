"""Embedding near-dedup by spherical-cap filters.

A filter is a direction on the sphere; a vector passes it when their inner
product reaches a bar.  The directions form a product code: after a random
rotation a vector is cut in two halves, each half has its own random code, and
every pair of code words is a direction.  So the filters that a vector passes are
list-decoded from two short score lists instead of being tried one by one.
Vectors of one label that pass a common filter are compared by their exact
cosine.  The bar follows the number of vectors, so that an unrelated vector
meets about :data:`UNRELATED` others per filter at every size, and the number of
filters follows from the bar and the chosen miss probability at the threshold.

Equal vectors are one node with a count.  Buckets are cut into blocks, so a
bucket of any size becomes many small tasks; inside a task the cosines are one
matrix product, links are counted where they lie and only sums and a spanning
forest leave it.  A pair that shares several filters counts in the lowest one."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelab.llm.blocks import forest, grouped, shared_counts, sides
from rarelab.llm.common import column, map_arrow, pieces
from rarelab.llm.components import connected_components
from rarelab.session import cut_lineage

UNRELATED = 64  # unrelated vectors that pass a filter, about
MISS = 1e-4  # probability that a pair at the threshold shares no filter, about
TABLES = 16  # independent product codes; one alone serves some vectors with few filters
BLOCK = 1024  # vectors of a bucket that one task compares with as many others


@dataclass(frozen=True)
class Filters:
    """``tables`` codes of ``words`` code words per half; a filter is passed at an inner
    product of ``bar``."""

    words: int
    bar: float
    tables: int = TABLES


def _caps(dim: int, cells: int = 20_001) -> tuple[np.ndarray, np.ndarray]:
    """Grid of inner products with a fixed direction and, for a random unit vector of that dimension, the
    probability of reaching each."""
    x = np.linspace(-1, 1, cells)
    weight = (1 - x[1:-1] ** 2) ** ((dim - 3) / 2) if dim > 2 else np.ones(cells - 2)
    tail = np.concatenate(([1.0], np.cumsum(weight[::-1])[::-1] / weight.sum(), [0.0]))
    return x, tail


@lru_cache(64)
def plan(n: int, threshold: float, dim: int, unrelated: float = UNRELATED, miss: float = MISS,
         tables: int = TABLES) -> Filters:
    """Bar and number of filters for ``n`` vectors of a dimension.

    ``unrelated / n`` of all vectors pass a filter.  Given that one of a pair
    at the threshold passes, the other does with probability q; with t passed
    filters per vector the pair shares none with probability exp(-q t)."""
    p = min(0.02, unrelated / max(n, 1))
    x, tail = _caps(dim)
    bar = min(float(x[np.searchsorted(-tail, -p)]), 0.99)
    s = np.linspace(bar, 0.999, 400)
    density = np.interp(s[:-1], x, tail) - np.interp(s[1:], x, tail)
    mid = (s[:-1] + s[1:]) / 2
    y, rest = _caps(max(dim - 1, 2))
    second = np.interp((bar - threshold * mid) / np.sqrt((1 - threshold ** 2) * (1 - mid ** 2)), y, rest)
    q = float((density * second).sum() / density.sum()) if density.sum() > 0 else 1.0
    passed = math.log(1 / miss) / q
    return Filters(max(2, math.ceil(math.sqrt(passed / p / tables))), bar, tables)


@lru_cache(64)
def _code(dim: int, words: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotation and the unit code words of both halves."""
    rng = np.random.default_rng([seed, dim, words])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    first, second = dim - dim // 2, dim // 2
    codes = [rng.standard_normal((words, size)) for size in (first, max(second, 1))]
    codes = [c / np.linalg.norm(c, axis=1, keepdims=True) for c in codes]
    return rotation, codes[0], codes[1][:, :second] if second else np.zeros((words, 0))


def passed_filters(unit: np.ndarray, filters: Filters, seed: int = 3) -> list[np.ndarray]:
    """Sorted numbers of the filters that each unit vector passes; each table's best one in any case."""
    dim, words = unit.shape[1], filters.words
    need = filters.bar * math.sqrt(2)
    out: list[list[np.ndarray]] = [[] for _ in unit]
    for table in range(filters.tables):
        rotation, one, two = _code(dim, words, seed + table)
        turned = unit @ rotation
        a, b = turned[:, :one.shape[1]] @ one.T, turned[:, one.shape[1]:] @ two.T
        for k, (s, t) in enumerate(zip(a, b, strict=True)):
            i, j = np.flatnonzero(s >= need - t.max()), np.flatnonzero(t >= need - s.max())
            x, y = np.nonzero(s[i][:, None] + t[j][None, :] >= need)
            best = int(s.argmax()) * words + int(t.argmax())
            out[k].append(np.unique(np.append(i[x] * words + j[y], best)) + table * words * words)
    return [np.concatenate(x) for x in out]


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Valid vectors as bytes with a digest of label and components; others without either."""
    for piece in pieces(batches):
        labels = column(piece, "label").to_pylist()
        lists = column(piece, "embedding")
        ends, values, ok = lists.offsets.to_numpy(), lists.values, lists.is_valid().to_numpy(zero_copy_only=False)
        flat = values.to_numpy(zero_copy_only=False).astype(np.float64)  # a null component becomes nan
        nodes, vecs, dims = [], [], []
        for i, label in enumerate(labels):
            v = flat[ends[i]:ends[i + 1]] + 0.0  # -0.0 equals 0.0
            if label is None or not ok[i] or not len(v) or not np.isfinite(v).all() or not v.any():
                nodes.append(None)
                vecs.append(None)
                dims.append(None)
                continue
            raw = v.tobytes()
            nodes.append(xxhash.xxh3_128_hexdigest(label.encode() + b"\0" + raw))
            single = v.astype(np.float32)
            vecs.append(single.tobytes() if (single == v).all() else raw)
            dims.append(len(v))
        yield pa.RecordBatch.from_arrays([column(piece, "vec_id"), column(piece, "label"), pa.array(nodes, pa.string()),
                                          pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())],
                                         ["vec_id", "label", "node", "dim", "vec"])


def _unit(vecs: list[bytes], dim: int) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = np.stack([np.frombuffer(v, np.float32 if len(v) == 4 * dim else np.float64).astype(np.float64) for v in vecs])
    x /= np.abs(x).max(axis=1, keepdims=True)  # very long and very short vectors keep a finite length
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _lister(n: int, threshold: float, miss: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            dims = column(piece, "dim").to_numpy()
            for dim in np.unique(dims):
                part = piece.filter(pa.array(dims == dim))
                lists = passed_filters(_unit(part["vec"].to_pylist(), int(dim)), plan(n, threshold, int(dim), miss=miss))
                yield pa.RecordBatch.from_arrays([column(part, "node"), pa.array(lists, pa.list_(pa.int64()))],
                                                 ["node", "filters"])
    return run


def _comparer(threshold: float):
    schema = pa.schema([("a", pa.string()), ("b", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["label", "dim", "filter", "lo", "hi"]):
            left, right, same = sides(group)
            unit = _unit(group["vec"].to_pylist(), group["dim"][0].as_py())
            near = unit[left] @ unit[right].T >= threshold
            if same:
                near &= ~np.eye(len(left), dtype=bool)
            if not near.any():
                continue
            here = group["filter"][0].as_py()
            lower = [np.asarray([f for f in fs if f < here], np.int64) for fs in group["filters"].to_pylist()]
            near &= shared_counts(lower)[np.ix_(left, right)] == 0
            size = group["copies"].to_numpy()
            links = np.zeros(len(unit), np.int64)
            links[left] += near @ size[right]
            if not same:
                links[right] += near.T @ size[left]
            names = group["node"].to_pylist()
            i, j = np.nonzero(near)
            rows = [{"a": names[k], "b": None, "n": int(links[k])} for k in np.flatnonzero(links)]
            rows += [{"a": names[x], "b": names[y], "n": 0} for x, y in forest(len(names), left[i], right[j])]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def embedding_dedup(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", miss: float = MISS) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Vectors of equal, non-null labels and equal dimension whose cosine in
    double precision reaches the threshold are linked, as far as they share a
    filter (a pair at the threshold misses with probability ``miss``, closer
    pairs far less often; equal vectors never).  ``n_links`` counts the other
    vectors linked directly, ``component_id`` is the smallest id that links
    reach, ``kept`` whether it is the row's own.  Vectors that are null,
    empty, zero, or hold null or non-finite components link with nothing, as
    do rows without a label or an id (the latter have no component and are
    kept).  Rows that repeat an id are vectors of their own with that id.  An
    empty table gives an empty result."""
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("embedding"))
    seen = cut_lineage(map_arrow(rows, _vectors, "vec_id bigint, label string, node string, dim int, vec binary"))
    live = seen.where(F.col("node").isNotNull() & F.col("vec_id").isNotNull())
    nodes = cut_lineage(live.groupBy("node").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
                                                 F.first("label").alias("label"), F.first("dim").alias("dim"),
                                                 F.first("vec").alias("vec")))
    listed = cut_lineage(map_arrow(nodes.select("node", "dim", "vec"), _lister(nodes.count(), threshold, miss),
                                   "node string, filters array<bigint>"))
    bucket = ["label", "dim", "filter"]
    known = nodes.select("node", "label", "dim")
    members = cut_lineage(listed.join(known, "node").select("label", "dim", "node", F.explode("filters").alias("filter")))
    # aggregates are written down before they are joined: Spark then splits the other side's hot keys
    blocks = cut_lineage(members.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        *bucket, F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("blocks")))
    task = [*bucket, "lo", "hi"]
    placed = (members.join(blocks, bucket).join(nodes.select("node", "copies", "vec"), "node").join(listed, "node")
              .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select(*bucket, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block",
                      "node", "copies", "vec", "filters"))
    found = cut_lineage(map_arrow(placed.repartition(parts, *task).sortWithinPartitions(*task), _comparer(threshold),
                                  "a string, b string, n bigint"))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    reach = connected_components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("id", "node")
    label = cut_lineage(nodes.select("node", "first_id", "copies").join(counts, "node", "left").join(reach, "node", "left").select(
        "node", "first_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component")))
    smallest = cut_lineage(label.groupBy("component").agg(F.min("first_id").alias("component_id")))
    by_node = label.join(smallest, "component").select("node", "n_links", "component_id")
    linked = live.select("vec_id", "node").join(by_node, "node").select("vec_id", "n_links", "component_id")
    alone = seen.where(F.col("node").isNull() | F.col("vec_id").isNull()).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
