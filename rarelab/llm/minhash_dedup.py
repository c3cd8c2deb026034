"""MinHash near-dedup with sequential Bayesian verification.

Documents with equal shingle sets are one node.  Bands of a node's MinHash
signature put it into buckets; the smallest node of a bucket leads it, and the
nodes that meet a leader in any band form one group, which holds every candidate
pair once, whatever the number of bands they share.  Groups are cut into blocks,
so a group of any size becomes many small tasks and no pair is ever a row.

Inside a pair of blocks the signatures are compared in batches of hashes: after
each batch, pairs whose similarity reaches the threshold with a posterior
probability below the chosen miss probability are dropped.  Nodes with a
surviving partner get their full shingle sets, and intersections are counted
exactly; a spanning forest of the links found goes to the component search."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelab.llm.blocks import forest, grouped, shared_counts, sides
from rarelab.llm.common import column, hash64, map_arrow, mix64, pieces, word_codes
from rarelab.llm.components import connected_components
from rarelab.session import cut_lineage

HASHES, BANDS, ROWS = 140, 28, 5  # a pair at similarity 0.8 shares no band with probability 1.5e-5
BATCH = 20  # hashes compared before the next decision
MISS = 1e-5  # posterior probability of reaching the threshold below which a pair is dropped
BLOCK = 1024  # nodes of a group that one task compares with as many others
SLICE = 64  # rows of a block compared at a time

_PAIR = np.uint64(0x9E3779B97F4A7C15)
_LOOSE = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: pa.Array, width: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles of whole texts as 64-bit hashes: ``(hashes, offsets)``, sorted within a text.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` with A-Z lower-cased; a text of
    fewer than ``width`` words is one shingle, one without words has none."""
    offsets, codes, words = word_codes(pc.ascii_lower(pc.fill_null(texts, "")))
    h = mix64(hash64(words))[codes]
    n = np.diff(offsets)
    doc = np.repeat(np.arange(len(n)), n)
    full = n[doc] >= width
    size = np.minimum(n, width)
    # position i starts a shingle where all its words lie in the same text
    left = offsets[1:][doc] - np.arange(len(doc))
    start = np.flatnonzero((full & (left >= width)) | (~full & (left == size[doc])))
    value = np.full(len(start), _LOOSE)
    for t in range(width):
        inside = t < size[doc[start]]
        at = np.minimum(start + t, len(h) - 1)
        value = np.where(inside, mix64(value * _PAIR + h[at]), value)
    owner = doc[start]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[fresh], owner[fresh]
    return value, np.searchsorted(owner, np.arange(len(n) + 1))


def _factors(seed: int, n: int) -> np.ndarray:
    """Odd 64-bit multipliers."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) | np.uint64(1)


def signatures(value: np.ndarray, offsets: np.ndarray, hashes: int = HASHES, seed: int = 5) -> np.ndarray:
    """One row of ``hashes`` 32-bit minima per text; a text without shingles has the largest numbers."""
    out = np.full((len(offsets) - 1, hashes), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        starts = offsets[some]
        for j, factor in enumerate(_factors(seed, hashes)):
            out[some, j] = np.minimum.reduceat(value * factor, starts) >> np.uint64(32)
    return out


def set_digests(value: np.ndarray, offsets: np.ndarray) -> list[str | None]:
    """128 bits that depend on a text's shingle set alone; None for the empty set."""
    n = np.diff(offsets)
    some = np.flatnonzero(n)
    out: list[str | None] = [None] * len(n)
    if len(some):
        a = mix64(np.add.reduceat(mix64(value), offsets[some]) + n[some].astype(np.uint64))
        b = mix64(np.add.reduceat(mix64(value ^ _LOOSE), offsets[some]) + n[some].astype(np.uint64))
        for i, x, y in zip(some.tolist(), a.tolist(), b.tolist(), strict=True):
            out[i] = f"{x:016x}{y:016x}"
    return out


@lru_cache(8)
def least_matches(threshold: float, hashes: int = HASHES, batch: int = BATCH, miss: float = MISS) -> tuple[int, ...]:
    """After 1, 2, ... batches: the fewest matching hashes with which the similarity, uniform a priori, still
    reaches the threshold with probability ``miss`` or more."""
    x = (np.arange(200_000) + 0.5) / 200_000
    high = x >= threshold
    out = []
    for n in range(batch, hashes + 1, batch):
        for m in range(n + 1):
            log = m * np.log(x) + (n - m) * np.log1p(-x)
            density = np.exp(log - log.max())
            if density[high].sum() / density.sum() >= miss:
                out.append(m)
                break
    return tuple(out)


def _nodes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            value, offsets = shingle_sets(column(piece, "text"), width)
            sig = signatures(value, offsets)
            others = [c for c in piece.column_names if c not in ("doc_id", "text")]
            yield pa.RecordBatch.from_arrays([
                column(piece, "doc_id"), pa.array(np.diff(offsets).astype(np.int64)),
                pa.array(set_digests(value, offsets), pa.string()),
                pa.array([row.tobytes() for row in sig], pa.binary()),
                *[column(piece, c) for c in others]], ["doc_id", "n_shingles", "node", "sig", *others])
    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        mark = column(piece, "mark")
        sig = np.frombuffer(b"".join(column(piece, "sig").to_pylist()), np.uint32).reshape(len(mark), HASHES)
        for band in range(BANDS):
            key = np.full(len(mark), np.uint64(band))
            for j in range(band * ROWS, band * ROWS + ROWS):
                key = mix64(key * _PAIR + sig[:, j])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), mark], ["bucket", "mark"])


def _pruner(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = least_matches(threshold)
        for group in grouped(batches, ["leader", "lo", "hi"]):
            left, right, same = sides(group)
            sig = np.frombuffer(b"".join(group["sig"].to_pylist()), np.uint32).reshape(-1, HASHES)
            size = group["n_shingles"].to_numpy()
            alive = np.zeros(group.num_rows, bool)
            for at in range(0, len(left), SLICE):
                rows = left[at:at + SLICE]
                small = np.minimum(size[rows][:, None], size[right][None, :])
                large = np.maximum(size[rows][:, None], size[right][None, :])
                open_ = small >= threshold * large - 1e-9  # sets of such sizes can be similar enough
                if same:
                    open_ &= np.arange(at, at + len(rows))[:, None] < np.arange(len(right))[None, :]
                i, j = np.nonzero(open_)
                i, j = rows[i], right[j]
                matches = np.zeros(len(i), np.int64)
                for k, need in enumerate(least):
                    part = slice(k * BATCH, k * BATCH + BATCH)
                    matches += (sig[i, part] == sig[j, part]).sum(axis=1)
                    stay = matches >= need
                    i, j, matches = i[stay], j[stay], matches[stay]
                    if not len(i):
                        break
                alive[i] = True
                alive[j] = True
            if alive.any():
                yield from group.select(["leader", "lo", "hi", "block", "node"]).filter(pa.array(alive)).to_batches()
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            value, offsets = shingle_sets(column(piece, "text"), width)
            yield pa.RecordBatch.from_arrays([
                pa.array(set_digests(value, offsets), pa.string()),
                pa.array([value[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())],
                ["node", "shingles"])
    return run


def _verifier(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["leader", "lo", "hi"]):
            left, right, same = sides(group)
            sets = [np.frombuffer(b, np.uint64) for b in group["shingles"].to_pylist()]
            size = np.asarray([len(s) for s in sets])
            both = shared_counts(sets)[np.ix_(left, right)].astype(np.int64)
            total = size[left][:, None] + size[right][None, :] - both
            i, j = np.nonzero(100 * both >= percent * total)
            i, j = left[i], right[j]
            if same:
                i, j = i[i < j], j[i < j]
            names = group["node"].to_pylist()
            links = forest(len(sets), i, j)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([names[a] for a, _ in links], pa.string()),
                                                  pa.array([names[b] for _, b in links], pa.string())], ["a", "b"])
    return run


def _components(texts: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of rows ``doc_id`` (any type that sorts), ``text`` and others: ``(all_rows, label)``, the rows with their node, and
    every node's smallest ``doc_id`` and component.  Rows without a ``doc_id`` have no part in the nodes."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = "".join(f", {f.name} {f.dataType.simpleString()}" for f in texts.schema if f.name not in ("doc_id", "text"))
    of_id = texts.schema["doc_id"].dataType.simpleString()
    all_rows = cut_lineage(map_arrow(texts, _nodes(width),
                                     f"doc_id {of_id}, n_shingles bigint, node string, sig binary" + others))
    live = all_rows.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    nodes = cut_lineage(live.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"),
                                                 F.first("sig").alias("sig")))

    # in buckets a node goes by 64 bits of its digest: nodes that share them only meet once more
    marked = nodes.withColumn("mark", F.xxhash64("node"))
    banded = map_arrow(marked.select("mark", "sig"), _bands, "bucket bigint, mark bigint")
    # aggregates are written down before they are joined: Spark then splits the other side's hot keys
    leaders = cut_lineage(banded.groupBy("bucket").agg(F.min("mark").alias("leader"), F.count(F.lit(1)).alias("n"))
                          .where("n > 1").drop("n"))
    members = cut_lineage(banded.join(leaders, "bucket").select("leader", "mark").distinct())
    blocks = cut_lineage(members.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks")))
    placed = (members.join(blocks, "leader").join(marked.select("mark", "node", "n_shingles", "sig"), "mark")
              .withColumn("block", F.pmod("mark", F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("leader", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block",
                      "node", "n_shingles", "sig"))
    task = ["leader", "lo", "hi"]
    alive = cut_lineage(map_arrow(placed.repartition(parts, *task).sortWithinPartitions(*task), _pruner(percent / 100),
                                  "leader bigint, lo int, hi int, block int, node string"))

    wanted = alive.select("node").distinct().join(nodes.select("node", "first_id"), "node")
    some = texts.join(wanted.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = map_arrow(some, _sets(width), "node string, shingles binary").where("node IS NOT NULL")
    sets = cut_lineage(sets.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]))
    full = alive.join(sets, "node").repartition(parts, *task).sortWithinPartitions(*task)
    links = cut_lineage(map_arrow(full, _verifier(percent), "a string, b string"))

    reach = connected_components(links)
    label = cut_lineage(nodes.select("node", "first_id").join(reach.withColumnRenamed("id", "node"), "node", "left").select(
        "node", "first_id", F.coalesce("component", "node").alias("component")))
    return all_rows, label


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    A document's set holds the distinct ``width``-word shingles of its whole
    text (A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``; fewer words are one
    shingle).  Documents are linked where 100 * shared >= ``percent`` * union,
    counted on the full sets as 64-bit hashes; equal sets are found by a
    128-bit digest.  ``component_id`` is the smallest id that links reach,
    ``kept`` whether it is the row's own.  Null and empty texts have no
    shingles and link with nothing.  Rows without an id link with nothing,
    have no component and are kept.  Rows that repeat an id are nodes of
    their own with that id.  An empty table gives an empty result."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    all_rows, label = _components(texts, width, percent)
    live = all_rows.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    smallest = cut_lineage(label.groupBy("component").agg(F.min("first_id").alias("component_id")))
    found = label.join(smallest, "component").select("node", "component_id")
    alone = all_rows.where(F.col("node").isNull() | F.col("doc_id").isNull()).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    linked = live.select("doc_id", "n_shingles", "node").join(found, "node").select("doc_id", "n_shingles", "component_id")
    return linked.unionAll(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row of each component with all its columns, and the rows without shingles.

    Rows are linked by their texts alone, whether or not they have an id or
    repeat one.  The row that stays has the smallest id (rows without one come
    last); of rows that repeat it, the smallest hash of id and text; of rows
    equal in both, any."""
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    named = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("none")), F.coalesce("text", F.lit("")))
    rows = rows.withColumn("key", F.unhex(F.sha2(named, 256)))
    all_rows, label = _components(rows.select(F.col("key").alias("doc_id"), "text", "id"), width, percent)
    live = all_rows.where("node IS NOT NULL").select(F.col("doc_id").alias("key"), "id", "node")
    firsts = cut_lineage(live.groupBy("node").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("first")))
    firsts = cut_lineage(label.select("node", "component").join(firsts, "node"))
    stays = cut_lineage(firsts.groupBy("component").agg(F.min("first").alias("stays")))
    found = firsts.join(stays, "component").select("node", F.col("stays.key").alias("stays"))
    gone = live.join(found, "node").where("key != stays").select(F.col("key").alias("gone"))
    left = rows.join(gone, F.col("key") == F.col("gone"), "left_anti")
    twice = cut_lineage(live.groupBy(F.col("key").alias("twice")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    if not twice.isEmpty():
        left = left.join(twice, F.col("key") == F.col("twice"), "left_anti").unionAll(
            left.join(twice, F.col("key") == F.col("twice"), "left_semi").dropDuplicates(["key"]))
    return left.select("row.*")
