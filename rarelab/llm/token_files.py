"""Token ids in flat binary files, memory-mapped on the way back.

Each shard is a pair of files in one folder:

* ``<name>.bin``: the ids of its documents one after another, little-endian
  unsigned 16-bit integers where every id fits, else unsigned 32-bit ones;
* ``<name>.idx``: little-endian 64-bit integers: the number of documents n, the
  bytes per id, n + 1 offsets counted in ids from the start of the *whole*
  corpus, then the n document ids (-2^63 for a document without one).

Shards hold consecutive ranges of the document order, which Spark's range
partitioning finds; a shard's first offset is the prefix sum of the shards
before it.  A task writes under a name of its own and reports it with its rows,
so what a lost or repeated attempt has left behind is never read."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rarelab.llm.common import column, map_arrow, pieces, shared_path
from rarelab.llm.encoding import ENCODE_BYTES, encoder
from rarelab.session import cut_lineage

NO_ID = -(1 << 63)
READ_IDS = 1 << 20  # ids read at once


def _open(path: str):
    """Random access to a file of the shared folder; local files are memory-mapped."""
    store, at = fs.FileSystem.from_uri(path)
    return pa.memory_map(at) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(at)


def _writer(folder: str, tokenizer: str, end_id: int):
    schema = pa.schema([("part", pa.int32()), ("name", pa.string()), ("row", pa.int64()), ("doc_id", pa.int64()),
                        ("n_tokens", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, name = task.partitionId(), f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        words = encoder(tokenizer)
        kind = _kind(words.vocab_size, end_id)
        store, at = fs.FileSystem.from_uri(folder)
        row, out = 0, None
        for piece in pieces(batches, ENCODE_BYTES):
            out = out or store.open_output_stream(f"{at}/{name}.bin")
            ids, offsets = words.encode(column(piece, "text"))
            n = len(offsets) - 1
            ended = np.insert(ids, offsets[1:], end_id).astype(kind)
            out.write(ended.tobytes())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, part, np.int32)), pa.array([name] * n, pa.string()),
                pa.array(np.arange(row, row + n)), column(piece, "doc_id"), pa.array(np.diff(offsets) + 1)], schema=schema)
            row += n
        if out:
            out.close()
    return write


def _kind(vocab_size: int, end_id: int) -> str:
    return "<u2" if max(vocab_size - 1, end_id) < 1 << 16 else "<u4"


def _indexer(folder: str, width: int):
    schema = pa.schema([("part", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64())])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = fs.FileSystem.from_uri(folder)
        attempt = TaskContext.get().taskAttemptId()
        part = None

        def close(part, name, base, counts, ids):
            counts, ids = np.concatenate(counts), np.concatenate(ids)
            offsets = base + np.concatenate(([0], np.cumsum(counts)))
            words = np.concatenate(([len(ids), width], offsets, ids)).astype("<i8")
            index_name = f"{name}-{attempt}"
            with store.open_output_stream(f"{at}/{index_name}.idx") as out:
                out.write(words.tobytes())
            return pa.RecordBatch.from_pylist([{"part": part, "name": f"{name}.bin|{index_name}.idx",
                                                "n_docs": len(ids)}], schema=schema)

        for piece in pieces(batches):
            parts = column(piece, "part").to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(parts)) + 1, [len(parts)]))
            counts = column(piece, "n_tokens").to_numpy()
            ids = column(piece, "doc_id").fill_null(NO_ID).to_numpy()
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if part != parts[lo]:
                    if part is not None:
                        yield close(part, name, base, held, held_ids)
                    part, name, base = int(parts[lo]), piece["name"][int(lo)].as_py(), piece["base"][int(lo)].as_py()
                    held, held_ids = [], []
                held.append(counts[lo:hi])
                held_ids.append(ids[lo:hi])
        if part is not None:
            yield close(part, name, base, held, held_ids)
    return index


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> tuple[DataFrame, str]:
    """Encode whole texts (null: empty), end each with ``end_id`` and write them
    in ascending order of the id (rows without one first; rows that repeat an
    id by their text).  Returns the shards (``part, name, n_docs``) and the folder.
    An empty table writes no files."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "token-files")
    store, at = fs.FileSystem.from_uri(folder)
    store.create_dir(at, recursive=True)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    written = cut_lineage(map_arrow(placed, _writer(folder, tokenizer, end_id),
                                    "part int, name string, row bigint, doc_id bigint, n_tokens bigint"))
    totals = written.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row per shard
    bases = totals.select(F.col("part").alias("p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    based = written.join(bases, F.col("part") == F.col("p")).drop("p")
    width = int(_kind(encoder(tokenizer).vocab_size, end_id)[2:])
    shards = cut_lineage(map_arrow(based.repartition(parts, "part").sortWithinPartitions("part", "row"),
                                   _indexer(folder, width), "part int, name string, n_docs bigint"))
    return shards, folder


def _reader(folder: str):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("name").to_pylist():
                data, index = name.split("|")
                with _open(f"{folder}/{index}") as f:
                    words = np.frombuffer(f.read_buffer(), dtype="<i8")
                n, width = int(words[0]), int(words[1])
                offsets, ids = words[2:n + 3], words[n + 3:]
                base, kind = offsets[0], f"<u{width}"
                with _open(f"{folder}/{data}") as f:
                    lo = 0
                    while lo < n:
                        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + READ_IDS, "right")) - 1)
                        f.seek(int(offsets[lo] - base) * width)
                        block = np.frombuffer(f.read_buffer(int(offsets[hi] - offsets[lo]) * width), dtype=kind)
                        full, at = block.astype("<u4").tobytes(), (offsets[lo:hi + 1] - offsets[lo]) * 4
                        crc = [zlib.crc32(full[at[i]:at[i + 1]]) for i in range(hi - lo)]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(ids[lo:hi], mask=ids[lo:hi] == NO_ID), pa.array(offsets[lo:hi]),
                            pa.array(np.diff(offsets[lo:hi + 1])), pa.array(crc, pa.int64())], schema=schema)
                        lo = hi
    return read


def read_tokens(shards: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files: ``doc_id, start, n_tokens, ids_crc32``
    (crc32 of the ids as little-endian unsigned 32-bit integers)."""
    parts = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(shards.repartition(parts, "part"), _reader(folder),
                     "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
