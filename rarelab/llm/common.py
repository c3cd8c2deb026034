"""Pieces the training-data operators share: bounded Arrow batches, word codes,
hashes, the train/held-out fold and paths in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rarelab.session import ensure_checkpoint_dir, expose_package

BATCH_ROWS = 1000  # rows per Arrow batch sent to Python
PIECE_BYTES = 4 << 20  # bytes of input that a kernel works on at once

#: Python and SQL spelling of the white space that separates words.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch to :data:`BATCH_ROWS`, so that
    a batch of long texts stays small in a Python worker.  A smaller setting
    of the caller's stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def pieces(batches: Iterable[pa.RecordBatch], target: int = PIECE_BYTES) -> Iterator[pa.Table]:
    """Regroup Arrow batches into tables of about ``target`` bytes: small
    batches are joined, large ones are cut between rows.  Row order stays."""
    held, size = [], 0
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        step = n if batch.nbytes <= target else max(1, n * target // batch.nbytes)
        for at in range(0, n, step):
            part = batch.slice(at, step)
            held.append(part)
            size += part.nbytes
            if size >= target:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def column(table: pa.Table, name: str) -> pa.Array:
    """A column of a piece as one array."""
    c = table.column(name)
    return c.combine_chunks() if c.num_chunks != 1 else c.chunk(0)


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Split texts at runs of ``[\\x20\\x09-\\x0D]``.

    Returns ``(offsets, codes, words)``: text ``i`` is the word sequence
    ``words[codes[offsets[i]:offsets[i + 1]]]`` and ``words`` holds every
    distinct word of the piece once.  A null text has no words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    mask = full.to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    starts = lists.offsets.to_numpy().astype(np.int64)
    offsets = before[starts - starts[0]]
    coded = flat.filter(full).dictionary_encode()
    return offsets, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def hash64(words: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit xxHash of the UTF-8 bytes of each word."""
    h = xxhash.xxh64_intdigest
    as_bytes = words.cast(pa.binary()).to_pylist()
    return np.fromiter((h(w, seed) for w in as_bytes), dtype=np.uint64, count=len(as_bytes))


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection on 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def fold_of(id_col: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(folds)


def held_out(id_col: Column) -> Column:
    """True where the fold is 0.  Rows without an id are never learned from, so they count as held out."""
    return F.coalesce(fold_of(id_col) == F.lit(0), F.lit(True))


def unit_hash(*cols, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the columns and the seed alone (53 bits)."""
    h = F.xxhash64(F.lit(seed), *cols)
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name inside the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with bounded batches."""
    bounded_batches(df.sparkSession)
    expose_package(df.sparkSession)
    return df.mapInArrow(fn, schema)
