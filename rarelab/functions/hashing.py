"""Portable, partition-independent pseudo-randomness.

``uniform(seed, *parts)`` maps a seed and key columns to a double in [0, 1)
from the first 52 bits of an MD5 digest, all of which a double holds.  The same
number comes out of DuckDB with ``('0x' || substr(md5(s), 1, 13))::BIGINT /
4503599627370496.0`` over the same string ``s``, so every split and resampling draw built on it is reproducible,
independent of partitioning, and checkable by a SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 13
TWO_52 = 4503599627370496.0


def hash_string(seed, *parts) -> Column:
    """``'<seed>:<part1>:<part2>...'`` with every part cast to string."""
    cols = [F.lit(str(seed))]
    for p in parts:
        cols.append((F.col(p) if isinstance(p, str) else p).cast("string"))
    return F.concat_ws(":", *cols)


def uniform(seed, *parts) -> Column:
    digest = F.md5(hash_string(seed, *parts))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double") / F.lit(TWO_52)


def sql_uniform(seed, *parts: str) -> str:
    """DuckDB expression equal to :func:`uniform` (for oracles)."""
    inner = ", ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"(('0x' || substr(md5(concat_ws(':', {inner})), 1, {HEX_DIGITS}))::BIGINT / CAST(4503599627370496 AS DOUBLE))"


def sql_hash_string(seed, *parts: str) -> str:
    inner = ", ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"md5(concat_ws(':', {inner}))"
