"""Registered queries: one Spark builder per inventory operator, plus the
equivalent DuckDB SQL used as the correctness oracle.

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables.  Doubles that leave a query are rounded to ``DIGITS``
places on both sides so the two engines hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double (and array<double>) column for cross-engine hashing."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(
                f.dataType.elementType, (T.DoubleType, T.FloatType)):
            c = F.transform(c, lambda x: F.round(x.cast("double"), digits))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


# Importing the query modules fills the registries.
from rarelab.plans import queries_eval, queries_model, queries_profile, queries_study  # noqa: E402,F401
