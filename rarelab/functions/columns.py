"""Null-aware column expressions (inventory B6, B8, B9)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_safe_sum(*cols) -> Column:
    """Row-wise sum that skips nulls (all-null rows give 0), like a pandas
    ``sum(axis=1)``; plain ``+`` would give NULL."""
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(0)) for c in cols])


def flag_cast(c) -> Column:
    """0/1 to boolean; NULL stays NULL (pandas would turn NaN into True)."""
    return _c(c).cast("boolean")


def flag_map(c, mapping: dict) -> Column:
    """Map values through a small dictionary; unmapped values become NULL."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(_c(c) == F.lit(k), F.lit(v)) if expr is None else expr.when(_c(c) == F.lit(k), F.lit(v))
    return expr


def safe_corr(a, b) -> Column:
    """Pearson r over rows where both are non-null; NULL for zero variance.

    ``try_divide`` keeps ANSI mode from raising on a constant column."""
    a, b = _c(a).cast("double"), _c(b).cast("double")
    both = a.isNotNull() & b.isNotNull()
    a2, b2 = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(a2, b2), F.stddev_pop(a2) * F.stddev_pop(b2))


def sql_safe_corr(a: str, b: str) -> str:
    a2 = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
    b2 = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
    return (f"(covar_pop({a2}, {b2}) / nullif(stddev_pop({a2}) * stddev_pop({b2}), 0))")
