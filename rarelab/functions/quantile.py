"""Exact order statistics without funnelling a column into one task.

Spark's exact ``percentile`` aggregate keeps a value->count map per group; for a
global percentile that map holds every distinct value in one task.  Here the
approximate sketch (``percentile_approx``: mergeable, bounded memory) brackets
each wanted rank and one counting pass verifies the brackets.  A rank inside the
ties at a bracket's end is that end's value; otherwise the bracket is narrowed
in the same way, with the sketch now spent on its rows alone, until few enough
rows are left to be fetched.  The steps are the same at every size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FETCH_ROWS = 20_000  # rows of a bracket that are ordered on the driver
ACCURACY = 20_000  # of the sketch: a bracket holds about 8 / ACCURACY of the rows


def order_statistics(df: DataFrame, value: Column, ranks: list[int], n: int,
                     accuracy: int | None = None) -> dict[int, float]:
    """``{rank: value}`` for 0-based ``ranks`` of the ``n`` non-null values."""
    accuracy = accuracy or ACCURACY
    x = df.select(value.cast("double").alias("x")).where("x IS NOT NULL")
    out: dict[int, float] = {}
    # open brackets: rank -> (rank within, rows, values strictly between)
    open_ = {r: (r, n, None, None) for r in ranks}
    while open_:
        inside = {}
        for r, (_, _, lo, hi) in open_.items():
            inside[r] = F.lit(True) if lo is None else (F.col("x") > F.lit(lo)) & (F.col("x") < F.lit(hi))
        few = {r: b for r, b in open_.items() if b[1] <= FETCH_ROWS}
        if few:
            any_ = F.lit(False)
            for r in few:
                any_ = any_ | inside[r]
            rows = sorted(v[0] for v in x.where(any_).collect())
            for r, (k, _, lo, hi) in few.items():
                own = rows if lo is None else [v for v in rows if lo < v < hi]
                out[r] = own[k]
        many = {r: b for r, b in open_.items() if r not in few}
        open_ = {}
        if not many:
            break
        eps = 4.0 / accuracy
        ends = x.agg(*[F.percentile_approx(
            F.when(inside[r], F.col("x")), F.array(F.lit(max(0.0, k / m - eps)), F.lit(min(1.0, k / m + eps))),
            accuracy).alias(f"p{r}") for r, (k, m, _, _) in many.items()]).first()
        lows = {r: ends[f"p{r}"][0] for r in many}
        highs = {r: ends[f"p{r}"][1] for r in many}
        counts = x.agg(*[e for r in many for e in (
            F.count(F.when(inside[r] & (F.col("x") < lows[r]), 1)).alias(f"b{r}"),
            F.count(F.when(inside[r] & (F.col("x") == lows[r]), 1)).alias(f"l{r}"),
            F.count(F.when(inside[r] & (F.col("x") == highs[r]), 1)).alias(f"h{r}"),
            F.count(F.when(inside[r] & (F.col("x") > highs[r]), 1)).alias(f"a{r}"))]).first()
        for r, (k, m, lo, hi) in many.items():
            below, at_lo, at_hi, above = (counts[f"{c}{r}"] for c in "blha")
            lo_r, hi_r = lows[r], highs[r]
            if lo_r == hi_r:
                at_hi = 0
            if k < below:  # the sketch missed: the rank lies before its bracket
                open_[r] = (k, below, -math.inf if lo is None else lo, lo_r)
            elif k < below + at_lo:
                out[r] = lo_r
            elif k >= m - above:
                open_[r] = (k - (m - above), above, hi_r, math.inf if hi is None else hi)
            elif k >= m - above - at_hi:
                out[r] = hi_r
            else:
                open_[r] = (k - below - at_lo, m - above - at_hi - below - at_lo, lo_r, hi_r)
    return out


def exact_percentiles(df: DataFrame, column: str, ps: list[float], accuracy: int | None = None) -> dict[float, float | None]:
    """Linear-interpolated percentiles between ranks ``floor(p(n-1))`` and
    ``ceil(p(n-1))``, as pandas ``quantile`` and SQL ``quantile_cont``, all from the same passes."""
    if not all(0.0 <= p <= 1.0 for p in ps):
        raise ValueError("p must lie in [0, 1]")
    value = F.col(column).cast("double")
    n = df.where(value.isNotNull()).count()
    if n == 0:
        return {p: None for p in ps}
    ends = {p: (math.floor(p * (n - 1)), math.ceil(p * (n - 1))) for p in ps}
    got = order_statistics(df, value, sorted({k for pair in ends.values() for k in pair}), n, accuracy)
    return {p: got[lo] + (p * (n - 1) - lo) * (got[hi] - got[lo]) for p, (lo, hi) in ends.items()}


def exact_percentile(df: DataFrame, column: str, p: float, accuracy: int | None = None) -> float | None:
    """One of :func:`exact_percentiles`."""
    return exact_percentiles(df, column, [p], accuracy)[p]
