"""Pairwise-complete co-moments of many columns as one mergeable state.

A state holds, for every ordered pair of columns, what the rows with both values
say: their number, the first column's mean (a value of the column, and the mean's distance
from it, so that a large mean costs no digits), sum of squared deviations,
smallest and largest value, the sum of products of deviations, and how many
values are not finite.  A batch's state is a few matrix products of the values
and of the masks; two states merge by the usual update of central moments.  A task sends one
state, whatever its rows, and states are merged in two steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelab.session import expose_package

FAN_IN = 64  # first merges
N, BASE, OFF, M2, CO, LOW, HIGH, ODD = range(8)
WIDTH = 8


def empty_state(p: int) -> np.ndarray:
    state = np.zeros((WIDTH, p, p))
    state[LOW], state[HIGH] = np.inf, -np.inf
    return state


def batch_state(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The state of rows ``x`` (rows x columns); ``known`` is False where a value is missing."""
    p = x.shape[1]
    state = empty_state(p)
    odd = known & ~np.isfinite(x)
    mask = known.astype(np.float64)
    good = known & ~odd
    state[ODD] = odd.astype(np.float64).T @ mask
    if not good.any():
        state[N] = mask.T @ mask
        return state
    first = x[good.argmax(axis=0), np.arange(p)]
    shift = np.where(good.any(axis=0), first, 0.0)
    z = np.where(good, x - shift, 0.0)
    n = mask.T @ mask
    safe = np.maximum(n, 1)
    total = z.T @ mask
    state[N] = n
    state[BASE], state[OFF] = np.where(n > 0, shift[:, None], 0.0), total / safe
    state[M2] = np.maximum((z * z).T @ mask - total * total / safe, 0.0)
    state[CO] = z.T @ z - total * total.T / safe
    low, high = np.where(good, x, np.inf), np.where(good, x, -np.inf)
    state[LOW], state[HIGH] = low.min(axis=0)[:, None], high.max(axis=0)[:, None]
    for j in np.flatnonzero(~known.all(axis=0)):  # only beside a column with gaps are they of fewer rows
        there = known[:, j]
        state[LOW][:, j] = low[there].min(axis=0, initial=np.inf)
        state[HIGH][:, j] = high[there].max(axis=0, initial=-np.inf)
    return state


def merge_states(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty_like(a)
    n = a[N] + b[N]
    share = np.divide(b[N], n, out=np.zeros_like(n), where=n > 0)
    delta = np.where((a[N] > 0) & (b[N] > 0), (b[BASE] - a[BASE]) + (b[OFF] - a[OFF]), 0.0)
    out[N] = n
    out[BASE] = np.where(a[N] > 0, a[BASE], b[BASE])
    out[OFF] = np.where(a[N] > 0, a[OFF] + delta * share, b[OFF])
    out[M2] = a[M2] + b[M2] + delta * delta * a[N] * share
    out[CO] = a[CO] + b[CO] + delta * delta.T * a[N] * share
    out[LOW], out[HIGH] = np.minimum(a[LOW], b[LOW]), np.maximum(a[HIGH], b[HIGH])
    out[ODD] = a[ODD] + b[ODD]
    return out


def correlations(state: np.ndarray) -> np.ndarray:
    """Pearson r of every pair; NaN where a value is not finite, and -inf (no value) where a column is constant
    or no row has both."""
    constant = state[LOW] >= state[HIGH]
    none = constant | constant.T | (state[N] == 0)
    spread = np.sqrt(state[M2]) * np.sqrt(state[M2].T)
    r = np.divide(state[CO], spread, out=np.full_like(spread, -np.inf), where=~none & (spread > 0))
    return np.where(state[ODD] + state[ODD].T > 0, np.nan, r)


def _scan(p: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            flat = batch.column(0).flatten()
            x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, p)
            known = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, p)
            one = batch_state(np.where(known, x, 0.0), known)
            state = one if state is None else merge_states(state, one)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % FAN_IN], pa.int32()),
                                              pa.array([state.ravel()], pa.list_(pa.float64()))], ["salt", "state"])
    return run


def _merged(table: pa.Table, p: int) -> np.ndarray:
    state = empty_state(p)
    for one in table.column("state"):
        state = merge_states(state, one.values.to_numpy(zero_copy_only=False).reshape(WIDTH, p, p))
    return state


def pair_correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(i, j, r)`` for every ordered pair of columns (by number): pairwise-complete Pearson r, null for a
    constant column or without complete rows.  One row per task leaves the scan."""
    p = len(cols)
    spark = df.sparkSession
    expose_package(spark)
    values = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    states = values.mapInArrow(_scan(p), "salt int, state array<double>")
    # a state of no rows, so that an empty table has its pairs as well
    states = states.unionByName(spark.createDataFrame([(0, empty_state(p).ravel().tolist())], "salt int, state array<double>"))

    def merge(table: pa.Table) -> pa.Table:
        return pa.table({"salt": pa.array([0], pa.int32()), "state": pa.array([_merged(table, p).ravel()], pa.list_(pa.float64()))})

    def finish(table: pa.Table) -> pa.Table:
        r = correlations(_merged(table, p)).ravel()
        i, j = np.divmod(np.arange(p * p), p)
        return pa.table({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "r": pa.array(r, mask=np.isneginf(r), from_pandas=False)})

    merged = states.groupBy("salt").applyInArrow(merge, "salt int, state array<double>")
    return merged.groupBy("salt").applyInArrow(finish, "i int, j int, r double")
