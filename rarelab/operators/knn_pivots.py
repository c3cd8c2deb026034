"""Exact nearest neighbours in any dimension, pruned by pivots.

A sample of training vectors serves as pivots; every row belongs to the cell of
its nearest pivot and knows its distance to it.  For a cell of queries the
counts and radii of the training cells bound the distance of the k-th neighbour
from above; a training cell that the triangle inequality puts farther away than
that has no neighbour for it.  Cells that lie near each other are packed into
blocks of bounded size (a large cell fills several), and a query block meets
only training blocks with a cell that it needs.  Inside a task the cells are
visited in order of distance, and each query's own k-th distance so far drops
further cells and, by their distance to the pivot, single rows.  Of vectors of many
numbers a matrix product gives all distances but for rounding; only those that could be
among the nearest are summed.

The pivots decide how much is computed, never what is found: all bounds leave
room for rounding, and distances are summed dimension by dimension.

Beside its numbers a row may have level codes, each standing for the one-hot
row of a column of any number of levels (a negative code for the row of zeros):
two levels differ in two places, a level and none in one."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rarelab.operators.knn_line import _codes as coded
from rarelab.session import cut_lineage, expose_package

MOST_PIVOTS = 1024
ROOM = 1e-9  # of the distances in a bound
CELLS = 2_000_000  # distances held at once
BATCH_ROWS = 2048  # training rows of near cells that are compared together
WIDE = 8  # numbers from which on a matrix product says which distances are worth summing


class Points:
    """Scaled numbers and level codes of rows."""

    def __init__(self, numbers: np.ndarray, codes: np.ndarray, weights: np.ndarray, code_weights: np.ndarray):
        self.x, self.z = numbers * np.sqrt(weights), codes
        self.weights, self.code_weights = weights, code_weights

    def __len__(self) -> int:
        return len(self.x)

    def take(self, at) -> Points:
        out = object.__new__(Points)
        out.x, out.z, out.weights, out.code_weights = self.x[at], self.z[at], self.weights, self.code_weights
        return out

    def to(self, one: Points) -> np.ndarray:
        """Distances to a single point, or to as many points row by row."""
        apart = (self.z != one.z) * ((self.z >= 0).astype(np.float64) + (one.z >= 0))
        return np.sqrt(((self.x - one.x) ** 2).sum(axis=1) + apart @ self.code_weights)

    def nearest(self, pivots: Points) -> np.ndarray:
        """The nearest pivot of each, but for rounding."""
        far = (pivots.x ** 2).sum(axis=1) - 2 * (self.x @ pivots.x.T)
        return (far + code_gaps(self.z, pivots.z, self.code_weights)).argmin(axis=1)


def code_gaps(a: np.ndarray, b: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The level codes' part of the squared distances between all rows of ``a`` and ``b``."""
    out = np.zeros((len(a), len(b)))
    for j, w in enumerate(weights):
        left, right = a[:, j, None], b[None, :, j]
        out += w * ((left != right) * ((left >= 0).astype(np.float64) + (right >= 0)))
    return out


def sample_pivots(train: DataFrame, n: int, weights: np.ndarray, code_weights: np.ndarray) -> Points:
    """The square root of ``n`` training rows, :data:`MOST_PIVOTS` at most: of four times as
    many that a hash of the key chooses, each the farthest from those before it, so that every cluster of
    the sample has one.  They come in order along the direction of the numbers' largest spread."""
    m = min(MOST_PIVOTS, max(1, math.ceil(math.sqrt(n))))
    rows = train.select("__tx", "__tz", F.xxhash64("__tk").alias("h")).orderBy("h").limit(4 * m).collect()
    x = np.asarray([r["__tx"] for r in rows], dtype=np.float64).reshape(len(rows), -1)
    z = np.asarray([r["__tz"] for r in rows], dtype=np.int64).reshape(len(rows), -1)
    p = Points(x, z, weights, code_weights)
    p = p.take(np.unique(np.hstack((p.x, p.z)), axis=0, return_index=True)[1])
    if not np.isfinite(p.x).all():
        return p.take(slice(m))
    chosen, gap = [0], p.to(p.take([0]))
    while len(chosen) < min(m, len(p)):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, p.to(p.take(chosen[-1:])))
    p = p.take(chosen)
    if p.x.shape[1] == 0:
        return p
    centred = p.x - p.x.mean(axis=0)
    return p.take(np.argsort(centred @ np.linalg.svd(centred, full_matrices=False)[2][0], kind="stable"))


def _matrix(vectors: pa.Array, kind) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(vectors), -1)


def _placer(pivots: Points, numbers: str, codes: str):
    """Append the nearest pivot's number and the distance to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = Points(_matrix(batch.column(numbers), np.float64), _matrix(batch.column(codes), np.int64),
                          pivots.weights, pivots.code_weights)
            step = max(1, CELLS // len(pivots))
            cell = np.concatenate([rows.take(slice(a, a + step)).nearest(pivots) for a in range(0, len(rows), step)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(rows.to(pivots.take(cell)))],
                                             [*batch.schema.names, "__cell", "__r"])
    return run


def _placed(df: DataFrame, pivots: Points, numbers: str, codes: str) -> DataFrame:
    schema = T.StructType([*df.schema.fields, T.StructField("__cell", T.IntegerType()), T.StructField("__r", T.DoubleType())])
    return df.mapInArrow(_placer(pivots, numbers, codes), schema)


def _packed(rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(first, blocks)`` of every cell: neighbouring cells share a block of about ``size`` rows, a cell of
    more has blocks of its own."""
    first, blocks = np.zeros(len(rows), np.int64), np.ones(len(rows), np.int64)
    at, filled = 0, 0
    for i, n in enumerate(rows.tolist()):
        need = max(1, math.ceil(n / size))
        if filled and (need > 1 or filled + n > size):
            at, filled = at + 1, 0
        first[i], blocks[i] = at, need
        if need > 1:
            at += need
        else:
            filled += n
    return first, blocks


def _planner(pivots: Points, split: list[str], need: int, mode: str, query_size: int, train_size: int, names: list[str]):
    """Of one split: where cells go (``q``, ``t``), how far a cell's neighbours can be, and the cells it needs (``p``)."""
    def plan(queries: pd.DataFrame, train: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(train):
            return pd.DataFrame(columns=names)
        m, between = len(pivots), np.stack([pivots.to(pivots.take([i])) for i in range(len(pivots))])
        own = [queries[s].iloc[0] for s in split]
        whole = train[train["__all"]]
        rows, radius = np.zeros(m), np.full(m, -np.inf)
        rows[whole["__cell"]], radius[whole["__cell"]] = whole["__n"], whole["__far"]
        by_class = {}
        for c, one in train[~train["__all"]].groupby("__c", dropna=False, sort=False):
            n = np.zeros(m)
            n[one["__cell"]] = one["__n"]
            by_class[None if pd.isna(c) else c] = n
        asked = np.bincount(queries["__cell"], weights=queries["__n"], minlength=m)
        (q_first, q_blocks), (t_first, t_blocks) = _packed(asked, query_size), _packed(rows, train_size)
        out, wanted = [], np.zeros((m, m), bool)
        for c, i, r in zip(queries["__c"], queries["__cell"], queries["__far"], strict=True):
            known = by_class.get(None if pd.isna(c) else c, np.zeros(m))
            usable = rows if mode == "own" else rows - known if mode == "others" else known
            there = usable > 0
            reach = between[i] + r + radius
            order = np.argsort(reach, kind="stable")
            order = order[there[order]]
            enough = np.searchsorted(np.cumsum(usable[order]), need)
            limit = reach[order[enough]] if enough < len(order) else np.inf
            limit += ROOM * abs(limit) if np.isfinite(limit) else 0
            nearest = between[i] - r - radius
            wanted[i] |= there & ~(nearest - ROOM * (between[i] + r + np.abs(radius)) > limit)
            out.append((*own, "q", int(i), c, int(q_first[i]), int(q_blocks[i]), float(limit), 0))
        none = queries["__c"].iloc[0]
        out += [(*own, "t", int(j), none, int(t_first[j]), int(t_blocks[j]), 0.0, 0) for j in np.flatnonzero(rows)]
        out += [(*own, "p", int(i), none, 0, 0, 0.0, int(j)) for i, j in zip(*np.nonzero(wanted), strict=True)]
        return pd.DataFrame(out, columns=names)
    return plan


def _groups(values: np.ndarray) -> Iterator[tuple[object, np.ndarray]]:
    """Row numbers by value."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order], prepend=values[order[:1]] - 1)) if len(values) else []
    for lo, hi in zip(cuts, [*cuts[1:], len(values)], strict=True):
        yield values[order[lo]], order[lo:hi]


def _first(d: np.ndarray, k: int) -> np.ndarray:
    """Which candidates are among the first ``k`` of their line in (distance, column) order."""
    if d.shape[1] <= k:
        return np.isfinite(d)
    top = np.partition(d, k - 1, axis=1)[:, k - 1, None]
    keep, level = d < top, d == top
    missing = k - keep.sum(axis=1)
    tied = np.flatnonzero(level.sum(axis=1) > missing)
    if len(tied):
        level[tied] &= np.cumsum(level[tied], axis=1, dtype=np.int32) <= missing[tied, None]
    return (keep | level) & np.isfinite(d)


def _kernel(pivots: Points, k: int, split: list[str], exclude_self: bool, mode: str, counter, schema: pa.Schema):
    def distances(q: Points, t: Points) -> np.ndarray:
        """Squared, dimension by dimension, as SQL sums."""
        d = np.zeros((len(q), len(t)))
        for dim in range(t.x.shape[1]):
            diff = q.x[:, dim, None] - t.x[None, :, dim]
            d += (diff * diff) * pivots.weights[dim]
        return d + code_gaps(q.z, t.z, pivots.code_weights) if t.z.shape[1] else d

    def raw(table: pa.Table, numbers: str, codes: str) -> Points:
        out = object.__new__(Points)  # unscaled
        out.x, out.z = (_matrix(table.column(c).combine_chunks(), kind) for c, kind in ((numbers, np.float64), (codes, np.int64)))
        out.weights, out.code_weights = pivots.weights, pivots.code_weights
        return out

    def kernel(queries: pa.Table, train: pa.Table) -> pa.Table:
        if queries.num_rows == 0 or train.num_rows == 0:
            return schema.empty_table()
        train = train.sort_by("__tk")  # a row's number is its place among the keys
        t, q = raw(train, "__tx", "__tz"), raw(queries, "__qx", "__qz")
        rq, theta = (queries.column(c).to_numpy() for c in ("__r", "__theta"))
        t_r, own = train.column("__r").to_numpy(), None
        if mode == "others":
            (t_class, q_class), _ = coded([train.column("__tc"), queries.column("__qc")])
        elif mode == "listed":
            belongs = train.column("__tc").combine_chunks()
            entries = np.repeat(np.arange(len(t)), belongs.value_lengths().fill_null(0).to_numpy())
            (t_class, q_class), _ = coded([belongs.flatten(), queries.column("__qc")])
        else:
            q_class = np.zeros(len(q), np.int64)
        if exclude_self:
            # a key that is null is nobody's
            (t_key, q_key), _ = coded([train.column("__tk"), queries.column("__qk")])
            q_key = np.where(queries.column("__qk").combine_chunks().is_null().to_numpy(zero_copy_only=False), -1, q_key)
        wide = t.x.shape[1] >= WIDE and np.isfinite(t.x).all() and np.isfinite(q.x).all()
        if wide:
            middle, root = t.x.mean(axis=0), np.sqrt(pivots.weights)
            t_flat, q_flat = (t.x - middle) * root, (q.x - middle) * root
            t_norm, q_norm = (t_flat ** 2).sum(axis=1), (q_flat ** 2).sum(axis=1)
            wide = np.isfinite(t_norm).all() and np.isfinite(q_norm).all()

        def closest(mine, cols, there, within):
            """Line, column and squared distance of the first ``k`` of every line that are no farther than ``within``,
            and how many distances were summed."""
            within = within * within * (1 + 4 * ROOM)
            if wide:
                # rounding moves a product by far less than ROOM of the norms: what is within reach is summed as all else is
                rough = q_flat[mine] @ t_flat[cols].T
                rough *= -2
                rough += t_norm[cols]
                if t.z.shape[1]:
                    rough += code_gaps(q.z[mine], there.z, pivots.code_weights)
                if exclude_self:
                    rough[q_key[mine, None] == t_key[None, cols]] = np.inf
                slack = ROOM * (q_norm[mine] + t_norm[cols].max())
                most = np.finfo(np.float64).max
                reach = within - q_norm[mine] + slack
                hit = rough <= np.minimum(reach, most)[:, None]
                if len(cols) > k and np.count_nonzero(hit) > 4 * k * len(mine):
                    reach = np.minimum(reach, np.partition(rough, k - 1, axis=1)[:, k - 1] + 2 * slack)
                    hit = rough <= np.minimum(reach, most)[:, None]
                a, b = np.nonzero(hit)
                if len(a) <= CELLS // 4:
                    d = np.zeros(len(a))
                    for dim in range(t.x.shape[1]):
                        diff = q.x[mine[a], dim] - there.x[b, dim]
                        d += (diff * diff) * pivots.weights[dim]
                    if t.z.shape[1]:
                        gaps = np.zeros(len(a))
                        for j, w in enumerate(pivots.code_weights):
                            left, right = q.z[mine[a], j], there.z[b, j]
                            gaps += w * ((left != right) * ((left >= 0).astype(np.float64) + (right >= 0)))
                        d += gaps
                    order = np.lexsort((b, d, a))
                    a, b, d = a[order], b[order], d[order]
                    keep = (np.arange(len(a)) - np.searchsorted(a, a, side="left") < k) & (d <= within[a])
                    return a[keep], b[keep], d[keep], len(keep)
            d = distances(q.take(mine), there)
            if exclude_self:
                d[q_key[mine, None] == t_key[None, cols]] = np.inf
            d[d > within[:, None]] = np.inf
            a, b = np.nonzero(_first(d, k))
            return a, b, d[a, b], d.size

        cells = []
        for j, at in _groups(train.column("__cell").to_numpy()):
            at = at[np.argsort(t_r[at], kind="stable")]
            cells.append((j, at, t_r[at]))
        centres = pivots.take([j for j, *_ in cells])
        batch = max(BATCH_ROWS, 2 * k)
        pairs, found = 0, []
        for i, whole in _groups(queries.column("__cell").to_numpy().astype(np.int64)):
            gaps = centres.to(pivots.take([i]))
            nearest_first = np.argsort(gaps, kind="stable")
            for code, inside in _groups(q_class[whole]):
                mine = whole[inside]
                limit, near = theta[mine].copy(), np.full((len(mine), k), np.inf)
                place = np.full((len(mine), k), len(t))
                if mode == "others":
                    own = t_class != code
                elif mode == "listed":
                    own = np.zeros(len(t), bool)
                    own[entries[t_class == code]] = True
                held, size, live = [], 0, np.zeros(len(mine), bool)
                for n in [*nearest_first, None]:
                    if n is not None:
                        gap, (_, at, rt) = gaps[n], cells[n]
                        room = ROOM * (gap + rq[mine] + rt[-1])
                        reached = ~(gap - rq[mine] - rt[-1] - room > limit)
                        if not reached.any():
                            continue
                        # |d(q, pivot) - r| <= d(q, row): rows whose distance to their pivot is out of reach
                        far = (rq[mine] + limit + room)[reached].max()
                        part = at
                        if np.isfinite(far):
                            part = at[np.searchsorted(rt, gap - far):np.searchsorted(rt, gap + far, side="right")]
                        part = part if own is None else part[own[part]]
                        if not len(part):
                            continue
                        held.append(part)
                        size += len(part)
                        live |= reached
                        if size < batch:
                            continue
                    if not held:
                        continue
                    cols, lines = np.sort(np.concatenate(held)), np.flatnonzero(live)
                    there = t.take(cols)
                    step = max(1, CELLS // max(len(cols), 2 * k))
                    for s in range(0, len(lines), step):
                        some = lines[s:s + step]
                        a, b, value, summed = closest(mine[some], cols, there, limit[some])
                        pairs += summed
                        if not len(a):
                            continue
                        # the new ones of a line beside those that it has
                        count = np.bincount(a, minlength=len(some))
                        more = int(count.max())
                        slot = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
                        both_d, both_p = np.full((len(some), k + more), np.inf), np.full((len(some), k + more), len(t))
                        both_d[:, :k], both_p[:, :k] = near[some], place[some]
                        both_d[a, k + slot], both_p[a, k + slot] = value, cols[b]
                        best = np.lexsort((both_p, both_d), axis=1)[:, :k]
                        near[some], place[some] = np.take_along_axis(both_d, best, axis=1), np.take_along_axis(both_p, best, axis=1)
                        limit[some] = np.minimum(limit[some], np.sqrt(near[some, -1]) * (1 + ROOM))
                    held, size, live = [], 0, np.zeros(len(mine), bool)
                full = np.flatnonzero(place[:, 0] < len(t))
                place, near = place[full], near[full]
                there = place < len(t)
                found.append((mine[full], there.sum(axis=1), place[there], near[there]))
        if counter is not None:
            counter.add(pairs)
        line, count, at, value = (np.concatenate(x) for x in zip(*found, strict=True))
        rows = train.select(["__tk", "__ty"]).take(pa.array(at))
        items = pa.StructArray.from_arrays([pa.array(value), *[rows.column(c).combine_chunks() for c in ("__tk", "__ty")]], ["__d2", "__tk", "__ty"])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32)), items)
        cols = {c: queries.column(c).combine_chunks().take(pa.array(line)) for c in [*split, "__qk"]} | {"__nb": lists}
        return pa.table([cols[f.name].cast(f.type) for f in schema], schema=schema)
    return kernel


def pivot_search(train: DataFrame, query: DataFrame, k: int, split: list[str], exclude_self: bool, mode: str,
                 weights: np.ndarray, code_weights: np.ndarray, train_block_rows: int, query_block_rows: int,
                 counter=None) -> DataFrame:
    """Candidates ``(split..., __qk, __nb)``: the ``k`` nearest training rows of every query are among those of its
    arrays of ``(__d2, __tk, __ty)``, one from each training block that it meets, of at most ``k`` each.

    ``train``: ``(split..., __tk, __ty, __tx, __tz, __tc)``, ``query``: ``(split..., __qk, __qx, __qz, __qc)``, written down;
    vectors of numbers and of level codes, each of one length, without nulls.  ``mode`` as in :func:`rarelab.operators.knn_line.line_search`.  ``counter``: an
    accumulator of the distances summed."""
    spark = train.sparkSession
    names = [*split, "__qk", "__nb"]
    near = T.StructType([T.StructField("__d2", T.DoubleType()), T.StructField("__tk", train.schema["__tk"].dataType),
                         T.StructField("__ty", train.schema["__ty"].dataType)])
    schema = T.StructType([*[train.schema[s] for s in split], T.StructField("__qk", query.schema["__qk"].dataType),
                           T.StructField("__nb", T.ArrayType(near))])
    n = train.count()
    if n == 0:
        return spark.createDataFrame([], schema)
    expose_package(spark)
    pivots = sample_pivots(train, n, weights, code_weights)
    # placed once: the counts and the search read it
    t, q = (cut_lineage(_placed(df, pivots, x, z)) for df, x, z in ((train, "__tx", "__tz"), (query, "__qx", "__qz")))

    # one row per split, class and cell
    stats = [F.count(F.lit(1)).alias("__n"), F.max("__r").alias("__far")]
    c_type = query.schema["__qc"].dataType
    t_stats = t.groupBy(*split, "__cell").agg(*stats).select(*split, F.lit(None).cast(c_type).alias("__c"), "__cell", "__n",
                                                             "__far", F.lit(True).alias("__all"))
    if mode != "own":
        each = t.select(*split, (F.explode("__tc") if mode == "listed" else F.col("__tc")).alias("__c"), "__cell", "__r")
        t_stats = t_stats.unionByName(each.groupBy(*split, "__c", "__cell").agg(*stats).withColumn("__all", F.lit(False)))
    q_stats = q.groupBy(*split, F.col("__qc").alias("__c"), "__cell").agg(*stats)
    plan_names = [*split, "__kind", "__cell", "__c", "__first", "__blocks", "__theta", "__other"]
    plan_schema = T.StructType([*[train.schema[s] for s in split], T.StructField("__kind", T.StringType()),
                                T.StructField("__cell", T.IntegerType()), T.StructField("__c", c_type),
                                T.StructField("__first", T.LongType()), T.StructField("__blocks", T.LongType()),
                                T.StructField("__theta", T.DoubleType()), T.StructField("__other", T.IntegerType())])
    group = split or [F.lit("")]
    plan = cut_lineage(q_stats.groupBy(*group).cogroup(t_stats.groupBy(*group)).applyInPandas(
        _planner(pivots, split, k + exclude_self, mode, query_block_rows, train_block_rows, plan_names), plan_schema))

    def of(kind: str, prefix: str, *cols) -> DataFrame:
        """Rows of the plan with the key columns renamed, to be joined by ``_on``."""
        return plan.where(F.col("__kind") == kind).select(*[F.col(s).alias(f"{prefix}{s}") for s in split], *cols)

    def on(df: DataFrame, other: DataFrame, prefix: str, *same) -> DataFrame:
        cond = F.lit(True)
        for s in split:
            cond = cond & F.col(s).eqNullSafe(F.col(f"{prefix}{s}"))
        for a, b in same:
            cond = cond & F.col(a).eqNullSafe(F.col(b))
        return df.join(other, cond).drop(*[f"{prefix}{s}" for s in split], *[b for _, b in same])

    blocks = F.explode(F.sequence(F.col("__first"), F.col("__first") + F.col("__blocks") - 1))
    cells = lambda kind, prefix, name: of(kind, prefix, F.col("__cell").alias(f"{prefix}c"), blocks.alias(name)).distinct()
    needed = plan.where(F.col("__kind") == "p").select(*split, "__cell", "__other")
    needed = on(needed, cells("q", "__a", "__qb"), "__a", ("__cell", "__ac"))
    needed = cut_lineage(on(needed, cells("t", "__b", "__tb"), "__b", ("__other", "__bc")).select(*split, "__qb", "__tb").distinct())
    place = lambda key: (F.col("__first") + F.pmod(F.xxhash64(key), F.col("__blocks")))
    t = on(t, of("t", "__d", F.col("__cell").alias("__dc"), "__first", "__blocks"), "__d", ("__cell", "__dc"))
    t = t.withColumn("__tb", place("__tk")).drop("__first", "__blocks")
    q = on(q, of("q", "__d", F.col("__cell").alias("__dc"), F.col("__c").alias("__dk"), "__first", "__blocks", "__theta"), "__d",
           ("__cell", "__dc"), ("__qc", "__dk"))
    q = q.withColumn("__qb", place("__qk")).drop("__first", "__blocks")
    pair = needed.select(*[F.col(s).alias(f"__e{s}") for s in split], F.col("__qb").alias("__eq"), F.col("__tb").alias("__et"))
    t = on(t, pair, "__e", ("__tb", "__et")).withColumnRenamed("__eq", "__qb")
    q = on(q, pair, "__e", ("__qb", "__eq")).withColumnRenamed("__et", "__tb")
    kernel = _kernel(pivots, k, split, exclude_self, mode, counter, to_arrow_schema(schema))
    keys = [*split, "__qb", "__tb"]
    return q.groupBy(*keys).cogroup(t.groupBy(*keys)).applyInArrow(kernel, schema).select(*names)
