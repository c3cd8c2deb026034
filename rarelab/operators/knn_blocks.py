"""Exact nearest neighbours among the rows of other classes (the other folds of a cross-validation), in any
dimension, with no candidates written down.

A tree of axis cuts, grown on a sample of the queries, deals queries and training rows to leaves.  A first pass
finds, leaf by leaf, how far the k-th neighbour of any of its queries can be: among the leaf's own training rows
for a start, by the counts and boxes of other leaves where it has too few.  Leaves that follow each other are
packed into query blocks.  A training row goes to the blocks with a leaf whose box it is near enough to, so it is
written once for each of these few.  The task of a block holds the block's queries and their nearest rows so far, and
training rows stream past, those of the block's leaves first: its memory follows the block, not the number
of training rows, and what it yields are the answers.

The tree decides how much is computed, never what is found: all bounds leave room for rounding, and distances
are summed dimension by dimension.  On data without structure every block needs every row."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rarelab.operators.knn_pivots import CELLS, ROOM, _matrix, _packed
from rarelab.session import expose_package

LEAF_QUERIES, LEAF_ROWS = 500, 4000  # of a leaf, about; more where there would be more than MOST_LEAVES
MOST_LEAVES = 4096
BOUND_ROWS = 4096  # training rows of a leaf that its first bound comes from
BATCH_ROWS = 2048  # training rows near a leaf that are compared together
LEAST_BLOCKS = 64  # where there are queries enough
BLOCK_LEAVES = 4  # in a block at least: the smaller a block, the more of the rows it reads lie around it
ANSWERS = 2000  # queries in a batch of answers
QUERY, HOME, NEAR = -1, 0, 1  # what a block's task reads, in this order


class Tree:
    """Cuts along the axes; leaves are numbered from left to right, so that neighbours have near numbers."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.dim, self.cut, self.low, self.high, self.leaf = [], [], [], [], []
        self.depth, self.leaves = 0, 0
        todo = [(sample, leaves, None, 0)]
        while todo:
            x, budget, above, depth = todo.pop()
            at = len(self.dim)
            if above is not None:
                above[0][above[1]] = at
            self.depth = max(self.depth, depth)
            found = self._halves(x) if budget > 1 else None
            if found is None:
                self._add(0, np.inf, at, at, self.leaves)
                self.leaves += 1
                continue
            dim, cut, low = found
            self._add(dim, cut, -1, -1, -1)
            few = min(budget - 1, max(1, round(budget * low.sum() / len(x))))
            todo.append((x[~low], budget - few, (self.high, at), depth + 1))
            todo.append((x[low], few, (self.low, at), depth + 1))
        self.dim, self.low, self.high, self.leaf = (np.asarray(v, np.int64) for v in (self.dim, self.low, self.high, self.leaf))
        self.cut = np.asarray(self.cut, np.float64)

    def _add(self, *values) -> None:
        for column, v in zip((self.dim, self.cut, self.low, self.high, self.leaf), values, strict=True):
            column.append(v)

    @staticmethod
    def _halves(x: np.ndarray):
        """The widest column, and the value nearest its median that leaves rows on both sides."""
        if len(x) < 2 or not x.shape[1]:
            return None
        with np.errstate(all="ignore"):
            spread = np.where(np.ptp(x, axis=0) > 0, np.nan_to_num(x.var(axis=0), nan=np.inf) + np.finfo(float).tiny, 0.0)
        dim = int(spread.argmax())
        if not spread[dim] > 0:
            return None
        v = np.sort(x[:, dim])
        steps = np.flatnonzero(v[1:] != v[:-1]) + 1
        cut = v[steps[np.abs(steps - len(v) // 2).argmin()]]
        return dim, cut, x[:, dim] < cut

    def place(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth if x.shape[1] else 0):
            at = np.where(x[rows, self.dim[at]] >= self.cut[at], self.high[at], self.low[at])
        return self.leaf[at]


def _gap2(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances to a box."""
    with np.errstate(over="ignore"):
        d = np.maximum(np.maximum(low - x, x - high), 0.0)
        return np.einsum("ij,ij->i", d, d)


def _reach2(theta, box: np.ndarray):
    """The square of a distance, with room for the rounding of both sides."""
    with np.errstate(over="ignore"):
        return np.square(theta * (1 + ROOM) + ROOM * np.abs(box).max(initial=0.0)) * (1 + ROOM)


def _finite(batch: pa.RecordBatch, numbers: str) -> tuple[pa.RecordBatch, np.ndarray]:
    """Rows whose numbers are finite: the others are at no finite distance from any."""
    x = _matrix(batch.column(numbers), np.float64)
    ok = np.isfinite(x).all(axis=1)
    return (batch, x) if ok.all() else (batch.filter(pa.array(ok)), x[ok])


def _apart2(q: np.ndarray, t: np.ndarray, q_class: np.ndarray, t_class: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances but for rounding, infinite within a class, and how far off they can be; None where a square overflows."""
    with np.errstate(all="ignore"):
        q_norm, t_norm = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", t, t)
        if not (np.isfinite(q_norm).all() and np.isfinite(t_norm).all()):
            return None, 0.0
        rough = q @ t.T
        rough *= -2
        rough += t_norm
        rough += q_norm[:, None]
    if not np.isfinite(rough).all():
        return None, 0.0
    rough[q_class[:, None] == t_class] = np.inf
    return rough, ROOM * (q_norm.max(initial=0) + t_norm.max(initial=0))


def _placer(tree: Tree, root: np.ndarray, kind: int, schema: pa.Schema):
    """Rows of one kind with their leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch, x = _finite(batch, "__x")
            n = batch.num_rows
            if n:
                made = {"__m": pa.array(tree.place(x * root)), "__o": pa.array(np.full(n, kind, np.int32))}
                yield pa.RecordBatch.from_arrays([(made[f.name] if f.name in made else batch.column(f.name)).cast(f.type) for f in schema], schema=schema)
    return run


class _Leaf:
    """What the first pass learns of a leaf."""

    def __init__(self, root: np.ndarray):
        self.x, self.c, self.held, self.root = [], [], 0, root
        self.classes, self.asked, self.theta2 = Counter(), 0, 0.0
        self.t_box = np.array([np.full(len(root), np.inf), np.full(len(root), -np.inf)])
        self.q_box = self.t_box.copy()

    def rows(self, x: np.ndarray, c: np.ndarray) -> None:
        self.t_box = np.array([np.minimum(self.t_box[0], x.min(axis=0)), np.maximum(self.t_box[1], x.max(axis=0))])
        for value, n in zip(*np.unique(c, return_counts=True), strict=True):
            self.classes[int(value)] += int(n)
        if self.held < BOUND_ROWS:
            self.x.append(x[:BOUND_ROWS - self.held])
            self.c.append(c[:BOUND_ROWS - self.held])
            self.held += len(self.x[-1])

    def queries(self, x: np.ndarray, c: np.ndarray, k: int) -> None:
        self.asked += len(x)
        self.q_box = np.array([np.minimum(self.q_box[0], x.min(axis=0)), np.maximum(self.q_box[1], x.max(axis=0))])
        if self.held < k:
            self.theta2 = np.inf
        if not np.isfinite(self.theta2):
            return
        t, tc = np.concatenate(self.x), np.concatenate(self.c)
        middle, step = t.mean(axis=0), max(1, CELLS // len(t))
        for a in range(0, len(x), step):
            d, slack = _apart2((x[a:a + step] - middle) * self.root, (t - middle) * self.root, c[a:a + step], tc)
            self.theta2 = np.inf if d is None else max(self.theta2, float(np.partition(d, k - 1, axis=1)[:, k - 1].max()) + slack)

    def summary(self, s: int, m: int) -> dict:
        n = sum(self.classes.values())
        q_box, t_box = (np.where(np.isfinite(box), box * self.root, box) for box in (self.q_box, self.t_box))
        return {"__s": s, "__m": m, "asked": self.asked, "theta": math.sqrt(max(self.theta2, 0.0)), "rows": n,
                "free": n - max(self.classes.values(), default=0), "q_low": q_box[0].tolist(), "q_high": q_box[1].tolist(),
                "t_low": t_box[0].tolist(), "t_high": t_box[1].tolist()}


def _runs(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[tuple, slice]]:
    """Stretches of equal values of integer columns."""
    cols = [batch.column(c).to_numpy() for c in names]
    new = np.zeros(batch.num_rows, bool)
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    starts = [0, *np.flatnonzero(new).tolist()]
    for lo, hi in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield tuple(int(c[lo]) for c in cols), slice(lo, hi)


def _bounder(root: np.ndarray, k: int, schema: pa.Schema):
    """A summary per split and leaf; rows come by split, leaf and kind, training rows first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, leaf = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, c = _matrix(batch.column("__x"), np.float64), batch.column("__c").to_numpy()
            for (s, m, kind), part in _runs(batch, ["__s", "__m", "__o"]):
                if (s, m) != at:
                    if leaf is not None:
                        yield pa.RecordBatch.from_pylist([leaf.summary(*at)], schema=schema)
                    at, leaf = (s, m), _Leaf(root)
                if kind == HOME:
                    leaf.rows(x[part], c[part])
                else:
                    leaf.queries(x[part], c[part], k)
        if leaf is not None:
            yield pa.RecordBatch.from_pylist([leaf.summary(*at)], schema=schema)
    return run


class _Plan:
    """Of one split: the blocks of every leaf, and how far its queries' neighbours can be."""

    def __init__(self, leaves: list, n_leaves: int, k: int, size: int, first: int):
        m = np.array([r["__m"] for r in leaves])
        box = lambda name: np.array([r[name] for r in leaves], dtype=np.float64).reshape(len(leaves), -1)
        self.low, self.high, t_low, t_high = (box(n) for n in ("q_low", "q_high", "t_low", "t_high"))
        asked, theta, free = (np.array([r[n] for r in leaves], dtype=np.float64) for n in ("asked", "theta", "free"))
        there = np.array([r["rows"] for r in leaves]) > 0
        for i in np.flatnonzero((asked > 0) & ~np.isfinite(theta)):
            # too few rows in the leaf itself: the farthest corners of as many leaves as it takes
            with np.errstate(over="ignore"):
                far = np.square(np.maximum(self.high[i] - t_low[there], t_high[there] - self.low[i])).sum(axis=1)
            order = np.argsort(far, kind="stable")
            enough = np.searchsorted(np.cumsum(free[there][order]), k)
            theta[i] = math.sqrt(_reach2(math.sqrt(far[order[enough]]), np.array([self.low[i], self.high[i]]))) if enough < len(order) else np.inf
        counts = np.zeros(n_leaves)
        counts[m] = asked
        self.first, self.blocks = _packed(counts, size)
        self.first += first
        self.end = int((self.first + self.blocks).max())
        self.theta = np.zeros(n_leaves)
        self.theta[m] = theta
        #: (first block, number of blocks, leaves, their rows here, reach of each, box, reach) of leaves that share their blocks
        self.groups = []
        wanted = np.flatnonzero(asked > 0)
        for b in np.unique(self.first[m[wanted]]):
            of = wanted[self.first[m[wanted]] == b]
            low, high = self.low[of].min(axis=0), self.high[of].max(axis=0)
            reach2 = np.array([_reach2(theta[i], np.array([self.low[i], self.high[i]])) for i in of])
            self.groups.append((int(b), int(self.blocks[m[of]].max()), m[of], of, reach2, low, high))


def _asker(tree: Tree, root: np.ndarray, plans: dict, schema: pa.Schema):
    """Queries with their block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch, x = _finite(batch, "__x")
            if not batch.num_rows:
                continue
            m, s, h = tree.place(x * root), batch.column("__s").to_numpy(), batch.column("__h").to_numpy()
            block = np.zeros(len(m), np.int64)
            for value in np.unique(s):
                at, plan = s == value, plans[int(value)]
                block[at] = plan.first[m[at]] + h[at] % plan.blocks[m[at]]
            made = {"__m": pa.array(m), "__b": pa.array(block), "__o": pa.array(np.full(len(m), QUERY, np.int32))}
            yield _batch(batch, made, schema)
    return run


def _batch(batch: pa.RecordBatch, made: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A batch's columns and new ones, null where there is neither."""
    there = set(batch.schema.names)
    cols = [made[f.name] if f.name in made else batch.column(f.name) if f.name in there else pa.nulls(batch.num_rows, f.type) for f in schema]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _sender(tree: Tree, root: np.ndarray, plans: dict, schema: pa.Schema, most: int = 20_000):
    """Training rows, once for every block that needs them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch, x = _finite(batch, "__x")
            if not batch.num_rows:
                continue
            flat, splits = x * root, batch.column("__s").to_numpy()
            leaf = tree.place(flat)
            held, size = [], 0

            def out(held=held, batch=batch, leaf=leaf):
                at, block, kind = (np.concatenate(v) for v in zip(*held, strict=True))
                held.clear()
                return _batch(batch.take(pa.array(at)), {"__m": pa.array(leaf[at]), "__b": pa.array(block), "__o": pa.array(kind)}, schema)

            for value in np.unique(splits):
                if int(value) not in plans:
                    continue
                plan, rows = plans[int(value)], np.flatnonzero(splits == value)
                for first, blocks, leaves, of, reach2, low, high in plan.groups:
                    near = rows[_gap2(flat[rows], low, high) <= reach2.max()]
                    if len(near) and len(of) > 1:
                        needed = np.zeros(len(near), bool)
                        for i, r2 in zip(of, reach2, strict=True):
                            rest = np.flatnonzero(~needed)
                            needed[rest] = _gap2(flat[near[rest]], plan.low[i], plan.high[i]) <= r2
                        near = near[needed]
                    kind = np.where(np.isin(leaf[near], leaves), HOME, NEAR)
                    for b in range(first, first + blocks if len(near) else first):
                        held.append((near, np.full(len(near), b, np.int64), kind))
                        size += len(near)
                        if size >= most:
                            yield out()
                            size = 0
            if held:
                yield out()
    return run


class _Block:
    """The queries of a block, and of each the nearest rows so far in the order of (distance, key)."""

    def __init__(self, asked: pa.Table, plan: _Plan, weights: np.ndarray, k: int):
        self.asked, self.k, self.weights, self.root = asked, k, weights, np.sqrt(weights)
        self.x, self.c = _matrix(asked.column("__x").combine_chunks(), np.float64), asked.column("__c").to_numpy()
        flat = self.x * self.root
        self.middle = self.x.mean(axis=0)
        self.flat = (self.x - self.middle) * self.root
        n = len(self.x)
        self.d, self.key, self.y = np.full((n, k), np.inf), np.full((n, k), np.iinfo(np.int64).max), np.zeros((n, k), bool)
        leaf = asked.column("__m").to_numpy()
        order = np.argsort(leaf, kind="stable")
        cuts = np.flatnonzero(np.diff(leaf[order])) + 1
        self.leaves = []
        self.limit = plan.theta[leaf]
        for mine in np.split(order, cuts):
            part = flat[mine]
            self.leaves.append({"mine": mine, "low": part.min(axis=0), "high": part.max(axis=0), "held": [], "size": 0})

    def rows(self, x: np.ndarray, key: np.ndarray, y: np.ndarray, c: np.ndarray) -> None:
        flat = x * self.root
        for leaf in self.leaves:
            far = self.limit[leaf["mine"]].max()
            near = np.flatnonzero(_gap2(flat, leaf["low"], leaf["high"]) <= _reach2(far, np.array([leaf["low"], leaf["high"]])))
            if len(near):
                leaf["held"].append((x[near], (x[near] - self.middle) * self.root, key[near], y[near], c[near]))
                leaf["size"] += len(near)
                if leaf["size"] >= BATCH_ROWS:
                    self._compare(leaf)

    def finish(self) -> None:
        for leaf in self.leaves:
            if leaf["size"]:
                self._compare(leaf)

    def _compare(self, leaf: dict) -> None:
        x, flat, key, y, c = (np.concatenate(v) for v in zip(*leaf["held"], strict=True))
        leaf["held"], leaf["size"] = [], 0
        step = max(1, CELLS // max(len(x), 2 * self.k))
        for a in range(0, len(leaf["mine"]), step):
            mine = leaf["mine"][a:a + step]
            line, row, d = self._within(mine, x, flat, c)
            if not len(line):
                continue
            order = np.lexsort((key[row], d, line))
            line, row, d = line[order], row[order], d[order]
            at = np.arange(len(line)) - np.searchsorted(line, line, side="left")
            first = at < self.k
            line, row, d, at = line[first], row[first], d[first], at[first]
            # the new ones of a query beside those that it has
            new, line = np.unique(line, return_inverse=True)
            some, more = mine[new], int(at.max()) + 1
            both_d = np.concatenate((self.d[some], np.full((len(some), more), np.inf)), axis=1)
            both_key = np.concatenate((self.key[some], np.full((len(some), more), np.iinfo(np.int64).max)), axis=1)
            both_y = np.concatenate((self.y[some], np.zeros((len(some), more), bool)), axis=1)
            both_d[line, self.k + at], both_key[line, self.k + at], both_y[line, self.k + at] = d, key[row], y[row]
            best = np.lexsort((both_key, both_d), axis=1)[:, :self.k]
            self.d[some], self.key[some], self.y[some] = (np.take_along_axis(v, best, axis=1) for v in (both_d, both_key, both_y))
            self.limit[some] = np.minimum(self.limit[some], np.sqrt(self.d[some, -1]))

    def _within(self, mine: np.ndarray, x: np.ndarray, flat: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Line, row and squared distance of the pairs that can be among the nearest; of each distance that a matrix
        product does not rule out, the sum dimension by dimension, as SQL sums."""
        rough, slack = _apart2(self.flat[mine], flat, self.c[mine], c)
        with np.errstate(over="ignore"):
            within = np.square(self.limit[mine]) * (1 + 4 * ROOM)
        if rough is None:
            hit = self.c[mine][:, None] != c
        else:
            hit = rough <= np.minimum(within + 2 * slack, np.finfo(np.float64).max)[:, None]
            if len(x) > self.k and np.count_nonzero(hit) > 4 * self.k * len(mine):
                kth = np.partition(rough, self.k - 1, axis=1)[:, self.k - 1] + 2 * slack
                hit = rough <= np.minimum(np.minimum(within + 2 * slack, kth), np.finfo(np.float64).max)[:, None]
        line, row = np.nonzero(hit)
        d = np.zeros(len(line))
        with np.errstate(all="ignore"):
            for dim, w in enumerate(self.weights):
                diff = self.x[mine[line], dim] - x[row, dim]
                d += (diff * diff) * w
            keep = np.isfinite(d) & (d <= within[line])
        return line[keep], row[keep], d[keep]

    def answers(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The queries with a neighbour."""
        found = np.flatnonzero(np.isfinite(self.d[:, 0]))
        for a in range(0, len(found), ANSWERS):
            at = found[a:a + ANSWERS]
            there = np.isfinite(self.d[at])
            items = pa.StructArray.from_arrays([pa.array(v[at][there]) for v in (self.d, self.key, self.y)], ["__d2", "__tk", "__ty"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(there.sum(axis=1)))).astype(np.int32)), items)
            rows = self.asked.take(pa.array(at)).combine_chunks().to_batches()[0]
            yield _batch(rows, {"__nb": lists}, schema)


def _searcher(plans: dict, weights: np.ndarray, k: int, schema: pa.Schema):
    """Rows come by block and kind: its queries, then the training rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked, block = None, [], None

        def answers():
            if block is not None:
                block.finish()
                yield from block.answers(schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            kind = np.where(batch.column("__o").to_numpy() == QUERY, 0, 1)
            batch = batch.append_column("__kind", pa.array(kind))
            for (b, is_train, s), part in _runs(batch, ["__b", "__kind", "__s"]):
                if b != at:
                    yield from answers()
                    at, asked, block = b, [], None
                rows = batch.slice(part.start, part.stop - part.start)
                if not is_train:
                    asked.append(rows)
                    continue
                if block is None:
                    if not asked:
                        continue
                    block, asked = _Block(pa.Table.from_batches(asked), plans[s], weights, k), []
                block.rows(_matrix(rows.column("__x"), np.float64), rows.column("__tk").to_numpy(),
                           rows.column("__ty").to_numpy(zero_copy_only=False).astype(bool), rows.column("__c").to_numpy())
        yield from answers()
    return run


def block_search(train: DataFrame, query: DataFrame, k: int, weights: np.ndarray, carry: list[str],
                 query_block_rows: int = 20000) -> DataFrame:
    """``(__s, __qk, carry..., __nb)``: of every query with a neighbour the first ``k`` training rows of another class in
    (distance, key) order, as an array of ``(__d2, __tk, __ty)``.

    ``train``: ``(__s, __tk, __ty, __c, __x)``, ``query``: ``(__s, __qk, __c, __x, carry...)``, written down; integer splits
    ``__s``, classes ``__c`` and keys, keys unique in a split, boolean ``__ty``, vectors of one length, none null."""
    spark = train.sparkSession
    n, asked = train.count(), query.count()
    near = T.StructType([T.StructField("__d2", T.DoubleType()), T.StructField("__tk", T.LongType()), T.StructField("__ty", T.BooleanType())])
    answer = T.StructType([T.StructField("__s", T.LongType()), query.schema["__qk"], *[query.schema[c] for c in carry],
                           T.StructField("__nb", T.ArrayType(near))])
    if not n or not asked:
        return spark.createDataFrame([], answer)
    expose_package(spark)
    root = np.sqrt(weights)
    long, vector = T.LongType(), T.ArrayType(T.DoubleType())
    kinds = {"__s": long, "__m": long, "__o": T.IntegerType(), "__c": long, "__x": vector}
    fields = lambda names: T.StructType([T.StructField(c, kinds[c]) for c in names])
    train = train.select(F.col("__s").cast(long), F.col("__tk").cast(long), "__ty", F.col("__c").cast(long), "__x")
    query = query.select(F.col("__s").cast(long), "__qk", F.col("__c").cast(long), "__x", F.xxhash64("__qk").alias("__h"), *carry)

    leaves = min(MOST_LEAVES, max(1, math.ceil(asked / LEAF_QUERIES), math.ceil(n / LEAF_ROWS)))
    rows = query.select("__x", "__h").orderBy("__h").limit(8 * leaves).collect()
    sample = np.asarray([r["__x"] for r in rows], dtype=np.float64).reshape(len(rows), -1) * root
    tree = Tree(sample[np.isfinite(sample).all(axis=1)], leaves)

    # how far the neighbours of a leaf's queries can be: one row per split and leaf
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((n + asked) / 1_000_000))
    placed = fields(["__s", "__m", "__o", "__c", "__x"])
    put = lambda df, kind: df.select("__s", "__c", "__x").mapInArrow(_placer(tree, root, kind, to_arrow_schema(placed)), placed)
    summary = T.StructType([T.StructField("__s", long), T.StructField("__m", long), T.StructField("asked", long), T.StructField("theta", T.DoubleType()),
                            T.StructField("rows", long), T.StructField("free", long),
                            *[T.StructField(c, vector) for c in ("q_low", "q_high", "t_low", "t_high")]])
    met = put(train, HOME).unionByName(put(query, NEAR)).repartition(spread, "__s", "__m").sortWithinPartitions("__s", "__m", "__o")
    by_split: dict = {}
    for r in met.mapInArrow(_bounder(root, k, to_arrow_schema(summary)), summary).collect():
        by_split.setdefault(r["__s"], []).append(r)
    total = sum(r["asked"] for of in by_split.values() for r in of)
    size, plans, blocks = min(query_block_rows, max(BLOCK_LEAVES * LEAF_QUERIES, math.ceil(total / LEAST_BLOCKS))), {}, 0
    for s in sorted(by_split):
        plans[s] = _Plan(sorted(by_split[s], key=lambda r: r["__m"]), tree.leaves, k, size, blocks)
        blocks = plans[s].end

    task = T.StructType([*fields(["__s", "__m", "__o"]), T.StructField("__b", long), T.StructField("__tk", long), T.StructField("__ty", T.BooleanType()),
                         query.schema["__qk"], *[query.schema[c] for c in carry], *fields(["__c", "__x"])])
    task = T.StructType([T.StructField(f.name, f.dataType, True) for f in task])
    answer = T.StructType([T.StructField(f.name, f.dataType, True) for f in answer])
    sent = train.mapInArrow(_sender(tree, root, plans, to_arrow_schema(task)), task).unionByName(
        query.mapInArrow(_asker(tree, root, plans, to_arrow_schema(task)), task))
    sent = sent.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * blocks), "__b").sortWithinPartitions("__b", "__o", "__m")
    return sent.mapInArrow(_searcher(plans, weights, k, to_arrow_schema(answer)), answer)
