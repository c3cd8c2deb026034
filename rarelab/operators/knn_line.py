"""Exact nearest neighbours on a line: training rows of one feature, in one shuffle.

Training rows and the distinct query values are range-partitioned together by
(split, value, key).  A partition answers its queries from its own rows, sorted
once in each direction.  Beside the answers it writes the few rows at its two
ends (as many as a query asks for, per class).  Only queries near an end - a
neighbour outside the partition could be as near as the farthest one found -
are completed with the rows that the ends of the partitions beside theirs hold,
gathered over as many partitions as it takes.

A training row may belong to several searches: ``listed`` rows carry the classes
they train for (the folds of a cross-validation, say) as an array, and
``others`` rows train for every class but their own.  Neither is copied."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rarelab.session import cut_lineage, expose_package

DONE, OPEN, EDGE = 0, 1, 2
RIGHT, LEFT = 0, 1
CELLS = 2_000_000  # candidate distances held at once


def _codes(parts: list[pa.ChunkedArray]) -> tuple[list[np.ndarray], pa.Array]:
    """Numbers that equal values of several columns share (null is a value), and the values by number."""
    flat = [p.combine_chunks() if isinstance(p, pa.ChunkedArray) else p for p in parts]
    coded = pa.concat_arrays([f.cast(flat[0].type) for f in flat]).dictionary_encode(null_encoding="encode")
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.cumsum([len(f) for f in flat])[:-1]
    return np.split(numbers, cuts), coded.dictionary


def _order_of(keys: pa.Array) -> np.ndarray:
    """Integers that sort like the keys."""
    values = keys.to_numpy(zero_copy_only=False)
    return values if values.dtype.kind in "iu" else np.unique(values, return_inverse=True)[1]


class _Ordered:
    """Entries (training rows of a group) by group and value, forwards and backwards; keys ascend among equals."""

    def __init__(self, entries: np.ndarray, group: np.ndarray, x: np.ndarray, key: np.ndarray):
        forward = np.lexsort((key[entries], x[entries], group))
        backward = np.lexsort((key[entries], -x[entries], group))
        self.forward, self.backward, self.group = entries[forward], entries[backward], group[forward]

    def of(self, g: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = np.searchsorted(self.group, [g, g + 1])
        return self.forward[lo:hi], self.backward[lo:hi]


def _nearest(v: np.ndarray, forward: np.ndarray, backward: np.ndarray, lo: np.ndarray, hi: np.ndarray, below: np.ndarray,
             x: np.ndarray, key: np.ndarray, take: int, weight: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each value the ``take`` nearest rows (-1: none), the farthest's distance, and how many rows are not below it.
    Its group is ``lo`` to ``hi`` of both orders, ``below`` the first place of ``forward`` that is not below it."""
    steps, above = np.arange(take), hi - below
    right, left = below[:, None] + steps, (lo + above)[:, None] + steps
    n = len(forward)
    at = np.concatenate((np.where(right < hi[:, None], forward[np.minimum(right, n - 1)], -1),
                         np.where(left < hi[:, None], backward[np.minimum(left, n - 1)], -1)), axis=1) if n else np.full((len(v), take), -1)
    diff = v[:, None] - x[at] if len(x) else np.zeros(at.shape)
    d2 = weight * diff * diff
    first = np.lexsort((key[at] if len(key) else at, d2, at < 0), axis=1)[:, :take]
    at, d2 = np.take_along_axis(at, first, axis=1), np.take_along_axis(d2, first, axis=1)
    return at, np.where(at[:, -1] >= 0, d2[:, -1], np.inf), above


def _kernel(split: list[str], take: int, weight: float, mode: str, schema: pa.Schema):
    def lists(at: np.ndarray, rows: pa.Table) -> pa.Array:
        """A list of (x, key, label) per line of row numbers, -1 left out."""
        size = (at >= 0).sum(axis=1)
        flat = rows.take(pa.array(at[at >= 0]))
        items = pa.StructArray.from_arrays([flat.column(c).combine_chunks() for c in ("__v", "__tk", "__ty")], ["__x", "__tk", "__ty"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        part = TaskContext.get().partitionId()
        sid = (table.select(split).to_pandas().groupby(split, dropna=False, sort=False).ngroup().to_numpy() if split
               else np.zeros(table.num_rows, np.int64))
        is_t = table.column("__flag").to_numpy() == 1
        rows, asks = table.filter(pa.array(is_t)), table.filter(pa.array(~is_t))
        t_sid, q_sid = sid[is_t], sid[~is_t]
        x, v = rows.column("__v").to_numpy(), asks.column("__v").to_numpy()
        key = _order_of(rows.column("__tk").combine_chunks())
        every = np.arange(len(x))
        entries, names = every, pa.nulls(1, schema.field("__c").type)
        t_class, q_class = np.zeros(len(x), np.int64), np.zeros(len(v), np.int64)
        if mode == "others":
            (t_class, q_class), names = _codes([rows.column("__tc"), asks.column("__c")])
        elif mode == "listed":
            belongs = rows.column("__tc").combine_chunks()
            entries = np.repeat(every, belongs.value_lengths().fill_null(0).to_numpy())
            (t_class, q_class), names = _codes([belongs.flatten(), asks.column("__c")])
        classes = len(names)
        by_class = _Ordered(entries, t_sid[entries] * classes + t_class, x, key)
        by_split = _Ordered(every, t_sid, x, key) if mode == "others" else by_class
        # the farthest values of each split here: another split's rows say nothing of where this one's go on
        both_v, both_s = np.concatenate((x, v)), np.concatenate((t_sid, q_sid))
        lows, highs = np.full(sid.max() + 1, np.inf), np.full(sid.max() + 1, -np.inf)
        np.minimum.at(lows, both_s, both_v)
        np.maximum.at(highs, both_s, both_v)
        # rows come in the order of their splits: only the first and the last split can go on in other partitions
        first, last = sid[0], sid[-1]

        def batch(kind, source, at, c, value, side, near):
            n = len(at)
            cols = {s: source.column(s).combine_chunks().take(pa.array(at)) for s in split}
            cols |= {"__kind": pa.array(np.broadcast_to(kind, n).astype(np.int32)), "__part": pa.array(np.full(n, part, np.int32)),
                     "__c": names.take(pa.array(c)), "__v": value, "__side": side, "__nb": near}
            return pa.RecordBatch.from_arrays([cols[f.name].cast(f.type) for f in schema], schema=schema)

        def answers(mine, at, far, above):
            s = q_sid[mine]
            # strictly farther than the farthest found: nothing beyond that end can belong to the answer
            to_high, to_low = highs[s] - v[mine], v[mine] - lows[s]
            open_ = (s == last) & (above < take) & ~(weight * to_high * to_high > far) | (s == first) & ~(weight * to_low * to_low > far)
            return batch(np.where(open_, OPEN, DONE), asks, mine, q_class[mine], pa.array(v[mine]),
                         pa.nulls(len(mine), pa.int32()), lists(at, rows))

        group = q_sid * classes + q_class
        step = max(1, CELLS // (2 * take))
        if mode == "others":
            by_group = np.argsort(group, kind="stable")
            cuts = np.searchsorted(group[by_group], np.unique(group), side="left").tolist() + [len(group)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                s, c = q_sid[by_group[lo]], q_class[by_group[lo]]
                forward, backward = by_split.of(s)
                forward, backward = forward[t_class[forward] != c], backward[t_class[backward] != c]
                for a in range(lo, hi, step):
                    mine = by_group[a:min(a + step, hi)]
                    below = np.searchsorted(x[forward], v[mine], side="left")
                    yield answers(mine, *_nearest(v[mine], forward, backward, np.zeros(len(mine), np.int64),
                                                  np.full(len(mine), len(forward)), below, x, key, take, weight))
        else:
            # all groups at once, however many: an entry's place is that of (group, value)
            rank = np.unique(both_v, return_inverse=True)[1].astype(np.int64)
            ranks = len(both_v) + 1
            place = by_class.group * ranks + rank[:len(x)][by_class.forward]
            for a in range(0, len(v), step):
                mine = np.arange(a, min(a + step, len(v)))
                lo, hi = (np.searchsorted(by_class.group, group[mine], side=side) for side in ("left", "right"))
                below = np.searchsorted(place, group[mine] * ranks + rank[len(x):][mine], side="left")
                yield answers(mine, *_nearest(v[mine], by_class.forward, by_class.backward, lo, hi, below, x, key, take, weight))
        for side, order in ((RIGHT, by_class.forward), (LEFT, by_class.backward)):
            starts = np.unique(by_class.group, return_index=True)[1] if len(by_class.group) else np.empty(0, np.int64)
            ends = np.append(starts[1:], len(order))
            open_ = np.isin(by_class.group[starts] // classes, (first, last))
            starts, ends = starts[open_], ends[open_]
            if not len(starts):
                continue
            at = starts[:, None] + np.arange(take)
            at = np.where(at < ends[:, None], order[np.minimum(at, len(order) - 1)], -1)
            yield batch(EDGE, rows, at[:, 0], by_class.group[starts] % classes, pa.nulls(len(at), pa.float64()),
                        pa.array(np.full(len(at), side, np.int32)), lists(at, rows))
    return run


def _ends(take: int, schema: pa.Schema):
    """Of one split: for every partition that asks, the rows nearest beyond each of its ends, per class."""
    def run(need: pa.Table, edges: pa.Table) -> pa.Table:
        out, ends = [], {}
        for e in edges.sort_by("__part").to_pylist():
            ends.setdefault((e["__c"], e["__side"]), []).append(e)
        for (_, side), walked in ends.items():
            todo = sorted(set(need.column("__asks").to_pylist()), reverse=side == RIGHT)
            state = []
            for e in [*(walked if side == LEFT else reversed(walked)), None]:
                # what has been gathered so far lies beyond every partition up to this one
                while todo and (e is None or (todo[0] >= e["__part"] if side == RIGHT else todo[0] <= e["__part"])):
                    p = todo.pop(0)
                    if state:
                        out.append({**walked[0], "__part": p, "__nb": state})
                if e is not None:
                    state = [*e["__nb"], *state]
                    if side == LEFT:  # equal values go on in the partition before, which has the smaller keys
                        state.sort(key=lambda r: (-r["__x"], r["__tk"]))
                    state = state[:take]
        return pa.Table.from_pylist(out, schema=schema)
    return run


def line_search(train: DataFrame, values: DataFrame, take: int, split: list[str], weight: float, mode: str = "own",
                rows_per_bucket: int = 2_000_000) -> DataFrame:
    """``(split..., __c, __v, __nb)``: for every distinct query value its first ``take`` training rows in
    (distance, key) order, as an array of ``(__d2, __tk, __ty)``; values without any are left out.

    ``train``: ``(split..., __v, __tk, __ty, __tc)``, ``values``: ``(split..., __c, __v)`` without repeats, both
    written down, keys unique in a split.  ``mode``: ``own`` - all rows of the split (``__c``, ``__tc``
    null); ``others`` - those whose class ``__tc`` is not the value's ``__c``; ``listed`` - those whose
    array ``__tc`` names it.  Memory: one partition of ``rows_per_bucket`` rows a task."""
    spark = train.sparkSession
    kt, yt = train.schema["__tk"].dataType, train.schema["__ty"].dataType
    u = values.select(*split, "__c", "__v", F.lit(0).alias("__flag"), F.lit(None).cast(kt).alias("__tk"),
                      F.lit(None).cast(yt).alias("__ty"), F.lit(None).cast(train.schema["__tc"].dataType).alias("__tc"))
    u = u.unionByName(train.select(*split, F.lit(None).cast(values.schema["__c"].dataType).alias("__c"), "__v",
                                   F.lit(1).alias("__flag"), "__tk", "__ty", "__tc"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(u.count() / rows_per_bucket))
    item = T.StructType([T.StructField("__x", T.DoubleType()), T.StructField("__tk", kt), T.StructField("__ty", yt)])
    schema = T.StructType([*[values.schema[s] for s in split], T.StructField("__kind", T.IntegerType()),
                           T.StructField("__part", T.IntegerType()), T.StructField("__c", values.schema["__c"].dataType),
                           T.StructField("__v", T.DoubleType()), T.StructField("__side", T.IntegerType()),
                           T.StructField("__nb", T.ArrayType(item))])
    expose_package(spark)
    ranged = u.repartitionByRange(parts, *split, "__v", "__flag", "__tk")
    ranged = ranged.sortWithinPartitions(*split) if split else ranged
    found = cut_lineage(ranged.mapInArrow(_kernel(split, take, weight, mode, to_arrow_schema(schema)), schema))

    def finished(df: DataFrame) -> DataFrame:
        diff = lambda n: F.col("__v") - n["__x"]
        near = F.transform("__nb", lambda n: F.struct((F.lit(weight) * diff(n) * diff(n)).alias("__d2"), n["__tk"].alias("__tk"),
                                                      n["__ty"].alias("__ty")))
        return df.select(*split, "__c", "__v", near.alias("__nb"))

    waiting, edges = found.where(F.col("__kind") == OPEN), found.where(F.col("__kind") == EDGE)
    # one row per split and partition, and a few per class of them
    group = split or [F.lit("")]
    names = [*split, "__c", "__side", "__part", "__nb"]
    ends_schema = T.StructType([schema[n] for n in names])
    need = waiting.select(*[F.col(s).alias(f"__n_{s}") for s in split], F.col("__part").alias("__asks")).distinct()
    ends = need.groupBy(*([f"__n_{s}" for s in split] or [F.lit("")])).cogroup(edges.select(*names).groupBy(*group)).applyInArrow(
        _ends(take, to_arrow_schema(ends_schema)), ends_schema)
    e = ends.select(*[F.col(s).alias(f"__e_{s}") for s in split], F.col("__c").alias("__e_c"), F.col("__part").alias("__e_part"),
                    F.col("__nb").alias("__e_nb"))
    w = waiting.select(*split, "__c", "__v", "__part")
    same = (F.col("__part") == F.col("__e_part"))
    for s in split:
        same = same & F.col(s).eqNullSafe(F.col(f"__e_{s}"))
    if mode == "others":
        same = same & ~F.col("__c").eqNullSafe(F.col("__e_c"))
    elif mode == "listed":
        same = same & F.col("__c").eqNullSafe(F.col("__e_c"))
    beyond = w.join(e, same).select(*split, "__c", "__v", F.col("__e_nb").alias("__nb"))
    local = waiting.select(*split, "__c", "__v", "__nb")
    merged = finished(local.unionByName(beyond)).groupBy(*split, "__c", "__v").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("__nb"))), 1, take).alias("__nb"))
    return finished(found.where(F.col("__kind") == DONE)).unionByName(merged).where(F.size("__nb") > 0)
