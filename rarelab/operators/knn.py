"""Exact k-nearest-neighbour search and classification (inventory H1, H2, J1).

Distance is weighted Euclidean, ``sum_j w_j (q_j - t_j)^2``: with
``w_j = 1 / std_j^2`` it equals the distance between standardised rows, but
the differences are taken on the raw values, so exact ties stay exact.  Ties in
distance are broken by the training key (lower key first); the vote is a
uniform majority with ties going to the lower class.

Two exact strategies:

* ``sorted`` (one feature, :mod:`rarelab.operators.knn_line`): training rows and
  the distinct query values meet in one range shuffle; a partition answers from
  its own sorted rows, and the few queries near its ends are completed from the
  partitions beside it.  O(n log n), nothing pairwise.
* ``pivots`` (any dimension, :mod:`rarelab.operators.knn_pivots`): rows belong to
  the cells of sampled pivots; cells that the triangle inequality rules out are
  never compared.  Without structure in the data (high dimension, noise) all
  pairs remain, the inherent O(n_query * n_train) of exact search; memory per
  task is bounded by the block sizes, and a query block leaves at most k rows
  per query and training block.

Where whole classes are left out (``exclude_col``) and keys are integers, unique and not null, ``blocks``
(any dimension, :mod:`rarelab.operators.knn_blocks`) writes no candidates: training rows stream past a block of
queries, each written once per block that needs it.

Rows of level codes and one number at most, searched without classes, need no pairs either
(:mod:`rarelab.operators.knn_codes`): a line per level, and one of all levels.

All accept ``split`` columns (independent problems, e.g. cross-validation
splits), self-exclusion (leave-one-out), the exclusion of pairs that share the
value of a column of few values (``exclude_col``), and training rows that list
the values they are for (``member_col``): every fold of a k-fold split is scored
in one pass without replicating training rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarelab.operators.knn_blocks import block_search
from rarelab.operators.knn_codes import code_search
from rarelab.operators.knn_line import line_search
from rarelab.operators.knn_pivots import pivot_search
from rarelab.session import cut_lineage


# ---------------------------------------------------------------- helpers
def _feature_array(cols) -> F.Column:
    if isinstance(cols, str):
        return F.col(cols).cast("array<double>")
    return F.array(*[F.col(c).cast("double") for c in cols]).cast("array<double>")


def _code_array(cols: list[str]) -> F.Column:
    """Level codes, -1 where there is none."""
    return F.array(*[F.coalesce(F.col(c).cast("bigint"), F.lit(-1)) for c in cols]).cast("array<bigint>")


def _dim(df: DataFrame, cols) -> int:
    if isinstance(cols, str):
        row = df.select(F.size(cols).alias("n")).limit(1).first()
        return int(row["n"]) if row else 0
    return len(cols)


# ------------------------------------------------------------------ public API
def knn_neighbors(train: DataFrame, query: DataFrame, features, k: int, key: str = "entity_id",
                  label: str = "label", query_key: str | None = None, split=None,
                  weights=None, exclude_self: bool = False, exclude_col: str | None = None,
                  member_col: str | None = None, codes: list[str] | None = None, code_weights=None, method: str = "auto", train_block_rows: int = 20000,
                  query_block_rows: int = 20000, as_arrays: bool = False, counter=None, carry=()) -> DataFrame:
    """The k nearest training rows of every query row, exactly.

    ``features``: a list of numeric columns or one array column.  Returns
    ``(split..., query_key, neighbor_key, neighbor_label, distance, rank)``,
    rank 1..k in (distance, neighbour key) order.  Training rows and queries
    with a null or NaN feature are left out.  With ``exclude_col`` a query and a
    training row that share its value are no pair; with ``member_col`` as well
    (an array column of the training rows) a training row is for the queries
    whose ``exclude_col`` it lists.  ``codes``: columns of level codes
    (:func:`rarelab.operators.sparse.encode_levels`) that count as their one-hot columns, whatever the number of
    levels, null or negative as none.  With ``as_arrays`` one row per query, ``(split..., query_key, neighbors)``
    holding the same k structs in rank order (bounded by k).  ``counter``: an
    accumulator of the distances that the pivots method sums.

    Method ``blocks`` asks for ``exclude_col`` without ``member_col``, codes and self-exclusion, integers as split (one
    column at most), ``exclude_col`` and key, training keys that are unique in a split and not null, and boolean
    labels; its results hold the queries' columns ``carry`` as well."""
    split = [split] if isinstance(split, str) else list(split or [])
    query_key = query_key or key
    dim = _dim(train, features)
    w = np.ones(dim) if weights is None else np.asarray(weights, dtype=float)
    codes = list(codes or [])
    cw = np.ones(len(codes)) if code_weights is None else np.asarray(code_weights, dtype=float)
    if method == "auto":
        method = "sorted" if dim == 1 and not codes else "pivots"
    if method not in ("sorted", "pivots", "blocks") or method == "sorted" and (dim != 1 or codes):
        raise ValueError(f"no method {method!r} for {dim} features")
    mode = "own" if exclude_col is None else "others" if member_col is None else "listed"
    if method == "blocks" and (mode != "others" or codes or exclude_self or len(split) > 1 or not dim):
        raise ValueError("method 'blocks' leaves out classes, of one split column at most")
    if carry and method != "blocks":
        raise ValueError(f"method {method!r} carries no columns")
    if train is query and query_key == key:
        # self-search (leave-one-out, SMOTE neighbours): materialise the rows once
        fcols = [features] if isinstance(features, str) else list(features)
        train = query = cut_lineage(train.select(*split, key, label, *fcols,
                                                 *([exclude_col] if exclude_col else []), *([member_col] if member_col else []),
                                                 *codes))
    of_train = F.lit(None).cast("int") if mode == "own" else F.col(member_col or exclude_col)
    of_query = F.lit(None).cast("int") if mode == "own" else F.col(exclude_col)
    t = train.select(*split, F.col(key).alias("__tk"), F.col(label).alias("__ty"),
                     _feature_array(features).alias("__tx"), _code_array(codes).alias("__tz"), of_train.alias("__tc"))
    q = query.select(*split, F.col(query_key).alias("__qk"), _feature_array(features).alias("__qx"),
                     _code_array(codes).alias("__qz"), of_query.alias("__qc"), *carry)
    # a row with a null or NaN feature has no distances: it is neither found nor searched for
    whole = lambda c: F.col(c).isNotNull() & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x))
    t, q = t.where(whole("__tx")), q.where(whole("__qx"))
    if method == "sorted":
        # each side is read several times (counts, samples, the search)
        if train is not query:
            t, q = cut_lineage(t), cut_lineage(q)
        qv = q.select(*split, "__qk", F.col("__qx")[0].alias("__v"), F.col("__qc").alias("__c"))
        line = t.select(*split, F.col("__tx")[0].alias("__v"), "__tk", "__ty", "__tc")
        lists = line_search(line, qv.select(*split, "__c", "__v").distinct(), k + exclude_self, split, float(w[0]), mode)
        lists = lists.select(*[F.col(s).alias(f"__l_{s}") for s in split], F.col("__c").alias("__l_c"), F.col("__v").alias("__l_v"), "__nb")
        same = (F.col("__v") == F.col("__l_v")) & F.col("__c").eqNullSafe(F.col("__l_c"))
        for s in split:
            same = same & (F.col(s) == F.col(f"__l_{s}"))
        arrays = qv.join(lists, same)
        if exclude_self:
            arrays = arrays.withColumn("__nb", F.slice(F.filter("__nb", lambda n: n["__tk"] != F.col("__qk")), 1, k))
        arrays = arrays.select(*split, "__qk", "__nb")
    elif method == "blocks":
        arrays = _by_blocks(t, q, k, split, w, list(carry), query_block_rows)
    else:
        arrays = _by_pivots(t, q, k, split, exclude_self, mode, w, cw, train_block_rows, query_block_rows, counter)
    if as_arrays:
        return arrays.select(*split, F.col("__qk").alias(query_key), *carry, F.transform("__nb", lambda n: F.struct(
            n["__tk"].alias("neighbor_key"), n["__ty"].alias("neighbor_label"),
            F.sqrt(n["__d2"]).alias("distance"))).alias("neighbors"))
    top = (arrays.select(*split, "__qk", *carry, F.posexplode("__nb").alias("__p", "__n"))
           .select(*split, "__qk", *carry, "__n.__tk", "__n.__ty", "__n.__d2", (F.col("__p") + 1).alias("rank")))
    return top.select(*split, F.col("__qk").alias(query_key), *carry, F.col("__tk").alias("neighbor_key"),
                      F.col("__ty").alias("neighbor_label"), F.sqrt("__d2").alias("distance"),
                      F.col("rank").cast("int").alias("rank"))


def _by_blocks(t: DataFrame, q: DataFrame, k: int, split: list[str], w, carry: list[str], query_block_rows: int) -> DataFrame:
    """``(split..., __qk, carry..., __nb)`` of the blocks method.  Of equal training rows of a class only the first ``k`` by
    key can be in an answer."""
    split_types = [(c, q.schema[c].dataType) for c in split]
    none = -2 ** 63  # null splits and classes are a value
    whole = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(none))
    s = whole(split[0]) if split else F.lit(0).cast("bigint")
    t = t.select(s.alias("__s"), F.col("__tk").cast("bigint").alias("__tk"), "__ty", whole("__tc").alias("__c"), "__tx")
    among = Window.partitionBy("__s", "__tx", "__c").orderBy("__tk")
    t = cut_lineage(t.withColumn("__at", F.row_number().over(among)).where(F.col("__at") <= k)
                    .select("__s", "__tk", "__ty", "__c", F.col("__tx").alias("__x")))
    q = cut_lineage(q.select(s.alias("__s"), "__qk", whole("__qc").alias("__c"), F.col("__qx").alias("__x"),
                             *[F.col(c).alias(f"__with_{c}") for c in carry]))
    found = block_search(t, q, k, w, [f"__with_{c}" for c in carry], query_block_rows)
    back = [F.when(F.col("__s") != none, F.col("__s")).cast(t_type).alias(c) for c, t_type in split_types]
    return found.select(*back, "__qk", *[F.col(f"__with_{c}").alias(c) for c in carry], "__nb")


def _by_pivots(t: DataFrame, q: DataFrame, k: int, split: list[str], exclude_self: bool, mode: str, w, cw,
               train_block_rows: int, query_block_rows: int, counter) -> DataFrame:
    """``(split..., __qk, __nb)`` of the pivots method: equal queries are one search, and of equal training rows
    only those that an answer can hold are searched: the first by key, as many as a query asks for (of
    each class, where queries leave out one)."""
    t, q = cut_lineage(t), cut_lineage(q)
    first = lambda nb, n: F.slice(F.array_sort(F.flatten(F.collect_list(nb))), 1, n)
    if exclude_self:
        known = t.where(F.col("__tk").isNotNull()).groupBy(*split, "__tk").agg(F.count(F.lit(1)).alias("n"))
        if not known.where("n > 1").isEmpty():
            # a query leaves out as many rows as have its key
            cand = pivot_search(t, q, k, split, True, mode, w, cw, train_block_rows, query_block_rows, counter)
            return cand.groupBy(*split, "__qk").agg(first("__nb", k).alias("__nb"))
    take = k + exclude_self
    if mode != "listed":
        among = Window.partitionBy(*split, "__tx", "__tz", *(["__tc"] if mode == "others" else [])).orderBy(F.col("__tk").asc_nulls_last())
        t = cut_lineage(t.withColumn("__at", F.row_number().over(among)).where(F.col("__at") <= take).drop("__at"))
    at = [*split, "__qx", "__qz", "__qc"]
    points = cut_lineage(q.select(*at).distinct().withColumn("__qk", F.monotonically_increasing_id()))
    if mode == "own" and len(cw) and len(w) < 2 and (w > 0).all() and (cw >= 0).all():
        cand = code_search(t, points, take, split, w, cw)
    else:
        cand = pivot_search(t, points, take, split, False, mode, w, cw, train_block_rows, query_block_rows, counter)
    lists = cand.groupBy(*split, "__qk").agg(first("__nb", take).alias("__nb"))
    lists = lists.select(F.col("__qk").alias("__l_k"), "__nb").join(
        points.select(F.col("__qk").alias("__l_k"), *[F.col(c).alias(f"__l_{c}") for c in at]), "__l_k")
    same = F.lit(True)
    for c in at:
        same = same & F.col(c).eqNullSafe(F.col(f"__l_{c}"))
    arrays = q.join(lists, same)
    if exclude_self:
        others = F.filter("__nb", lambda n: F.coalesce(n["__tk"] != F.col("__qk"), F.lit(True)))
        arrays = arrays.withColumn("__nb", F.slice(others, 1, k))
    arrays = arrays.select(*split, "__qk", "__nb")
    if q.groupBy(*split, "__qk").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return arrays
    # queries of one key are answered together
    return arrays.groupBy(*split, "__qk").agg(first("__nb", k).alias("__nb"))


def knn_vote(neighbors: DataFrame, query_key: str = "entity_id", split=None, k: int | None = None,
             positive=True) -> DataFrame:
    """H1, H2: majority vote (ties to the lower class) and the share of
    neighbours in the ``positive`` class, per query."""
    split = [split] if isinstance(split, str) else list(split or [])
    nb = neighbors if k is None else neighbors.where(F.col("rank") <= k)
    if isinstance(nb.schema["neighbor_label"].dataType, T.BooleanType) and positive is True:
        # two classes: one aggregate; a tie goes to False, the lower class
        pos = F.count(F.when(F.col("neighbor_label"), 1))
        return nb.groupBy(*split, query_key).agg(
            (2 * pos > F.count(F.lit(1))).alias("pred"), (pos / F.count(F.lit(1))).alias("proba"))
    per_class = nb.groupBy(*split, query_key, "neighbor_label").agg(F.count(F.lit(1)).alias("__n"))
    vote = per_class.groupBy(*split, query_key).agg(
        F.min_by("neighbor_label", F.struct((-F.col("__n")).alias("a"), F.col("neighbor_label").alias("b"))).alias("pred"),
        (F.sum(F.when(F.col("neighbor_label") == F.lit(positive), F.col("__n")).otherwise(0))
         / F.sum("__n")).alias("proba"))
    return vote


def knn_k_sweep(neighbors: DataFrame, ks: list[int], query_key: str = "entity_id", split=None) -> DataFrame:
    """Binary predictions for every k in ``ks`` from one neighbour list
    of depth ``max(ks)``: the positive count among the first k neighbours,
    read at each k.  A query with fewer neighbours than ``max(ks)`` raises, as a
    library does that is asked for more neighbours than there are rows.  With array-form neighbours (``as_arrays=True``) this is
    pure per-row array arithmetic - no window, no sort."""
    split = [split] if isinstance(split, str) else list(split or [])
    few = F.raise_error(F.concat(F.lit("fewer neighbours than k = "), F.lit(str(max(ks)))))
    if "neighbors" in neighbors.columns:
        # the places of the positive ones; a projection of their own, so that they are listed once and not for every k
        places = F.filter(F.transform("neighbors", lambda n, i: F.when(n["neighbor_label"].cast("int") == 1, i + 1)), lambda p: p.isNotNull())
        places = neighbors.select(*split, query_key, F.when(F.size("neighbors") >= max(ks), places).otherwise(few).alias("__places"))
        among = lambda k: F.size(F.filter("__places", lambda p: p <= k))
        per_k = F.array(*[F.struct(F.lit(k).alias("k"), among(k).alias("pos")) for k in ks])
        return (places.select(*split, query_key, F.inline(per_k))
                .select(*split, query_key, F.col("k").cast("int").alias("k"), (2 * F.col("pos") > F.col("k")).alias("pred"),
                        (F.col("pos") / F.col("k")).alias("proba")))
    over = Window.partitionBy(*split, query_key)
    cum = neighbors.withColumn("__pos", F.sum(F.col("neighbor_label").cast("int")).over(
        over.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)))
    cum = cum.withColumn("__depth", F.max("rank").over(over))
    at_k = cum.where(F.col("rank").isin(list(ks)))
    k = F.when(F.col("__depth") >= max(ks), F.col("rank")).otherwise(few)
    return at_k.select(*split, query_key, k.alias("k"), (2 * F.col("__pos") > F.col("rank")).alias("pred"),
                       (F.col("__pos") / F.col("rank")).alias("proba"))


class KnnModel:
    """A fitted kNN classifier: the training rows and the scaling weights."""

    def __init__(self, train: DataFrame, features, k: int = 5, key: str = "entity_id",
                 label: str = "label", weights=None, split=None):
        self.train, self.features, self.k = train, features, k
        self.key, self.label, self.weights, self.split = key, label, weights, split

    def neighbors(self, query: DataFrame, query_key: str | None = None, **kw) -> DataFrame:
        return knn_neighbors(self.train, query, self.features, self.k, key=self.key, label=self.label,
                             query_key=query_key, split=self.split, weights=self.weights, **kw)

    def transform(self, query: DataFrame, query_key: str | None = None, **kw) -> DataFrame:
        """Query rows with ``pred`` and ``proba`` appended."""
        qk = query_key or self.key
        split = [self.split] if isinstance(self.split, str) else list(self.split or [])
        votes = knn_vote(self.neighbors(query, qk, **kw), qk, split)
        return query.join(votes, [*split, qk], "left")


def scaling_weights(df: DataFrame, cols: list[str]) -> list[float]:
    """``1 / std_pop^2`` per column (1 for a constant column), so weighted
    distance on raw values equals distance on standardised values."""
    row = df.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return [1.0 / (row[c] * row[c]) if row[c] else 1.0 for c in cols]
