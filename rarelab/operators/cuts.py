"""Exact cuts in hash order: the first ``take`` rows of a group in (md5, key) order.

A hash is uniform, so the place of the cut is known beforehand but for a few
standard deviations.  One pass counts the rows below that bracket and lists
those inside it - about ``12 * sqrt(n)`` rows - and the cut is read off the
list.  The bracket is verified: where the count says that the cut lies
outside (keys that repeat, say), it is widened and the pass repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rarelab.functions.hashing import HEX_DIGITS, TWO_52
from rarelab.session import cut_lineage

DEVIATIONS = 6.0


def _leading(h: Column) -> Column:
    """The hash's leading 52 bits as a number in [0, 1), as :func:`rarelab.functions.hashing.uniform`."""
    return F.conv(F.substring(h, 1, HEX_DIGITS), 16, 10).cast("double") / F.lit(TWO_52)


def _listed_within(rows: DataFrame, within: list[str], group: list[str], bracket: DataFrame) -> DataFrame:
    """The rows inside the groups' brackets, and one row with the count of those below, where groups share the rows
    of their ``within`` columns: a row is compared with the few brackets and copied only for those it is in."""
    b = bracket.select(*[F.col(f"__w_{g}").alias(g) for g in group], "__lo", "__hi", "__take")
    extra = [g for g in group if g not in within]
    table = b.groupBy(*within).agg(F.collect_list(F.struct(*extra, "__lo", "__hi", "__take")).alias("__all"))
    on = lambda df, other: _joined(df, other, within)
    u = F.col("__u")
    # few rows of a caller's own groups; rows meet them where they lie, not in a task per group
    placed = on(rows, F.broadcast(table)).withColumn("__u", _leading(F.col("__h")))
    holding = F.filter("__all", lambda c: (u >= c["__lo"]) & (u < c["__hi"]))
    # the brackets that begin at or before the row number the stretch between two beginnings that it is in
    begun = F.size(F.filter("__all", lambda c: u >= c["__lo"]))
    placed = placed.select(*within, "__h", "__k", begun.alias("__begun"), F.exists(holding, lambda c: F.lit(True)).alias("__in"))
    counts = cut_lineage(placed.groupBy(*within, "__begun", F.when(F.col("__in"), F.col("__h")).alias("__cut_h"),
                                        F.when(F.col("__in"), F.col("__k")).alias("__cut_k"), "__in").agg(F.count(F.lit(1)).alias("c")))
    at = on(counts.where("__in").drop("__in", "__begun"), table).withColumn("__u", _leading(F.col("__cut_h")))
    inside = at.select(*within, "__cut_h", "__cut_k", "c", F.explode(holding).alias("__one")).select(
        *within, *[F.col("__one")[e].alias(e) for e in extra], F.col("__one")["__take"].alias("__take"), "__cut_h", "__cut_k", "c")
    stretches = counts.groupBy(*within, "__begun").agg(F.sum("c").alias("c"))
    before = table.select(*within, F.explode(F.transform("__all", lambda a: F.struct(
        a.alias("one"), F.size(F.filter("__all", lambda o: o["__lo"] < a["__lo"])).alias("earlier")))).alias("__b"))
    below = on(stretches, before).where(F.col("__begun") <= F.col("__b.earlier")).groupBy(
        *within, *[F.col("__b.one")[e].alias(e) for e in extra], F.col("__b.one")["__take"].alias("__take")).agg(F.sum("c").alias("c"))
    kinds = inside.schema
    below = below.select(*group, "__take", *[F.lit(None).cast(kinds[x].dataType).alias(x) for x in ("__cut_h", "__cut_k")], "c")
    return inside.select(*group, "__take", "__cut_h", "__cut_k", "c").unionByName(below)


def _joined(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """An inner join by columns that may be null."""
    right = other.withColumnsRenamed({c: f"__r_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return df.join(right, same).drop(*[f"__r_{c}" for c in on])


def hash_cuts(rows: DataFrame, group: list[str], want: DataFrame, within: list[str] | None = None) -> DataFrame:
    """``(group..., __cut_h, __cut_k)``: of every group the ``take``-th row in (``__h``, ``__k``) order; a row
    is among the first ``take`` where it does not come after it (:func:`before_cut`).

    ``rows``: ``(group..., __h, __k)`` with an md5 in hex and a key, ``want``: ``(group..., n, take)``, a row per
    group (a single row without group columns), ``n`` its rows and ``take`` at most that.  Groups that take
    nothing have no cut.  With ``within``, some of the group columns, ``rows`` is ``(within..., __h, __k)`` and
    stands for all groups of these columns."""
    want = cut_lineage(want.where("take > 0"))
    found, width = None, DEVIATIONS
    while True:
        p = F.col("take") / F.col("n")
        half = F.lit(width) * (F.sqrt(F.col("n") * p * (F.lit(1.0) - p)) + F.lit(1.0)) / F.col("n")
        bracket = want.select(*[F.col(g).alias(f"__w_{g}") for g in group], (p - half).alias("__lo"), (p + half).alias("__hi"),
                              F.col("take").alias("__take"))
        same = F.lit(True)
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"__w_{g}"))
        shared = within is not None and set(within) != set(group)
        if shared:
            j = None
        elif group:
            j = rows.join(bracket, same)
        else:
            one = bracket.first()
            if one is None:
                return rows.limit(0).select(F.col("__h").alias("__cut_h"), F.col("__k").alias("__cut_k"))
            j = rows.withColumns({c: F.lit(one[c]) for c in bracket.columns})
        u = _leading(F.col("__h"))
        inside = u >= F.col("__lo")
        # rows below the bracket are one row of a task here: null sorts before every hash
        listed = _listed_within(rows, within, group, bracket) if shared else j.where(u < F.col("__hi")).groupBy(*group, "__take", F.when(inside, F.col("__h")).alias("__cut_h"),
                                                    F.when(inside, F.col("__k")).alias("__cut_k")).agg(F.count(F.lit(1)).alias("c"))
        order = Window.partitionBy(*group).orderBy(F.col("__cut_h").asc_nulls_first(), "__cut_k")
        place = listed.withColumn("upto", F.sum("c").over(order))
        cuts = place.where((F.col("upto") >= F.col("__take")) & (F.col("upto") - F.col("c") < F.col("__take"))
                           & F.col("__cut_h").isNotNull()).select(*group, "__cut_h", "__cut_k")
        found = cut_lineage(cuts if found is None else found.unionByName(cuts))
        have = found.select(*[F.col(g).alias(f"__w_{g}") for g in group], F.lit(1).alias("__have"))
        if group:
            missing = want.join(have, same, "left_anti")
        else:
            missing = want.limit(0) if not found.isEmpty() else want
        missing = cut_lineage(missing)
        if missing.isEmpty():
            return found
        want, width = missing, width * 16


def before_cut(h: Column, key: Column, cut_h: Column, cut_key: Column) -> Column:
    """Whether a row is among the first of its group; false without a cut."""
    return F.coalesce((h < cut_h) | ((h == cut_h) & (key <= cut_key)), F.lit(False))
