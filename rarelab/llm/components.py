"""Connected components by contraction, as joins and aggregates.

Each round gives every vertex a pseudo-random priority, maps it to the
neighbour (or itself) of the lowest priority, and renames the edges by that
map; edges inside a merged set disappear.  Local minima alone survive a round,
so the graph shrinks by a constant factor on average, chains included.  When no
edge is left, the maps are composed backwards and every set is labelled with
its smallest id.  Minima are aggregated before they are shuffled, so a hub with
a third of all edges costs no task more than its partial sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelab.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: columns ``a``, ``b`` (of one orderable type, no nulls), in either direction,
    repeats and loops allowed.  Returns ``id, component`` for every vertex that
    has an edge to another one; ``component`` is the smallest id reachable.
    No edges give no rows."""
    live = cut_lineage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                       .distinct())
    maps, seed = [], 0
    while not live.isEmpty():
        seed += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(seed), F.col(c)).alias("p"), F.col(c).alias("v"))  # noqa: B023, E731
        both = live.select("a", rank("b").alias("to")).unionAll(live.select(F.col("b").alias("a"), rank("a").alias("to")))
        best = both.groupBy("a").agg(F.min("to").alias("to"))
        step = cut_lineage(best.select(F.col("a").alias("id"), F.least(F.col("to"), rank("a"))["v"].alias("root")))
        maps.append(step)
        left = step.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        right = step.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        live = cut_lineage(live.join(left, "a").join(right, "b").where("ra <> rb")
                           .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    if not maps:
        return live.select(F.col("a").alias("id"), F.col("b").alias("component"))
    label = maps[-1]
    for step in reversed(maps[:-1]):
        up = label.select(F.col("id").alias("root"), F.col("root").alias("top"))
        label = step.join(up, "root", "left").select("id", F.coalesce("top", "root").alias("root"))
    label = cut_lineage(label)
    smallest = cut_lineage(label.groupBy("root").agg(F.min("id").alias("component")))
    return label.join(smallest, "root").select("id", "component")
