"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key whose rate is its quality weight.
Within a source the documents with the smallest keys come first; prefix sums of
their sizes fill the source's budget.  Budgets above the source's size take
complete epochs first, and only the rest is drawn by key.  The prefix sums run
over range partitions of (source, key), so a source with a third of all rows is
spread over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rarelab.functions.hashing import sql_uniform, uniform
from rarelab.llm.common import SPACE_CLASS
from rarelab.operators.ordered import dense_position, running_sum
from rarelab.session import cut_lineage

SEED = "mix"
WORD = SPACE_CLASS.replace("[", "[^") + "+"
#: Weight of a document by its quality label: good, unlabelled, poor.
QUALITY_WEIGHTS = (2.0, 1.0, 0.5)


def quality_weight(quality: Column) -> Column:
    good, unknown, poor = QUALITY_WEIGHTS
    return F.when(quality == 1, F.lit(good)).when(quality == 0, F.lit(poor)).otherwise(F.lit(unknown))


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sizes``: one row per source (``source, source_size``; a null source is one).
    Adds ``weight`` and ``target``.

    Sources in code point order, null last, weigh ``weights`` in turn and
    share ``share`` times the total size; a target stops at ``cap`` times its
    source's size, and the excess is shared anew by weight among the others
    until none is above.  ``share`` may not exceed ``cap``."""
    if not 0 <= share <= cap:
        raise ValueError("share must lie between 0 and cap, or no targets reach the total")
    ranked = dense_position(sizes, [F.col("source").isNull(), F.coalesce("source", F.lit(""))], "__rank")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("__rank") % len(weights)).cast("int") + 1)
    table = cut_lineage(ranked.select("source", "source_size", turn.alias("weight")))
    limit = F.lit(float(cap)) * F.col("source_size")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    rate = 0.0
    while True:  # every pass caps at least one more source, or ends
        above = limit <= F.lit(rate) * F.col("weight")
        got = table.agg(F.sum(F.when(above, limit)).alias("capped"), F.sum(F.when(~above, F.col("weight"))).alias("free"),
                        ).first()
        if not got["free"]:
            break
        new = (share * total - (got["capped"] or 0.0)) / got["free"]
        if new <= rate:
            break
        rate = new
    return table.withColumn("target", F.least(limit, F.lit(rate) * F.col("weight")))


def mix(docs: DataFrame, quality: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: str = SEED) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, epochs, before, rest, taken``.

    ``size`` counts the words of the text (null: 0).  ``quality`` has columns
    ``doc_id, quality`` (1 good, 0 poor); of several labels the highest
    counts, and documents without one weigh 1.  ``taken`` words = complete
    epochs, then of the first documents by key as many words as the rest of
    the target holds; the document at the edge is taken in part, so a source's
    taken words are its target rounded down.  The keys depend on seed and id
    alone: reruns agree.  Equal keys (repeated ids) are ordered by size; rows
    equal in both are interchangeable.  A null source is a source of its own.
    Sources with no words have target 0.  An empty table gives an empty result."""
    sized = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))
    if quality is None:
        weighed = sized.withColumn("w", F.lit(QUALITY_WEIGHTS[1]))
    else:
        known = quality.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").alias("__q"))
        weighed = sized.join(known, "doc_id", "left").withColumn("w", quality_weight(F.col("__q"))).drop("__q")
    keyed = cut_lineage(weighed.select("doc_id", "source", "size",
                                       (-F.log(F.lit(1.0) - uniform(seed, "doc_id")) / F.col("w")).alias("key")))
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, cap).select(
        F.col("source").alias("__s"), "source_size", "target")
    summed = running_sum(keyed, ["source"], ["key", "doc_id", "size"], ["size"], materialize=False)
    out = summed.join(targets, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target") - F.col("epochs") * F.col("source_size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return (out.withColumn("epochs", epochs.cast("bigint")).withColumn("rest", rest.cast("bigint"))
            .withColumn("before", F.col("cum_size") - F.col("size"))
            .withColumn("taken", (F.col("epochs") * F.col("size") + part).cast("bigint"))
            .select("doc_id", "source", "size", "source_size", "target", "epochs", "before", "rest", "taken"))


def mixed_rows(docs: DataFrame, quality: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source",
               text_col: str = "text", **options) -> DataFrame:
    """The mix as rows of ``docs``: a document stands once for each complete
    epoch, and once more where the middle of it lies within the rest of its
    source's target, so whole documents come nearest to the target.  Documents
    without words cost nothing and stand once for each epoch, once at least.
    Of rows that repeat id, source and size, each is drawn by itself."""
    drawn = mix(docs, quality, id_col, source_col, text_col, **options)
    once = (F.col("before") * 2 + F.col("size") <= F.col("rest") * 2).cast("int")
    copies = F.when(F.col("size") > 0, F.col("epochs") + once).otherwise(F.greatest(F.col("epochs"), F.lit(1)))
    counts = (drawn.groupBy("doc_id", "source", "size")
              .agg(F.max(copies.cast("int")).alias("copies"), F.min(copies.cast("int")).alias("fewest"),
                   F.sum(copies.cast("int")).alias("all"), F.count(F.lit(1)).alias("n")).where("copies > 0"))
    counts = cut_lineage(counts.withColumnsRenamed({"doc_id": "d", "source": "s", "size": "z"}))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("id"),
                       F.col(source_col).cast("string").alias("from"),
                       F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("words"))
    same = (F.col("id").eqNullSafe(F.col("d")) & F.col("from").eqNullSafe(F.col("s")) & (F.col("words") == F.col("z")))
    out = rows.join(counts.where("fewest = copies"), same).select("row", "copies")
    uneven = counts.where("fewest < copies")
    if not uneven.isEmpty():  # as many of the repeated rows as the mix took once more, by the hash of the text
        turn = F.row_number().over(Window.partitionBy("d", "s", "z").orderBy(F.xxhash64(F.col("row").getField(text_col))))
        more = (turn <= F.col("all") - F.col("n") * F.col("fewest")).cast("int")
        out = out.unionAll(rows.join(uneven, same).select("row", (F.col("fewest") + more).alias("copies")).where("copies > 0"))
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def sql_mix(documents: str = "documents", labels: str = "labels", weights=(5, 2, 1), share: float = 1.5,
            cap: float = 2.0, seed: str = SEED) -> str:
    """DuckDB SQL of :func:`mix`: the targets in closed form (sources sorted by
    cap over weight; the first one whose cap the common rate does not reach
    fixes the rate)."""
    good, unknown, poor = QUALITY_WEIGHTS
    turns = "[" + ", ".join(f"CAST({w} AS DOUBLE)" for w in weights) + "]"
    return f"""
WITH q AS (SELECT doc_id, max(quality) AS quality FROM {labels} GROUP BY doc_id),
s AS (
  SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '{WORD}')), 0) AS size,
         -ln(1 - {sql_uniform(seed, 'd.doc_id')}) / CASE q.quality WHEN 1 THEN {good} WHEN 0 THEN {poor} ELSE {unknown} END
           AS key
  FROM {documents} d LEFT JOIN q ON d.doc_id = q.doc_id),
z AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
r AS (SELECT *, {turns}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1] AS w FROM z),
c AS (
  SELECT *, (SELECT sum(source_size) FROM z) * {share} AS total,
         coalesce(sum({cap} * source_size) OVER (ORDER BY {cap} * source_size / w, source
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(w) OVER (ORDER BY {cap} * source_size / w, source
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM r),
rate AS (SELECT max((total - capped) / free) AS rate FROM c),
t AS (SELECT source, source_size, least({cap} * source_size, rate * w) AS target FROM r, rate),
p AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target - epochs * source_size) - before)))::BIGINT AS taken
FROM p"""
