"""Study fixtures derived from the driver's tables (see FIXTURES.md).

``entity_features`` stands for the reference's joined entity table: one row per
customer with categorical columns, numeric stats, a win count from a filtered
fact table (left join, absent -> 0) and a rare boolean label (spend at or above
its 92nd percentile).  Each builder has a DuckDB twin in SQL text used by the
oracle of every registered query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rarelab.functions.quantile import exact_percentile
from rarelab.session import cut_lineage
from rarelab.sources.tables import read_table, table_path

# Fixed values of the fixture definition.
WIN_STATUS = "P"
WIN_FROM = "1997-01-01 00:00:00"
WIN_UNTIL = "1998-01-01 00:00:00"
LABEL_QUANTILE = 0.92
N_GENERATIONS = 8
TRAIN_GENERATIONS = (1, 2, 3, 4, 5, 6)
COHORT_GENERATIONS = (7, 8)

NUMERIC_STATS = ("c_acctbal", "n_orders", "quantity", "n_lines", "wins")
TOTAL = "n_orders"
CATEGORICAL = ("category_1", "category_2")


def contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with status P dated in 1997 (the 'contest' fact table)."""
    o = read_table(spark, sf_dir, "orders",
                   "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    return (
        o.where((F.col("o_orderstatus") == WIN_STATUS)
                & (F.col("o_orderdate") >= F.expr(f"TIMESTAMP_NTZ '{WIN_FROM}'"))
                & (F.col("o_orderdate") < F.expr(f"TIMESTAMP_NTZ '{WIN_UNTIL}'")))
        .select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    )


def win_counts(contest_df: DataFrame, key: str = "o_custkey") -> DataFrame:
    """Per winner: number of wins and the priority of the latest win.

    A hot winner is harmless: count and max_by aggregate partially map-side,
    so each map task ships one row per winner."""
    return contest_df.groupBy(key).agg(
        F.count(F.lit(1)).alias("wins"),
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("category_2"),
    )


def entity_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 without the label."""
    cust = read_table(spark, sf_dir, "customer",
                      "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    # aggregate lines per order before the join: the join input shrinks to one row per order
    lines = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("nl"))
    per_cust = (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"),
             F.round(F.sum("o_totalprice"), 2).alias("spend"),
             F.sum("q").alias("quantity"),
             F.sum("nl").alias("n_lines"))
    )
    wins = win_counts(contests(spark, sf_dir)).withColumnRenamed("o_custkey", "w_custkey")
    j = (cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
         .join(wins, cust.c_custkey == wins.w_custkey, "left"))
    return j.select(
        F.col("c_custkey").alias("entity_id"),
        F.col("c_mktsegment").alias("category_1"),
        F.col("category_2"),
        ((F.col("c_nationkey") % N_GENERATIONS) + 1).cast("int").alias("generation"),
        F.col("c_acctbal"),
        F.coalesce(F.col("n_orders"), F.lit(0).cast("bigint")).alias("n_orders"),
        # no orders: nothing spent (keeps the label defined for every entity)
        F.coalesce(F.col("spend"), F.lit(0.0)).alias("spend"),
        F.coalesce(F.col("quantity"), F.lit(0.0)).alias("quantity"),
        F.coalesce(F.col("n_lines"), F.lit(0).cast("bigint")).alias("n_lines"),
        F.coalesce(F.col("wins"), F.lit(0).cast("bigint")).alias("wins"),
    )


_ENTITY_TABLES: dict = {}


def source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Number, size and latest change of each source table's files (their contents are not read)."""
    out = [sf_dir.rstrip("/")]
    for table in ("customer", "orders", "lineitem"):
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table_path(sf_dir, table))
                 .agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime").cast("string")))
        out.append(tuple(files.first()))
    return tuple(out)


def entity_features(spark: SparkSession, sf_dir: str,
                    label_quantile: float = LABEL_QUANTILE) -> DataFrame:
    """``entity_base`` plus ``label = spend >= percentile(spend, q)``.

    Built once per session and state of the source files and checkpointed
    (the study reads its joined entity table many times, as the reference
    re-reads its saved joined CSV); the checkpoint lives in the session's
    checkpoint directory, shared storage on a cluster."""
    key = (spark.conf.get("spark.app.id", None) or id(spark), source_state(spark, sf_dir), label_quantile)
    if key not in _ENTITY_TABLES:
        base = cut_lineage(entity_base(spark, sf_dir))
        cut = exact_percentile(base, "spend", label_quantile)
        _ENTITY_TABLES[key] = base.withColumn("label", F.col("spend") >= F.lit(cut))
    return _ENTITY_TABLES[key]


def fixed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 with a heavily tied score and a threshold prediction."""
    ef = entity_features(spark, sf_dir)
    return ef.select(
        "entity_id", "generation", "label",
        F.col("n_orders").cast("double").alias("score"),
        (F.col("n_orders") >= 15).alias("pred"),
    )


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents left join labels (nullable quality / toxic)."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "n_chars", "lang", "source")
    lab = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic").withColumnRenamed("doc_id", "l_doc_id")
    return (d.join(lab, d.doc_id == lab.l_doc_id, "left")
            .select("doc_id", "n_chars", "lang", "source", "quality", "toxic"))


# ---------------------------------------------------------------------------
# DuckDB twins (SQL text for oracles).  Views: the driver's table names.

CONTESTS_SQL = f"""
contests AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate FROM orders
  WHERE o_orderstatus = '{WIN_STATUS}'
    AND o_orderdate >= TIMESTAMP '{WIN_FROM}' AND o_orderdate < TIMESTAMP '{WIN_UNTIL}'
)"""

ENTITY_SQL = CONTESTS_SQL + f""",
line_agg AS (
  SELECT l_orderkey, sum(l_quantity) AS q, count(*) AS nl FROM lineitem GROUP BY l_orderkey
),
order_agg AS (
  SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spend,
         sum(q) AS quantity, CAST(sum(nl) AS BIGINT) AS n_lines
  FROM orders LEFT JOIN line_agg ON o_orderkey = l_orderkey GROUP BY o_custkey
),
win_agg AS (
  SELECT o_custkey AS w_custkey, count(*) AS wins,
         first(o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS category_2
  FROM contests GROUP BY o_custkey
),
entity_base AS (
  SELECT c_custkey AS entity_id, c_mktsegment AS category_1, category_2,
         CAST(c_nationkey % {N_GENERATIONS} + 1 AS INTEGER) AS generation, c_acctbal,
         coalesce(n_orders, 0) AS n_orders, coalesce(spend, 0.0) AS spend, coalesce(quantity, 0.0) AS quantity,
         coalesce(n_lines, 0) AS n_lines, coalesce(wins, 0) AS wins
  FROM customer LEFT JOIN order_agg ON c_custkey = o_custkey
  LEFT JOIN win_agg ON c_custkey = w_custkey
),
entity_features AS (
  SELECT *, spend >= (SELECT quantile_cont(spend, {LABEL_QUANTILE}) FROM entity_base) AS label
  FROM entity_base
)"""

FIXED_PREDICTIONS_SQL = ENTITY_SQL + """,
fixed_predictions AS (
  SELECT entity_id, generation, label, CAST(n_orders AS DOUBLE) AS score, n_orders >= 15 AS pred
  FROM entity_features
)"""

DOC_LABELS_SQL = """
doc_labels AS (
  SELECT d.doc_id, d.n_chars, d.lang, d.source, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""
