"""Queries for sources/sinks (A) and evaluation of fixed predictions (I)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarelab.plans.catalog import register, rounded, with_ctes
from rarelab.sources import fixtures as fx
from rarelab.session import ensure_checkpoint_dir
from rarelab.sources.tables import read_table

COHORT_SQL = "CASE WHEN generation <= 6 THEN 'train' ELSE CAST(generation AS VARCHAR) END"


def _cohort():
    return F.when(F.col("generation") <= 6, F.lit("train")).otherwise(F.col("generation").cast("string"))


def _preds(spark, sf_dir):
    return fx.fixed_predictions(spark, sf_dir).withColumn("cohort", _cohort())


PRED_CTE = f"preds AS (SELECT *, {COHORT_SQL} AS cohort FROM fixed_predictions)"


def _scratch(spark, name):
    """A fresh folder under the session's checkpoint directory - shared
    storage on a cluster, never a machine-local temp folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------- A1, A4
ENTITY_CSV_SCHEMA = T.StructType([
    T.StructField("entity_id", T.LongType()),
    T.StructField("category_1", T.StringType()),
    T.StructField("category_2", T.StringType()),
    T.StructField("generation", T.IntegerType()),
    T.StructField("n_orders", T.LongType()),
    T.StructField("wins", T.LongType()),
    T.StructField("label", T.BooleanType()),
])


@register("csv_roundtrip", with_ctes(fx.ENTITY_SQL, body="""
SELECT entity_id, category_1, category_2, generation, n_orders, wins, label FROM entity_features"""))
def q_csv_roundtrip(spark, sf_dir):
    from rarelab.sources.csv import read_csv, write_csv
    path = _scratch(spark, "entity_csv")
    write_csv(fx.entity_features(spark, sf_dir).select(*ENTITY_CSV_SCHEMA.fieldNames()), path)
    return read_csv(spark, path, ENTITY_CSV_SCHEMA)


@register("csv_rejected", """
SELECT o_orderkey, o_totalprice, FALSE AS rejected FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' UNION ALL
SELECT o_orderkey, NULL, TRUE FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'""")
def q_csv_rejected(spark, sf_dir):
    """A1 over an export with bad lines: orders of one status without a number for a price, those of one priority
    with a field too many.  Rows and rejected lines, told apart by the reader."""
    from rarelab.sources.csv import read_csv_apart
    path = _scratch(spark, "mixed_csv")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    price = F.when(F.col("o_orderstatus") == "P", F.lit("unknown")).otherwise(F.col("o_totalprice").cast("string"))
    more = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(",late")).otherwise(F.lit(""))
    line = F.concat(F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", price), more)
    o.select(line.alias("value")).write.mode("overwrite").text(path)
    rows, rejected = read_csv_apart(spark, path, T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType())]), header=False)
    lost = rejected.select(F.split("line", ",")[0].cast("bigint").alias("o_orderkey"), F.lit(None).cast("double").alias("o_totalprice"),
                           F.lit(True).alias("rejected"))
    return rounded(rows.select("o_orderkey", "o_totalprice", F.lit(False).alias("rejected")).unionByName(lost))


# ------------------------------------------------------------------ A2
@register("saved_index_csv", with_ctes(fx.ENTITY_SQL, body="""
SELECT entity_id, generation, n_orders, label FROM entity_features"""))
def q_saved_index_csv(spark, sf_dir):
    from rarelab.sources.csv import read_csv_saved_index, write_csv
    path = _scratch(spark, "indexed_csv")
    ef = fx.entity_features(spark, sf_dir)
    # the saved file leads with an unnamed index column, as a pandas export does
    write_csv(ef.select(F.col("entity_id").alias("_c0"), "generation", "n_orders", "label"), path)
    schema = T.StructType([T.StructField("_c0", T.LongType()), T.StructField("generation", T.IntegerType()),
                           T.StructField("n_orders", T.LongType()), T.StructField("label", T.BooleanType())])
    return read_csv_saved_index(spark, path, schema, index_name="entity_id")


# ------------------------------------------------------------------ A3
@register("dense_key", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_key FROM orders""")
def q_dense_key(spark, sf_dir):
    from rarelab.sources.keys import dense_key
    c = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    return dense_key(c, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_key")


# -------------------------------------------------------------- I1, I2
@register("accuracy_error", with_ctes(fx.FIXED_PREDICTIONS_SQL, PRED_CTE, body="""
SELECT cohort, round(avg(CAST(label = pred AS DOUBLE)), 6) AS accuracy, count(*) AS n,
       round(1 - avg(CAST(label = pred AS DOUBLE)), 6) AS error
FROM preds GROUP BY cohort"""))
def q_accuracy_error(spark, sf_dir):
    from rarelab.operators.metrics import accuracy
    return rounded(accuracy(_preds(spark, sf_dir), by="cohort"))


# ------------------------------------------------------------------ I6
CM_SQL = """
cm AS (SELECT cohort, label AS actual, pred AS predicted, count(*) AS count FROM preds GROUP BY ALL),
cls AS (SELECT DISTINCT cohort, c FROM (SELECT cohort, actual AS c FROM cm UNION ALL SELECT cohort, predicted FROM cm)),
grid AS (SELECT a.cohort, a.c AS actual, b.c AS predicted FROM cls a JOIN cls b ON a.cohort = b.cohort),
cells AS (SELECT g.cohort, g.actual, g.predicted, coalesce(cm.count, 0) AS count FROM grid g
          LEFT JOIN cm ON g.cohort = cm.cohort AND g.actual = cm.actual AND g.predicted = cm.predicted)"""

PER_CLASS_SQL = CM_SQL + """,
t AS (SELECT cohort, actual AS cls, sum(count) AS support,
             sum(CASE WHEN actual = predicted THEN count ELSE 0 END) AS tp FROM cells GROUP BY ALL),
p AS (SELECT cohort, predicted AS cls, sum(count) AS n_predicted FROM cells GROUP BY ALL),
pc AS (SELECT t.cohort, t.cls, tp, support, n_predicted,
              coalesce(tp / nullif(n_predicted, 0), 0.0) AS precision,
              coalesce(tp / nullif(support, 0), 0.0) AS recall,
              coalesce(2.0 * tp / nullif(support + n_predicted, 0), 0.0) AS f1
       FROM t JOIN p ON t.cohort = p.cohort AND t.cls = p.cls)"""


@register("confusion_matrix", with_ctes(fx.FIXED_PREDICTIONS_SQL, PRED_CTE, CM_SQL, body="SELECT * FROM cells"))
def q_confusion_matrix(spark, sf_dir):
    from rarelab.operators.metrics import confusion_counts
    return confusion_counts(_preds(spark, sf_dir), by="cohort")


# -------------------------------------------------------------- I3-I5
@register("weighted_prf", with_ctes(fx.FIXED_PREDICTIONS_SQL, PRED_CTE, PER_CLASS_SQL, body="""
SELECT cohort, round(sum(support * precision) / sum(support), 6) AS precision,
       round(sum(support * recall) / sum(support), 6) AS recall,
       round(sum(support * f1) / sum(support), 6) AS f1
FROM pc GROUP BY cohort"""))
def q_weighted_prf(spark, sf_dir):
    from rarelab.operators.metrics import weighted_prf
    return rounded(weighted_prf(_preds(spark, sf_dir), by="cohort"))


# ------------------------------------------------------------------ I7
@register("classification_report", with_ctes(fx.FIXED_PREDICTIONS_SQL, PRED_CTE, PER_CLASS_SQL, body="""
SELECT cohort, CAST(cls AS VARCHAR) AS "row", round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pc
UNION ALL
SELECT cohort, 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pc GROUP BY cohort
UNION ALL
SELECT cohort, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM pc GROUP BY cohort
UNION ALL
SELECT cohort, 'weighted avg', round(sum(support * precision) / sum(support), 6),
       round(sum(support * recall) / sum(support), 6), round(sum(support * f1) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM pc GROUP BY cohort"""))
def q_classification_report(spark, sf_dir):
    from rarelab.operators.metrics import classification_report
    return rounded(classification_report(_preds(spark, sf_dir), by="cohort"))


# ------------------------------------------------------------------ I8
AUC_SQL = """
ps AS (SELECT cohort, score, count(*) FILTER (WHERE label) AS pos, count(*) FILTER (WHERE NOT label) AS neg
       FROM preds WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY cohort, score),
cum AS (SELECT *, sum(neg) OVER (PARTITION BY cohort ORDER BY score ROWS UNBOUNDED PRECEDING) - neg AS neg_below FROM ps)"""


@register("roc_auc", with_ctes(fx.FIXED_PREDICTIONS_SQL, PRED_CTE, AUC_SQL, body="""
SELECT cohort, round(sum(pos * (neg_below + 0.5 * neg)) / nullif(sum(pos) * sum(neg), 0), 6) AS roc_auc
FROM cum GROUP BY cohort"""))
def q_roc_auc(spark, sf_dir):
    from rarelab.operators.metrics import roc_auc
    return rounded(roc_auc(_preds(spark, sf_dir), by="cohort"))


# ----------------------------------------------------------------- I13
@register("model_agreement", with_ctes(fx.FIXED_PREDICTIONS_SQL, PRED_CTE, body="""
SELECT cohort, pred AS pred_a, n_orders_rule AS pred_b, count(*) AS count FROM
  (SELECT cohort, entity_id, pred, score >= 14 AS n_orders_rule FROM preds) GROUP BY ALL"""))
def q_model_agreement(spark, sf_dir):
    from rarelab.operators.metrics import agreement
    p = _preds(spark, sf_dir)
    other = p.select("cohort", "entity_id", (F.col("score") >= 14).alias("pred"))
    return agreement(p, other, "entity_id", by="cohort")
