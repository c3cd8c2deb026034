"""Queries for sources, joins, projections and profiling (A-E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rarelab.plans.catalog import register, rounded, with_ctes
from rarelab.sources import fixtures as fx
from rarelab.sources.tables import read_table

# ---------------------------------------------------------------- C2 / E1 / B7
WIN_COUNTS_SQL = with_ctes(fx.CONTESTS_SQL, """
win_agg AS (SELECT o_custkey, count(*) AS n FROM contests GROUP BY o_custkey)""", body="""
SELECT c_custkey AS entity_id, c_name AS name, coalesce(n, 0) AS wins
FROM customer LEFT JOIN win_agg ON c_custkey = o_custkey
ORDER BY wins DESC, entity_id""")


@register("win_counts", WIN_COUNTS_SQL)
def q_win_counts(spark, sf_dir):
    from rarelab.operators.features import left_join_counts
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name").withColumnsRenamed(
        {"c_custkey": "entity_id", "c_name": "name"})
    return (left_join_counts(cust, fx.contests(spark, sf_dir), "entity_id", "o_custkey", "wins")
            .orderBy(F.desc("wins"), "entity_id"))


# ------------------------------------------------------------ fixture profile
ENTITY_PROFILE_SQL = with_ctes(fx.ENTITY_SQL, body="""
SELECT CASE WHEN generation <= 6 THEN 'train' ELSE CAST(generation AS VARCHAR) END AS cohort,
       count(*) AS n_rows, count(*) FILTER (WHERE label) AS positives,
       count(*) FILTER (WHERE wins = 0) AS zero_wins,
       count(*) FILTER (WHERE category_2 IS NULL) AS null_category_2,
       CAST(sum(wins) AS BIGINT) AS total_wins,
       round(corr(CAST(label AS DOUBLE), CAST(n_orders AS DOUBLE)), 6) AS corr_label_n_orders
FROM entity_features GROUP BY 1""")


@register("entity_profile", ENTITY_PROFILE_SQL)
def q_entity_profile(spark, sf_dir):
    ef = fx.entity_features(spark, sf_dir)
    cohort = F.when(F.col("generation") <= 6, F.lit("train")).otherwise(F.col("generation").cast("string"))
    return rounded(ef.groupBy(cohort.alias("cohort")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("label"), 1)).alias("positives"),
        F.count(F.when(F.col("wins") == 0, 1)).alias("zero_wins"),
        F.count(F.when(F.col("category_2").isNull(), 1)).alias("null_category_2"),
        F.sum("wins").alias("total_wins"),
        F.corr(F.col("label").cast("double"), F.col("n_orders").cast("double")).alias("corr_label_n_orders"),
    ))


# ============================================================ shared helpers
# The columns profiled and correlated (spend defines the label,
# so it is never a feature).  The key and the cohort are profiled, but no model sees them.
CORR_COLS = ["entity_id", "generation", "c_acctbal", "n_orders", "quantity", "n_lines", "wins", "label"]
MODEL_COLS = ["c_acctbal", "n_orders", "quantity", "n_lines", "wins", "label"]
FACET_FEATURES = ["n_orders", "wins", "c_acctbal", "quantity"]
CATEGORY_1_LEVELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
CATEGORY_2_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _train(ef):
    return ef.where(F.col("generation") <= max(fx.TRAIN_GENERATIONS))


def _ef_cte():
    return fx.ENTITY_SQL


def _train_cte():
    return f"train AS (SELECT * FROM entity_features WHERE generation <= {max(fx.TRAIN_GENERATIONS)})"


# ---------------------------------------------------------------------- C1
@register("contest_winner_lookup", """
SELECT o_orderkey, o_custkey AS winner, c_name AS winner_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def q_contest_winner_lookup(spark, sf_dir):
    from rarelab.operators.features import lookup
    c = read_table(spark, sf_dir, "orders", "o_orderkey", F.col("o_custkey").alias("winner"))
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    return lookup(c, cust, "winner", "c_custkey", {"c_name": "winner_name"})


# ---------------------------------------------------------------------- B5
@register("head_rows", with_ctes(_ef_cte(), body="""
SELECT entity_id, category_1, generation, n_orders, wins, label
FROM entity_features ORDER BY entity_id LIMIT 5"""))
def q_head_rows(spark, sf_dir):
    from rarelab.operators.features import head
    ef = fx.entity_features(spark, sf_dir).select(
        "entity_id", "category_1", "generation", "n_orders", "wins", "label")
    return head(ef, "entity_id", 5)


# ---------------------------------------------------------------------- D5
@register("join_reconciliation", with_ctes(_ef_cte(), body="""
SELECT n_facts, total_derived, n_facts = total_derived AS matches FROM
 (SELECT (SELECT count(*) FROM contests) AS n_facts,
         (SELECT CAST(sum(wins) AS BIGINT) FROM entity_features) AS total_derived)"""))
def q_join_reconciliation(spark, sf_dir):
    from rarelab.operators.profile import reconcile
    return reconcile(fx.contests(spark, sf_dir), fx.entity_features(spark, sf_dir), "wins")


# ---------------------------------------------------------------------- D3
@register("key_profile", """
SELECT 'o_orderkey' AS "column", min(o_orderkey) AS min_value, max(o_orderkey) AS max_value,
       count(o_orderkey) AS n_values, count(DISTINCT o_orderkey) AS n_distinct,
       count(o_orderkey) = count(DISTINCT o_orderkey) AS is_unique FROM orders
UNION ALL
SELECT 'o_custkey', min(o_custkey), max(o_custkey), count(o_custkey), count(DISTINCT o_custkey),
       count(o_custkey) = count(DISTINCT o_custkey) FROM orders""")
def q_key_profile(spark, sf_dir):
    from rarelab.operators.profile import key_profile
    return key_profile(read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey"), "o_orderkey", "o_custkey")


# ---------------------------------------------------------------------- D4
@register("numeric_describe", """
SELECT 'o_custkey' AS "column", count(o_custkey) AS count, round(avg(o_custkey), 6) AS mean,
       round(stddev_samp(o_custkey), 6) AS std, CAST(min(o_custkey) AS DOUBLE) AS min,
       round(quantile_cont(CAST(o_custkey AS DOUBLE), 0.25), 6) AS p25,
       round(quantile_cont(CAST(o_custkey AS DOUBLE), 0.5), 6) AS p50,
       round(quantile_cont(CAST(o_custkey AS DOUBLE), 0.75), 6) AS p75,
       CAST(max(o_custkey) AS DOUBLE) AS max
FROM orders""")
def q_numeric_describe(spark, sf_dir):
    from rarelab.operators.profile import describe
    return rounded(describe(read_table(spark, sf_dir, "orders", "o_custkey"), "o_custkey"))


# ---------------------------------------------------------------------- D1
@register("winner_frequency", """
SELECT o_custkey, count(*) AS count FROM orders WHERE o_custkey IS NOT NULL
GROUP BY o_custkey ORDER BY count DESC, o_custkey""")
def q_winner_frequency(spark, sf_dir):
    from rarelab.operators.profile import frequency
    return frequency(read_table(spark, sf_dir, "orders", "o_custkey"), "o_custkey")


# ---------------------------------------------------------------------- D2
@register("class_share", with_ctes(_ef_cte(), _train_cte(), body="""
SELECT label, count(*) AS count, round(count(*) / (SELECT count(label) FROM train), 6) AS share
FROM train WHERE label IS NOT NULL GROUP BY label"""))
def q_class_share(spark, sf_dir):
    from rarelab.operators.profile import class_share
    return rounded(class_share(_train(fx.entity_features(spark, sf_dir)), "label"))


@register("null_class_share", with_ctes(fx.DOC_LABELS_SQL, body="""
SELECT toxic, count(*) AS count, round(count(*) / (SELECT count(toxic) FROM doc_labels), 6) AS share
FROM doc_labels WHERE toxic IS NOT NULL GROUP BY toxic"""))
def q_null_class_share(spark, sf_dir):
    from rarelab.operators.profile import class_share
    return rounded(class_share(fx.doc_labels(spark, sf_dir), "toxic"))


# ---------------------------------------------------------------------- I11
@register("majority_baseline", with_ctes(_ef_cte(), """
c AS (SELECT CASE WHEN generation <= 6 THEN 'train' ELSE CAST(generation AS VARCHAR) END AS cohort,
             label, count(*) AS n FROM entity_features WHERE label IS NOT NULL GROUP BY 1, 2)""", body="""
SELECT cohort, round(max(n) / sum(n), 6) AS baseline_accuracy,
       arg_max(label, n) AS majority_class
FROM c GROUP BY cohort"""))
def q_majority_baseline(spark, sf_dir):
    from rarelab.operators.profile import majority_baseline
    ef = fx.entity_features(spark, sf_dir)
    cohort = F.when(F.col("generation") <= 6, F.lit("train")).otherwise(F.col("generation").cast("string"))
    return rounded(majority_baseline(ef.withColumn("cohort", cohort), "label", by="cohort"))


# ------------------------------------------------------------- D6, D7, D8, D10
def _corr_sql_long(cols):
    from rarelab.functions.columns import sql_safe_corr
    aggs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j >= i:
                aggs.append(f"{sql_safe_corr(a, b)} AS r{i}_{j}")
    cells = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            cells.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, r{min(i, j)}_{max(i, j)} AS r FROM agg")
    return (f"agg AS (SELECT {', '.join(aggs)} FROM train),\n"
            f"long AS ({' UNION ALL '.join(cells)})")


CORR_LONG_CTE = _corr_sql_long(CORR_COLS)
MODEL_LONG_CTE = _corr_sql_long(MODEL_COLS)


@register("correlation_matrix", with_ctes(_ef_cte(), _train_cte(), CORR_LONG_CTE, body="""
SELECT feature_a, feature_b, round(r, 6) AS r FROM long"""))
def q_correlation_matrix(spark, sf_dir):
    from rarelab.operators.profile import correlation_long
    return rounded(correlation_long(_train(fx.entity_features(spark, sf_dir)), CORR_COLS))


@register("label_correlation", with_ctes(_ef_cte(), _train_cte(), CORR_LONG_CTE, body="""
SELECT feature_a AS feature, round(r, 6) AS r,
       CAST(row_number() OVER (ORDER BY r DESC NULLS LAST, feature_a) AS INTEGER) AS rank
FROM long WHERE feature_b = 'label'"""))
def q_label_correlation(spark, sf_dir):
    from rarelab.operators.profile import label_correlation
    return rounded(label_correlation(_train(fx.entity_features(spark, sf_dir)), CORR_COLS, "label"))


@register("select_features", with_ctes(_ef_cte(), _train_cte(), MODEL_LONG_CTE, body="""
SELECT feature, round(r, 6) AS r, CAST(rank AS INTEGER) AS rank FROM (
  SELECT feature_a AS feature, r, row_number() OVER (ORDER BY r DESC NULLS LAST, feature_a) AS rank
  FROM long WHERE feature_b = 'label') WHERE rank BETWEEN 2 AND 7"""))
def q_select_features(spark, sf_dir):
    from rarelab.operators.profile import select_top_correlated
    return rounded(select_top_correlated(_train(fx.entity_features(spark, sf_dir)), MODEL_COLS, "label", 6))


@register("correlation_wide", with_ctes(_ef_cte(), _train_cte(), CORR_LONG_CTE, body="SELECT feature_a AS feature, " + ", ".join(
    f"round(max(CASE WHEN feature_b = '{b}' THEN r END), 6) AS {b}" for b in CORR_COLS)
    + " FROM long GROUP BY feature_a"))
def q_correlation_wide(spark, sf_dir):
    from rarelab.operators.profile import correlation_wide
    return rounded(correlation_wide(_train(fx.entity_features(spark, sf_dir)), CORR_COLS))


# ---------------------------------------------------------------------- D9
@register("class_histogram", with_ctes(_ef_cte(), _train_cte(), """
rng AS (SELECT label, CASE WHEN min(n_orders) = max(n_orders) THEN min(n_orders) - 0.5 ELSE min(n_orders) END AS lo,
               CASE WHEN min(n_orders) = max(n_orders) THEN max(n_orders) + 0.5 ELSE max(n_orders) END AS hi
        FROM train WHERE n_orders IS NOT NULL GROUP BY label)""", """
binned AS (SELECT t.label, CAST(least(floor((CAST(n_orders AS DOUBLE) - lo) * (10.0 / (hi - lo))), 9) AS INTEGER) AS bin
           FROM train t JOIN rng ON t.label = rng.label WHERE n_orders IS NOT NULL)""", """
counts AS (SELECT label, bin, count(*) AS count FROM binned GROUP BY label, bin)""", body="""
SELECT g.label, CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * ((hi - lo) / 10.0), 6) AS bin_lo,
       round(lo + (g.bin + 1) * ((hi - lo) / 10.0), 6) AS bin_hi, coalesce(count, 0) AS count
FROM (SELECT label, lo, hi, unnest(generate_series(0, 9)) AS bin FROM rng) g
LEFT JOIN counts c ON g.label = c.label AND g.bin = c.bin"""))
def q_class_histogram(spark, sf_dir):
    from rarelab.operators.profile import class_histogram
    return rounded(class_histogram(_train(fx.entity_features(spark, sf_dir)), "n_orders", "label", 10))


# ---------------------------------------------------------------------- B12
@register("facet_long", with_ctes(_ef_cte(), body=" UNION ALL ".join(
    f"SELECT entity_id, label, '{c}' AS feature, round(CAST({c} AS DOUBLE), 6) AS value FROM entity_features"
    for c in FACET_FEATURES)))
def q_facet_long(spark, sf_dir):
    from rarelab.operators.features import facet_long
    return rounded(facet_long(fx.entity_features(spark, sf_dir), ["entity_id", "label"], FACET_FEATURES))


# ---------------------------------------------------------- B6, B8, B9, B3, B4
@register("null_safe_total", with_ctes(fx.DOC_LABELS_SQL, body="""
SELECT doc_id, coalesce(quality, 0) + coalesce(toxic, 0) AS label_total FROM doc_labels"""))
def q_null_safe_total(spark, sf_dir):
    from rarelab.functions.columns import null_safe_sum
    return fx.doc_labels(spark, sf_dir).select("doc_id", null_safe_sum("quality", "toxic").alias("label_total"))


@register("flag_cast", with_ctes(fx.DOC_LABELS_SQL, body="""
SELECT doc_id, CAST(toxic AS BOOLEAN) AS is_toxic FROM doc_labels"""))
def q_flag_cast(spark, sf_dir):
    from rarelab.functions.columns import flag_cast
    return fx.doc_labels(spark, sf_dir).select("doc_id", flag_cast("toxic").alias("is_toxic"))


@register("flag_map", with_ctes(fx.DOC_LABELS_SQL, body="""
SELECT doc_id, CASE WHEN quality = 1 THEN TRUE WHEN quality = 0 THEN FALSE END AS is_quality FROM doc_labels"""))
def q_flag_map(spark, sf_dir):
    from rarelab.functions.columns import flag_map
    return fx.doc_labels(spark, sf_dir).select("doc_id", flag_map("quality", {1: True, 0: False}).alias("is_quality"))


@register("drop_columns", with_ctes(_ef_cte(), body="""
SELECT entity_id, category_1, category_2, generation, c_acctbal, n_orders, quantity, n_lines, wins, label
FROM entity_features"""))
def q_drop_columns(spark, sf_dir):
    return fx.entity_features(spark, sf_dir).drop("spend")


@register("cohort_filter", with_ctes(_ef_cte(), body="""
SELECT entity_id, n_orders, wins, label FROM entity_features WHERE generation = 7"""))
def q_cohort_filter(spark, sf_dir):
    return fx.entity_features(spark, sf_dir).where(F.col("generation") == 7).select(
        "entity_id", "n_orders", "wins", "label")


# ---------------------------------------------------------------- B10, B11
@register("column_concat", with_ctes(_ef_cte(), body="""
SELECT a.entity_id, a.n_orders, b.label FROM entity_features a JOIN entity_features b ON a.entity_id = b.entity_id"""))
def q_column_concat(spark, sf_dir):
    ef = fx.entity_features(spark, sf_dir)
    x = ef.select("entity_id", "n_orders")
    y = ef.select(F.col("entity_id").alias("y_id"), "label")
    return x.join(y, x.entity_id == y.y_id).drop("y_id")


@register("assemble_features", with_ctes(_ef_cte(), body="""
SELECT entity_id, [CAST(n_orders AS DOUBLE), CAST(wins AS DOUBLE)] AS features FROM entity_features"""))
def q_assemble_features(spark, sf_dir):
    from rarelab.operators.features import assemble
    return rounded(fx.entity_features(spark, sf_dir).select("entity_id", assemble(["n_orders", "wins"])))


# ---------------------------------------------------------------------- F1
def _one_hot_sql():
    cols = []
    for c, levels in (("category_1", CATEGORY_1_LEVELS), ("category_2", CATEGORY_2_LEVELS)):
        for lv in levels:
            cols.append(f"coalesce(CAST({c} = '{lv}' AS INTEGER), 0) AS \"{c}_{lv}\"")
    return "SELECT entity_id, " + ", ".join(cols) + " FROM entity_features"


@register("one_hot", with_ctes(_ef_cte(), body=_one_hot_sql()))
def q_one_hot(spark, sf_dir):
    from rarelab.operators.features import one_hot
    ef = fx.entity_features(spark, sf_dir).select("entity_id", "category_1", "category_2")
    return one_hot(ef, ["category_1", "category_2"])


# ------------------------------------------------------------------ F2, F3
def _standardize_sql(cols):
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in cols)
    outs = ", ".join(
        f"round((CAST({c} AS DOUBLE) - m_{c}) / (CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END), 6) AS {c}" for c in cols)
    return with_ctes(_ef_cte(), _train_cte(), f"st AS (SELECT {stats} FROM train)",
                     body=f"SELECT entity_id, generation, {outs} FROM entity_features, st")


@register("standardize", _standardize_sql(list(fx.NUMERIC_STATS)))
def q_standardize(spark, sf_dir):
    from rarelab.operators.features import fit_scaler
    ef = fx.entity_features(spark, sf_dir)
    cols = list(fx.NUMERIC_STATS)
    scaler = fit_scaler(_train(ef), cols)
    return rounded(scaler.transform(ef.select("entity_id", "generation", *cols), cols))


# ---------------------------------------------------------------------- F4
def _feature_sets_sql():
    """Static sets, dummy names from the data's levels, top-correlated from the
    D8 ranking - all derived in SQL as on the Spark side."""
    dummies = """dummy AS (
  SELECT name, row_number() OVER (ORDER BY src, lv) AS pos FROM (
    SELECT DISTINCT 1 AS src, category_1 AS lv, 'category_1_' || category_1 AS name
    FROM entity_features WHERE category_1 IS NOT NULL
    UNION ALL
    SELECT DISTINCT 2, category_2, 'category_2_' || category_2
    FROM entity_features WHERE category_2 IS NOT NULL))"""
    ranked = """ranked AS (SELECT feature_a AS feature, row_number() OVER (ORDER BY r DESC NULLS LAST, feature_a) AS rank
                FROM long WHERE feature_b = 'label')"""
    body = """
SELECT 'all_no_total' AS feature_set, pos AS position, feature FROM (VALUES (1, 'c_acctbal'), (2, 'quantity'),
       (3, 'n_lines'), (4, 'wins')) v(pos, feature)
UNION ALL SELECT 'all_no_total', 4 + pos, name FROM dummy
UNION ALL SELECT 'total_dummies', 1, 'n_orders'
UNION ALL SELECT 'total_dummies', 1 + pos, name FROM dummy
UNION ALL SELECT 'top_correlated', rank - 1, feature FROM ranked WHERE rank BETWEEN 2 AND 7
UNION ALL SELECT 'total_wins', 1, 'n_orders' UNION ALL SELECT 'total_wins', 2, 'wins'
UNION ALL SELECT 'total_only', 1, 'n_orders'"""
    return with_ctes(_ef_cte(), _train_cte(), MODEL_LONG_CTE, dummies, ranked,
                     body=f"SELECT feature_set, CAST(position AS INTEGER) AS position, feature FROM ({body})")


@register("feature_sets", _feature_sets_sql())
def q_feature_sets(spark, sf_dir):
    from rarelab.operators.features import category_levels, dummy_name, feature_sets
    from rarelab.operators.profile import select_top_correlated
    ef = fx.entity_features(spark, sf_dir)
    dummies = []
    for c in fx.CATEGORICAL:
        dummies += [dummy_name(c, lv) for lv in category_levels(ef, c)]
    # the ranking has one row per profiled column: a bounded collect
    top = [r["feature"] for r in select_top_correlated(_train(ef), MODEL_COLS, "label", 6).orderBy("rank").collect()]
    sets = feature_sets(list(fx.NUMERIC_STATS), fx.TOTAL, "wins", dummies, top)
    rows = [(name, i + 1, f) for name, cols in sets.items() for i, f in enumerate(cols)]
    return spark.createDataFrame(rows, "feature_set string, position int, feature string")
