"""The study's remaining configurations: feature sets as matrices and their
grid searches (F4, J1), holdout reports of the chosen models (I1-I7), and the
scope of the scaler's fit (F2, I12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rarelab.plans.catalog import register, rounded, with_ctes
from rarelab.plans.queries_model import (CONFUSION_BODY, GRID_KS, REPORT_BODY, REPORT_CTES, TRAIN_SQL, _cv_sides_sql,
                                         _fold_ctes, _holdout_cte, _knn_sql, _report, _train, _weights_sql)
from rarelab.plans.queries_profile import CATEGORY_1_LEVELS, CATEGORY_2_LEVELS, MODEL_COLS
from rarelab.sources import fixtures as fx

LEVELS = {"category_1": CATEGORY_1_LEVELS, "category_2": CATEGORY_2_LEVELS}
DUMMIES = [f"{c}_{i}" for c, levels in LEVELS.items() for i in range(len(levels))]
STATS = [c for c in MODEL_COLS if c != "label"]
#: Fixed sets of the study; the most correlated columns are every stat here (five of at most six).
SETS = {
    "all_no_total": [c for c in STATS if c not in (fx.TOTAL, "wins")] + ["wins"] + DUMMIES,
    "total_dummies": [fx.TOTAL, *DUMMIES],
    "top_correlated": STATS,
    "total_wins": [fx.TOTAL, "wins"],
}


def _matrix_sql() -> str:
    cols = [f"CAST({c} AS DOUBLE) AS {c}" for c in STATS]
    cols += [f"CAST(coalesce({c} = '{lv}', FALSE) AS DOUBLE) AS {c}_{i}" for c, levels in LEVELS.items() for i, lv in enumerate(levels)]
    return f"train AS (SELECT entity_id, label, {', '.join(cols)} FROM entity_features WHERE generation <= 6)"


def _weights(train, feats: list[str]) -> list[float]:
    """Standardised stats (``1 / std^2`` of the training rows), dummies as they are."""
    from rarelab.operators.knn import scaling_weights
    stats = [c for c in feats if c not in DUMMIES]
    by = dict(zip(stats, scaling_weights(train, stats), strict=True))
    return [by.get(c, 1.0) for c in feats]


def _weight_ctes(feats: list[str], src: str = "train") -> list[str]:
    stats = [c for c in feats if c not in DUMMIES]
    ones = ", ".join(f"CAST(1.0 AS DOUBLE) AS w_{c}" for c in feats if c in DUMMIES)
    return [_weights_sql(src, stats, "wstats"), f"wt AS (SELECT *{', ' + ones if ones else ''} FROM wstats)"]


def _grid_query(name: str) -> None:
    feats = SETS[name]
    sql = with_ctes(
        fx.ENTITY_SQL, _matrix_sql(), *_fold_ctes(5, 1, None), *_cv_sides_sql(5, feats), *_weight_ctes(feats),
        _knn_sql("tr", "qu", feats, max(GRID_KS), split=True, weights="wt"), """
cum AS (SELECT split_id, qk, rank AS k,
               sum(CAST(ty AS INTEGER)) OVER (PARTITION BY split_id, qk ORDER BY rank) AS pos FROM nb)""", f"""
acc AS (SELECT c.split_id, k, avg(CAST((2 * pos > k) = q.y AS DOUBLE)) AS accuracy
        FROM cum c JOIN qu q ON c.split_id = q.split_id AND c.qk = q.qk
        WHERE k IN ({', '.join(map(str, GRID_KS))}) GROUP BY c.split_id, k)""", body="""
SELECT CAST(k AS INTEGER) AS k, round(avg(accuracy), 6) AS mean_test_score, round(stddev_pop(accuracy), 6) AS std_test_score
FROM acc GROUP BY k""")

    @register(f"grid_{name}", sql)
    def q(spark, sf_dir):
        from rarelab.operators.features import model_matrix
        from rarelab.operators.splits import stratified_folds
        from rarelab.plans.crossval import cv_knn_sweep, grid_summary
        t = model_matrix(_train(spark, sf_dir), STATS, LEVELS, ["entity_id", "label"]).select("entity_id", "label", *feats)
        folds = stratified_folds(t, "label", "entity_id", 5)
        scores = cv_knn_sweep(folds, 5, feats, GRID_KS, weights=_weights(t, feats))
        return rounded(grid_summary(scores).select(F.col("k").cast("int").alias("k"), "mean_test_score", "std_test_score"))


for _name in SETS:
    _grid_query(_name)


@register("feature_matrix", with_ctes(fx.ENTITY_SQL, _matrix_sql(), body="SELECT * FROM train"))
def q_feature_matrix(spark, sf_dir):
    """the matrix that the named sets are columns of."""
    from rarelab.operators.features import model_matrix
    return model_matrix(_train(spark, sf_dir), STATS, LEVELS, ["entity_id", "label"])


# ------------------------------------------------- holdout reports
#: Fixed values of the study: features, neighbours and split seed of the two models it reports.
HOLDOUTS = {"total_wins": (["n_orders", "wins"], 3, 5), "total_only": (["n_orders"], 5, 6)}


def _holdout_predictions(spark, sf_dir, name: str):
    from rarelab.operators.knn import KnnModel, scaling_weights
    from rarelab.operators.splits import holdout_split
    feats, k, seed = HOLDOUTS[name]
    t = holdout_split(_train(spark, sf_dir).select("entity_id", "label", *feats), "entity_id", 0.2, seed)
    train = t.where(~F.col("is_test"))
    rows = t.where("is_test").select("entity_id", F.lit("test").alias("cohort"), "label", *feats)
    model = KnnModel(train, feats, k=k, weights=scaling_weights(train, feats))
    return model.transform(rows).select("entity_id", "cohort", "label", "pred")


def _holdout_ctes(name: str) -> list[str]:
    feats, k, seed = HOLDOUTS[name]
    cols = ", ".join(feats)
    return [fx.ENTITY_SQL, TRAIN_SQL, _holdout_cte(seed, 0.2), f"tr AS (SELECT entity_id AS tk, label AS ty, {cols} FROM ho WHERE NOT is_test)",
            f"qu AS (SELECT entity_id AS qk, {cols} FROM ho WHERE is_test)", _weights_sql("tr", feats),
            _knn_sql("tr", "qu", feats, k, weights="wt"), """
preds AS (SELECT entity_id, 'test' AS cohort, label, pos * 2 > n AS pred FROM ho JOIN (
    SELECT qk, count(*) FILTER (WHERE ty) AS pos, count(*) AS n FROM nb GROUP BY qk) v ON entity_id = qk)"""]


def _holdout_queries(name: str) -> None:
    @register(f"holdout_{name}_metrics", with_ctes(*_holdout_ctes(name), *REPORT_CTES, body=REPORT_BODY))
    def metrics_query(spark, sf_dir):
        return _report(_holdout_predictions(spark, sf_dir, name))

    @register(f"holdout_{name}_confusion", with_ctes(*_holdout_ctes(name), body=CONFUSION_BODY))
    def confusion_query(spark, sf_dir):
        from rarelab.operators.metrics import confusion_counts
        return confusion_counts(_holdout_predictions(spark, sf_dir, name), by="cohort")


for _name in HOLDOUTS:
    _holdout_queries(_name)


# --------------------------------------------------- scope of the scaler
SCOPES = ("train", "all", "cohort")
SCOPE_STATS = """
sc AS (SELECT avg(CAST(n_orders AS DOUBLE)) FILTER (WHERE generation <= 6) AS tm, stddev_pop(CAST(n_orders AS DOUBLE)) FILTER (WHERE generation <= 6) AS ts,
              avg(CAST(n_orders AS DOUBLE)) AS am, stddev_pop(CAST(n_orders AS DOUBLE)) AS asd FROM entity_features),
cs AS (SELECT CASE WHEN generation > 6 THEN generation END AS g, avg(CAST(n_orders AS DOUBLE)) AS cm, stddev_pop(CAST(n_orders AS DOUBLE)) AS csd
       FROM entity_features GROUP BY 1)"""


@register("scaler_scopes", with_ctes(fx.ENTITY_SQL, SCOPE_STATS.strip(), body="""
SELECT entity_id, s.scope, round(CASE s.scope WHEN 'train' THEN (n_orders - tm) / ts WHEN 'all' THEN (n_orders - am) / asd
       ELSE (n_orders - cm) / csd END, 6) AS n_orders
FROM entity_features e, sc, cs, (VALUES ('train'), ('all'), ('cohort')) s(scope)
WHERE cs.g IS NOT DISTINCT FROM CASE WHEN e.generation > 6 THEN e.generation END"""))
def q_scaler_scopes(spark, sf_dir):
    """the scaled total under each scope of the fit."""
    from rarelab.operators.features import scale
    ef = fx.entity_features(spark, sf_dir).select("entity_id", "generation", "n_orders")
    out = None
    for scope in SCOPES:
        s = scale(ef, ["n_orders"], F.col("generation") <= 6, scope, "generation").select(
            "entity_id", F.lit(scope).alias("scope"), "n_orders")
        out = s if out is None else out.unionByName(s)
    return rounded(out)


@register("cohort_by_scope", with_ctes(
    fx.ENTITY_SQL, TRAIN_SQL, SCOPE_STATS.strip(), "tr AS (SELECT entity_id AS tk, label AS ty, CAST(n_orders AS DOUBLE) AS x FROM train)", """
qu AS (SELECT entity_id * 3 + s.n AS qk, e.label, s.scope, CASE WHEN s.scope = 'cohort' AND csd > 0 THEN (n_orders - cm) / csd * ts + tm
       ELSE CAST(n_orders AS DOUBLE) END AS x
       FROM entity_features e, sc, cs, (VALUES (0, 'train'), (1, 'all'), (2, 'cohort')) s(n, scope) WHERE e.generation = 7 AND cs.g = 7)""",
    _knn_sql("tr", "qu", ["x"], 5), """
preds AS (SELECT scope AS cohort, label, pos * 2 > n AS pred FROM qu JOIN (
    SELECT qk, count(*) FILTER (WHERE ty) AS pos, count(*) AS n FROM nb GROUP BY qk) v ON qu.qk = v.qk)""",
    *REPORT_CTES, body=REPORT_BODY))
def q_cohort_by_scope(spark, sf_dir):
    """The total-only model (k = 5) on cohort 7, the cohort scaled under
    each scope (the report's ``cohort`` column).  Distances are taken in the
    units of the training rows: a value scaled by the statistics that its
    training rows were scaled by is its raw value there, so exact ties stay
    exact; one scaled by its cohort's is moved and stretched."""
    from rarelab.operators.knn import KnnModel
    ef = fx.entity_features(spark, sf_dir)
    x = F.col("n_orders").cast("double")
    train = _train(spark, sf_dir).select("entity_id", "label", x.alias("x"))
    seven = ef.where(F.col("generation") == 7)
    stat = lambda df: df.agg(F.avg(x).alias("m"), F.stddev_pop(x).alias("s"))
    t, c = stat(_train(spark, sf_dir)).first(), stat(seven).first()
    moved = (x - F.lit(c["m"])) / F.lit(c["s"]) * F.lit(t["s"]) + F.lit(t["m"]) if c["s"] else x
    rows = None
    for n, scope in enumerate(SCOPES):
        part = seven.select((F.col("entity_id") * 3 + n).alias("entity_id"), F.lit(scope).alias("cohort"), "label",
                            (moved if scope == "cohort" else x).alias("x"))
        rows = part if rows is None else rows.unionByName(part)
    return _report(KnnModel(train, ["x"], k=5).transform(rows).select("entity_id", "cohort", "label", "pred"))


# --------------------------------------------- kNN with nulls in a feature (H1)
NULL_FEATURES = {"1d": ["n_orders"], "2d": ["n_orders", "wins"]}


def _null_query(name: str, feats: list[str]) -> None:
    gap = "CASE WHEN entity_id % 7 <> 0 THEN n_orders END AS n_orders"
    rest = "".join(f", {c}" for c in feats[1:])
    some = "n_orders IS NOT NULL"
    sql = with_ctes(fx.ENTITY_SQL, f"""
tr AS (SELECT * FROM (SELECT entity_id AS tk, label AS ty, {gap}{rest} FROM entity_features WHERE generation <= 6) WHERE {some})""", f"""
qu AS (SELECT * FROM (SELECT entity_id AS qk, {gap}{rest} FROM entity_features WHERE generation > 6) WHERE {some})""",
                    _knn_sql("tr", "qu", feats, 5), body="""
SELECT qk AS entity_id, 2 * count(*) FILTER (WHERE ty) > count(*) AS pred, round(count(*) FILTER (WHERE ty) / count(*), 6) AS proba
FROM nb GROUP BY qk""")

    @register(f"knn_nulls_{name}", sql)
    def q(spark, sf_dir):
        """Rows with a null feature are neither neighbours nor answered."""
        from rarelab.operators.knn import knn_neighbors, knn_vote
        ef = fx.entity_features(spark, sf_dir).withColumn("n_orders", F.when(F.col("entity_id") % 7 != 0, F.col("n_orders")))
        ef = ef.select("entity_id", "generation", "label", *feats)
        nb = knn_neighbors(ef.where(F.col("generation") <= 6), ef.where(F.col("generation") > 6), feats, 5)
        return rounded(knn_vote(nb, "entity_id").select("entity_id", "pred", "proba"))


for _name, _feats in NULL_FEATURES.items():
    _null_query(_name, _feats)


# ------------------------------------------------ columns of any number of levels (F1, F4 with H1, H4)
def _favourite_parts(spark, sf_dir):
    """The fixture's entities with the part of their dearest line, a column of about as many levels as there are parts."""
    from rarelab.sources.tables import read_table
    lines = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    dearest = F.struct("l_extendedprice", "l_orderkey", "l_linenumber")
    best = lines.groupBy("l_orderkey").agg(F.max_by("l_partkey", dearest).alias("part"), F.max(dearest).alias("line"))
    best = best.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(
        F.max_by("part", "line").alias("favourite_part"))
    ef = fx.entity_features(spark, sf_dir)
    return ef.join(best, F.col("entity_id") == F.col("o_custkey"), "left").select(
        "entity_id", "generation", "label", "n_orders", "category_1", "favourite_part")


def _level_gap(col: str) -> str:
    return f"(CASE WHEN q.{col} IS NOT DISTINCT FROM t.{col} THEN 0 WHEN q.{col} IS NULL OR t.{col} IS NULL THEN 1 ELSE 2 END)"


@register("knn_level_codes", with_ctes(fx.ENTITY_SQL, """
fav AS (SELECT o_custkey AS fk, first(l_partkey ORDER BY l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC) AS part
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)""", """
ent AS (SELECT entity_id, generation, label, n_orders, category_1, part FROM entity_features LEFT JOIN fav ON entity_id = fk)""", f"""
nb AS (SELECT q.entity_id AS qk, t.label AS ty,
              (q.n_orders - t.n_orders) * (q.n_orders - t.n_orders) + {_level_gap('category_1')} + {_level_gap('part')} AS d2,
              row_number() OVER (PARTITION BY q.entity_id ORDER BY (q.n_orders - t.n_orders) * (q.n_orders - t.n_orders)
                                 + {_level_gap('category_1')} + {_level_gap('part')}, t.entity_id) AS rank
       FROM ent q, ent t WHERE q.generation > 6 AND t.generation <= 6 QUALIFY rank <= 5)""",
    "votes AS (SELECT qk, count(*) FILTER (WHERE ty) AS pos, count(*) AS n FROM nb GROUP BY qk)", body="""
SELECT entity_id, generation, label, pos * 2 > n AS pred, round(pos / n, 6) AS proba FROM ent JOIN votes ON entity_id = qk"""))
def q_knn_level_codes(spark, sf_dir):
    """H1 on a number and two one-hot columns, one of them as wide as there are parts: the later cohorts against
    the training rows, by level codes."""
    from rarelab.operators.knn import knn_neighbors, knn_vote
    from rarelab.operators.sparse import encode_levels, level_table
    from rarelab.session import cut_lineage
    cols = ["category_1", "favourite_part"]
    ent = cut_lineage(_favourite_parts(spark, sf_dir))
    ent = encode_levels(ent, cols, level_table(ent, cols))
    query = ent.where(F.col("generation") > 6)
    nb = knn_neighbors(ent.where(F.col("generation") <= 6), query, ["n_orders"], 5, codes=[f"{c}_code" for c in cols])
    return rounded(query.select("entity_id", "generation", "label").join(knn_vote(nb), "entity_id"))


SPARSE_STEPS, SPARSE_DIGITS = 12, 4


def _sparse_newton_sql() -> str:
    """Newton steps of an L2 logistic model with one weight per level: the Hessian is diagonal but for the
    intercept's row, so its step is solved first."""
    steps = ["""
it_0 AS MATERIALIZED (SELECT l_partkey AS lev, count(*) AS n, CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS y,
         CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS w FROM lineitem GROUP BY l_partkey)"""]
    for i in range(SPARSE_STEPS):
        steps.append(f"""
e_{i} AS MATERIALIZED (SELECT *, w + n * p - y AS g, n * p * (1 - p) AS c, n * p - y AS r
         FROM (SELECT *, 1 / (1 + exp(-(b + w))) AS p FROM it_{i})),
s_{i} AS (SELECT -(sum(r) - sum(c * g / (1 + c))) / (sum(c) - sum(c * c / (1 + c))) AS db FROM e_{i}),
it_{i + 1} AS MATERIALIZED (SELECT lev, n, y, b + db AS b, w - (g + c * db) / (1 + c) AS w FROM e_{i}, s_{i})""")
    return with_ctes(*steps, body=f"""
SELECT CAST(lev AS VARCHAR) AS level, round(w, {SPARSE_DIGITS}) AS coef, round(b, {SPARSE_DIGITS}) AS intercept FROM it_{SPARSE_STEPS}""")


@register("logistic_level_weights", _sparse_newton_sql())
def q_logistic_level_weights(spark, sf_dir):
    """H4 with one dummy per part over all order lines: is a line returned?  Every level's weight."""
    from rarelab.operators.sparse import fit_level_logistic
    from rarelab.sources.tables import read_table
    lines = read_table(spark, sf_dir, "lineitem", "l_partkey", "l_returnflag").withColumn("label", F.col("l_returnflag") == "R")
    model = fit_level_logistic(lines, "l_partkey")
    return rounded(model.weights.select("level", F.col("w").alias("coef"), F.lit(model.intercept).alias("intercept")), SPARSE_DIGITS)
