"""Queries for splits (G1-G3), resampling (G4-G7), models (H) and tuning (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rarelab.functions.hashing import sql_hash_string
from rarelab.plans.catalog import register, rounded, with_ctes
from rarelab.plans.queries_eval import PER_CLASS_SQL
from rarelab.sources import fixtures as fx

TRAIN_SQL = "train AS (SELECT * FROM entity_features WHERE generation <= 6)"
HOLDOUT_SEED = 5
FOLD_SEED = 1


def _train(spark, sf_dir):
    return fx.entity_features(spark, sf_dir).where(F.col("generation") <= 6)


# ------------------------------------------------------------------ G1
@register("holdout_split", with_ctes(fx.ENTITY_SQL, TRAIN_SQL, body=f"""
SELECT entity_id, rn <= (SELECT ceil(0.2 * count(*)) FROM train) AS is_test FROM
  (SELECT entity_id, row_number() OVER (ORDER BY {sql_hash_string(HOLDOUT_SEED, 'entity_id')}, entity_id) AS rn
   FROM train)"""))
def q_holdout_split(spark, sf_dir):
    from rarelab.operators.splits import holdout_split
    return holdout_split(_train(spark, sf_dir).select("entity_id"), "entity_id", 0.2, HOLDOUT_SEED)


# -------------------------------------------------------------- G2, G3
def _fold_ctes(n_splits: int, n_repeats: int, seed: int | None) -> list[str]:
    """CTEs ending in ``folds(entity_id, rep, fold)`` (same rule as the Spark side)."""
    if seed is None:
        order, reps = "entity_id", "SELECT 0 AS rep"
    else:
        order = f"{sql_hash_string(seed, 'rep', 'entity_id')}, entity_id"
        reps = f"SELECT unnest(generate_series(0, {n_repeats - 1})) AS rep"
    return [
        "cls AS (SELECT label, count(*) AS n, min(entity_id) AS first_key FROM train GROUP BY label)",
        "enc AS (SELECT label, n, sum(n) OVER (ORDER BY first_key) - n AS start FROM cls)",
        f"""alloc AS (SELECT label, f AS fold,
                 floor((start + n - 1 - f) / {n_splits}.0) - floor((start - 1 - f) / {n_splits}.0) AS a
          FROM enc, (SELECT unnest(generate_series(0, {n_splits - 1})) AS f))""",
        """bounds AS (SELECT label, fold, sum(a) OVER (PARTITION BY label ORDER BY fold) - a AS lo,
                  sum(a) OVER (PARTITION BY label ORDER BY fold) AS hi FROM alloc)""",
        f"reps AS ({reps})",
        f"""ranked AS (SELECT entity_id, label, rep,
                  row_number() OVER (PARTITION BY rep, label ORDER BY {order}) - 1 AS r FROM train, reps)""",
        """folds AS (SELECT entity_id, rep, CAST(fold AS INTEGER) AS fold
           FROM ranked JOIN bounds ON ranked.label = bounds.label AND r >= lo AND r < hi)""",
    ]


def _folds_sql(n_splits: int, n_repeats: int, seed: int | None) -> str:
    return with_ctes(fx.ENTITY_SQL, TRAIN_SQL, *_fold_ctes(n_splits, n_repeats, seed),
                     body='SELECT entity_id, CAST(rep AS INTEGER) AS "repeat", fold FROM folds')


@register("stratified_folds", _folds_sql(5, 1, None))
def q_stratified_folds(spark, sf_dir):
    from rarelab.operators.splits import stratified_folds
    t = _train(spark, sf_dir).select("entity_id", "label")
    return stratified_folds(t, "label", "entity_id", 5).select("entity_id", "repeat", "fold")


@register("repeated_stratified_folds", _folds_sql(10, 3, FOLD_SEED))
def q_repeated_stratified_folds(spark, sf_dir):
    from rarelab.operators.splits import stratified_folds
    t = _train(spark, sf_dir).select("entity_id", "label")
    return stratified_folds(t, "label", "entity_id", 10, seed=FOLD_SEED, n_repeats=3).select(
        "entity_id", "repeat", "fold")


# =============================================================== kNN (H1, H2)
def _knn_sql(tr: str, qu: str, feats: list[str], k: int, split: bool = False,
             exclude_self: bool = False, weights: str | None = None, array: bool = False,
             name: str = "nb") -> str:
    """CTE ``nb(split_id?, qk, tk, ty, d2, rank)``: brute force for the oracle.
    ``tr(split_id?, tk, ty, feats...)``, ``qu(split_id?, qk, feats...)``;
    ``weights`` names a one-row CTE with columns ``w_<feat>``."""
    if array:
        d2 = f"list_sum(list_transform(generate_series(1, len(q.{feats[0]})), lambda i: (q.{feats[0]}[i] - t.{feats[0]}[i]) * (q.{feats[0]}[i] - t.{feats[0]}[i])))"
    else:
        terms = [f"((q.{f} - t.{f}) * (q.{f} - t.{f})) * {'w_' + f if weights else '1.0'}" for f in feats]
        d2 = " + ".join(terms)
    cond = ["q.split_id = t.split_id"] if split else []
    if exclude_self:
        cond.append("q.qk <> t.tk")
    where = ("WHERE " + " AND ".join(cond)) if cond else ""
    part = "q.split_id, q.qk" if split else "q.qk"
    sel = "q.split_id, " if split else ""
    src = f"{qu} q, {tr} t" + (f", {weights}" if weights else "")
    return f"""{name} AS (SELECT {sel}q.qk, t.tk, t.ty, {d2} AS d2,
        row_number() OVER (PARTITION BY {part} ORDER BY {d2}, t.tk) AS rank
    FROM {src} {where} QUALIFY rank <= {k})"""


def _weights_sql(src: str, feats: list[str], name: str = "wt") -> str:
    cols = ", ".join(
        f"CASE WHEN stddev_pop(CAST({f} AS DOUBLE)) > 0 THEN 1.0 / (stddev_pop(CAST({f} AS DOUBLE)) * "
        f"stddev_pop(CAST({f} AS DOUBLE))) ELSE 1.0 END AS w_{f}" for f in feats)
    return f"{name} AS (SELECT {cols} FROM {src})"


VOTES_SQL = """votes AS (SELECT {split}qk, count(*) FILTER (WHERE ty) AS pos, count(*) AS n
                       FROM nb GROUP BY ALL)"""


@register("knn_predict", with_ctes(fx.ENTITY_SQL, TRAIN_SQL, """
tr AS (SELECT entity_id AS tk, label AS ty, n_orders FROM train)""", """
qu AS (SELECT entity_id AS qk, n_orders FROM entity_features WHERE generation > 6)""",
    _knn_sql("tr", "qu", ["n_orders"], 5), VOTES_SQL.format(split=""), body="""
SELECT e.entity_id, e.generation, e.label, pos * 2 > n AS pred, round(pos / n, 6) AS proba
FROM entity_features e JOIN votes ON e.entity_id = votes.qk"""))
def q_knn_predict(spark, sf_dir):
    from rarelab.operators.knn import KnnModel
    ef = fx.entity_features(spark, sf_dir)
    model = KnnModel(ef.where(F.col("generation") <= 6), ["n_orders"], k=5)
    cohorts = ef.where(F.col("generation") > 6).select("entity_id", "generation", "label", "n_orders")
    return rounded(model.transform(cohorts).select("entity_id", "generation", "label", "pred", "proba"))


def _holdout_cte(seed: int, test_size: float) -> str:
    return f"""ho AS (SELECT *, rn <= (SELECT ceil({test_size} * count(*)) FROM train) AS is_test FROM
      (SELECT *, row_number() OVER (ORDER BY {sql_hash_string(seed, 'entity_id')}, entity_id) AS rn FROM train))"""


@register("knn_holdout_2d", with_ctes(fx.ENTITY_SQL, TRAIN_SQL, _holdout_cte(HOLDOUT_SEED, 0.2), """
tr AS (SELECT entity_id AS tk, label AS ty, n_orders, wins FROM ho WHERE NOT is_test)""", """
qu AS (SELECT entity_id AS qk, n_orders, wins FROM ho WHERE is_test)""",
    _weights_sql("tr", ["n_orders", "wins"]), _knn_sql("tr", "qu", ["n_orders", "wins"], 3, weights="wt"),
    VOTES_SQL.format(split=""), body="""
SELECT ho.entity_id, ho.label, pos * 2 > n AS pred, round(pos / n, 6) AS proba
FROM ho JOIN votes ON ho.entity_id = votes.qk"""))
def q_knn_holdout_2d(spark, sf_dir):
    from rarelab.operators.knn import KnnModel, scaling_weights
    from rarelab.operators.splits import holdout_split
    feats = ["n_orders", "wins"]
    t = holdout_split(_train(spark, sf_dir).select("entity_id", "label", *feats), "entity_id", 0.2, HOLDOUT_SEED)
    train, test = t.where(~F.col("is_test")), t.where(F.col("is_test"))
    model = KnnModel(train, feats, k=3, weights=scaling_weights(train, feats))
    return rounded(model.transform(test).select("entity_id", "label", "pred", "proba"))


@register("knn_embeddings", with_ctes("""
emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label = 9 AS is9 FROM embeddings)""", """
tr AS (SELECT vec_id AS tk, is9 AS ty, x FROM emb)""", """
qu AS (SELECT vec_id AS qk, x FROM emb)""",
    _knn_sql("tr", "qu", ["x"], 5, exclude_self=True, array=True), VOTES_SQL.format(split=""), body="""
SELECT emb.vec_id, emb.is9 AS label, pos * 2 > n AS pred, round(pos / n, 6) AS proba
FROM emb JOIN votes ON emb.vec_id = votes.qk"""))
def q_knn_embeddings(spark, sf_dir):
    from rarelab.operators.knn import knn_neighbors, knn_vote
    from rarelab.sources.tables import read_table
    emb = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label").select(
        "vec_id", "embedding", (F.col("label") == 9).alias("label"))
    nb = knn_neighbors(emb, emb, "embedding", 5, key="vec_id", exclude_self=True)
    votes = knn_vote(nb, "vec_id")
    return rounded(emb.select("vec_id", "label").join(votes, "vec_id").select("vec_id", "label", "pred", "proba"))


# ============================================================ J1, J2 grid search
GRID_KS = list(range(3, 101, 2))


def _cv_sides_sql(n_splits: int, feats: list[str]) -> list[str]:
    f = ", ".join(f"t.{c}" for c in feats)
    return [
        f"""tr AS (SELECT fo.rep * {n_splits} + g.g AS split_id, t.entity_id AS tk, t.label AS ty, {f}
           FROM folds fo JOIN train t ON fo.entity_id = t.entity_id,
                (SELECT unnest(generate_series(0, {n_splits - 1})) AS g) g WHERE g.g <> fo.fold)""",
        f"""qu AS (SELECT fo.rep * {n_splits} + fo.fold AS split_id, t.entity_id AS qk, t.label AS y, {f}
           FROM folds fo JOIN train t ON fo.entity_id = t.entity_id)""",
    ]


GRID_SQL = with_ctes(fx.ENTITY_SQL, TRAIN_SQL, *_fold_ctes(5, 1, None), *_cv_sides_sql(5, ["n_orders"]),
                     _knn_sql("tr", "qu", ["n_orders"], max(GRID_KS), split=True), f"""
cum AS (SELECT split_id, qk, rank AS k,
               sum(CAST(ty AS INTEGER)) OVER (PARTITION BY split_id, qk ORDER BY rank) AS pos FROM nb)""", f"""
acc AS (SELECT c.split_id, k, avg(CAST((2 * pos > k) = q.y AS DOUBLE)) AS accuracy
        FROM cum c JOIN qu q ON c.split_id = q.split_id AND c.qk = q.qk
        WHERE k IN ({', '.join(map(str, GRID_KS))}) GROUP BY c.split_id, k)""", """
grid AS (SELECT CAST(k AS INTEGER) AS k, avg(accuracy) AS mean_test_score, stddev_pop(accuracy) AS std_test_score
         FROM acc GROUP BY k)""", body="{body}")


@register("grid_search_k", GRID_SQL.format(body="""
SELECT k, round(mean_test_score, 6) AS mean_test_score, round(std_test_score, 6) AS std_test_score FROM grid"""))
def q_grid_search_k(spark, sf_dir):
    return rounded(_grid(spark, sf_dir))


@register("best_k", GRID_SQL.format(body="""
SELECT k, round(mean_test_score, 6) AS mean_test_score, round(std_test_score, 6) AS std_test_score
FROM grid ORDER BY mean_test_score DESC, k LIMIT 1"""))
def q_best_k(spark, sf_dir):
    from rarelab.plans.crossval import best_param
    return rounded(best_param(_grid(spark, sf_dir)))


def _grid(spark, sf_dir):
    from rarelab.operators.splits import stratified_folds
    from rarelab.plans.crossval import cv_knn_sweep, grid_summary
    t = _train(spark, sf_dir).select("entity_id", "label", "n_orders")
    folds = stratified_folds(t, "label", "entity_id", 5)
    scores = cv_knn_sweep(folds, 5, ["n_orders"], GRID_KS)
    return grid_summary(scores).select(F.col("k").cast("int").alias("k"), "mean_test_score", "std_test_score")


# ===================================================== resampling
SMOTE_SEED = 42


def _smote_ctes(src: str, ratio: float | None, k: int, seed: int, name: str = "smoted",
                split: bool = False) -> list[str]:
    """SQL twin of :func:`rarelab.operators.resample.smote` on ``src([split_id,]
    entity_id, label, n_orders)``; minority = TRUE."""
    from rarelab.functions.hashing import sql_uniform
    n_new = "n_maj - n_min" if ratio is None else f"CAST(trunc(n_maj * CAST({ratio} AS DOUBLE) - n_min) AS BIGINT)"
    sc = "split_id, " if split else ""
    part = "PARTITION BY split_id " if split else ""
    on = lambda a, b: f"{a}.split_id = {b}.split_id AND " if split else ""
    hparts = ["'draw'"] + (["split_id"] if split else []) + ["j"]
    gparts = ["'gap'"] + (["split_id"] if split else []) + ["j"]
    grp = "GROUP BY split_id" if split else ""
    return [
        f"""cnt_{name} AS (SELECT {sc}count(*) FILTER (WHERE label) AS n_min, count(*) FILTER (WHERE NOT label) AS n_maj
           FROM {src} {grp})""",
        f"""mino_{name} AS (SELECT {sc}entity_id AS k, CAST(n_orders AS DOUBLE) AS x,
                  row_number() OVER ({part}ORDER BY entity_id) - 1 AS i FROM {src} WHERE label)""",
        f"""nn_{name} AS (SELECT {'a.split_id, ' if split else ''}a.k, b.k AS nk,
                  row_number() OVER (PARTITION BY {'a.split_id, ' if split else ''}a.k ORDER BY (a.x - b.x) * (a.x - b.x), b.k) AS r
           FROM mino_{name} a JOIN mino_{name} b ON {on('a', 'b')}a.k <> b.k QUALIFY r <= {k})""",
        f"""syn_{name} AS (SELECT {sc}n_min, unnest(generate_series(0, {n_new} - 1)) AS j FROM cnt_{name})""",
        f"""drawn_{name} AS (SELECT {sc}j, CAST(floor({sql_uniform(seed, *hparts)} * (n_min * {k})) AS BIGINT) AS d,
                   {sql_uniform(seed, *gparts)} AS gap FROM syn_{name})""",
        f"""pts_{name} AS (SELECT {'dr.split_id, ' if split else ''}j, gap, m.x AS bx, n.x AS nx FROM drawn_{name} dr
           JOIN mino_{name} m ON {on('m', 'dr')}m.i = d // {k}
           JOIN nn_{name} nn ON {on('nn', 'm')}nn.k = m.k AND nn.r = d % {k} + 1
           JOIN mino_{name} n ON {on('n', 'nn')}n.k = nn.nk)""",
        f"""{name} AS (SELECT {sc}entity_id, label, CAST(n_orders AS DOUBLE) AS n_orders, FALSE AS is_synthetic FROM {src}
           UNION ALL SELECT {sc}-(j + 1), TRUE, bx + gap * (nx - bx), TRUE FROM pts_{name})""",
    ]


def _under_ctes(src: str, ratio: float, seed: int, name: str = "under", split: bool = False) -> list[str]:
    if split:
        return [f"""keep_{name} AS (SELECT split_id, CAST(trunc(count(*) FILTER (WHERE label) / CAST({ratio} AS DOUBLE)) AS BIGINT) AS n_keep
                    FROM {src} GROUP BY split_id)""",
                f"""{name} AS (SELECT * FROM {src} WHERE label
      UNION ALL
      SELECT * EXCLUDE (rn, n_keep) FROM (
        SELECT s.*, row_number() OVER (PARTITION BY s.split_id ORDER BY {sql_hash_string(seed, 's.split_id', 's.entity_id')}, s.entity_id) AS rn,
               kp.n_keep FROM {src} s JOIN keep_{name} kp ON s.split_id = kp.split_id WHERE NOT s.label)
      WHERE rn <= n_keep)"""]
    return [f"""{name} AS (SELECT * FROM {src} WHERE label
      UNION ALL
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (ORDER BY {sql_hash_string(seed, 'entity_id')}, entity_id) AS rn
        FROM {src} WHERE NOT label)
      WHERE rn <= (SELECT CAST(trunc(count(*) FILTER (WHERE label) / CAST({ratio} AS DOUBLE)) AS BIGINT) FROM {src}))"""]


RESAMPLE_SRC = "src AS (SELECT entity_id, label, n_orders FROM train)"
RESAMPLE_BODY = "SELECT entity_id, label, round(n_orders, 6) AS n_orders, is_synthetic FROM {name}"


def _resample_src(spark, sf_dir):
    return _train(spark, sf_dir).select("entity_id", "label", "n_orders")


@register("smote_balanced", with_ctes(fx.ENTITY_SQL, TRAIN_SQL, RESAMPLE_SRC, *_smote_ctes("src", None, 5, SMOTE_SEED),
                                      body=RESAMPLE_BODY.format(name="smoted")))
def q_smote_balanced(spark, sf_dir):
    from rarelab.operators.resample import smote
    return rounded(smote(_resample_src(spark, sf_dir), ["n_orders"], k=5, seed=SMOTE_SEED))


@register("smote_ratio", with_ctes(fx.ENTITY_SQL, TRAIN_SQL, RESAMPLE_SRC, *_smote_ctes("src", 0.1, 6, SMOTE_SEED),
                                   body=RESAMPLE_BODY.format(name="smoted")))
def q_smote_ratio(spark, sf_dir):
    from rarelab.operators.resample import smote
    return rounded(smote(_resample_src(spark, sf_dir), ["n_orders"], ratio=0.1, k=6, seed=SMOTE_SEED))


@register("undersample", with_ctes(fx.ENTITY_SQL, TRAIN_SQL, """
src AS (SELECT entity_id, label, CAST(n_orders AS DOUBLE) AS n_orders, FALSE AS is_synthetic FROM train)""",
                                   *_under_ctes("src", 0.5, SMOTE_SEED), body=RESAMPLE_BODY.format(name="under")))
def q_undersample(spark, sf_dir):
    from rarelab.operators.resample import undersample
    src = _resample_src(spark, sf_dir).select(
        "entity_id", "label", F.col("n_orders").cast("double").alias("n_orders"), F.lit(False).alias("is_synthetic"))
    return rounded(undersample(src, 0.5, seed=SMOTE_SEED))


@register("over_under", with_ctes(fx.ENTITY_SQL, TRAIN_SQL, RESAMPLE_SRC, *_smote_ctes("src", 0.1, 6, SMOTE_SEED),
                                  *_under_ctes("smoted", 1.0, SMOTE_SEED), body=RESAMPLE_BODY.format(name="under")))
def q_over_under(spark, sf_dir):
    from rarelab.operators.resample import over_under
    return rounded(over_under(_resample_src(spark, sf_dir), ["n_orders"], 0.1, 1.0, k=6, seed=SMOTE_SEED))


# ============================================ cross-validation
CV_SPLITS, CV_REPEATS = 10, 3


def _cv_train_ctes(p: str, resample: tuple | None, feats: tuple) -> tuple[list[str], str]:
    """CTEs of the training rows (resampled per split) and ``qu_{p}``, and the name of the former."""
    S = CV_SPLITS
    fsel = ", ".join(f"t.{f}" for f in feats)
    ctes = [
        f"""tr0_{p} AS (SELECT fo.rep * {S} + g.g AS split_id, t.entity_id, t.label, {fsel}
           FROM folds fo JOIN train t ON fo.entity_id = t.entity_id,
                (SELECT unnest(generate_series(0, {S - 1})) AS g) g WHERE g.g <> fo.fold)""",
        f"""qu_{p} AS (SELECT fo.rep * {S} + fo.fold AS split_id, t.entity_id AS qk, t.label AS y, {fsel}
           FROM folds fo JOIN train t ON fo.entity_id = t.entity_id)""",
    ]
    final = f"tr0_{p}"
    if resample is not None:
        over_ratio, over_k, under_ratio = resample
        ctes += _smote_ctes(f"tr0_{p}", over_ratio, over_k, SMOTE_SEED, name=f"sm_{p}", split=True)
        final = f"sm_{p}"
        if under_ratio is not None:
            ctes += _under_ctes(f"sm_{p}", under_ratio, SMOTE_SEED, name=f"un_{p}", split=True)
            final = f"un_{p}"
    return ctes, final


def _cv_ctes(p: str, k_model: int, resample: tuple | None = None, feats: tuple = ("n_orders",),
             weights: str | None = None) -> list[str]:
    """CTEs ending in ``scores_{p}(split_id, accuracy, roc_auc)`` and
    ``summary_{p}``: kNN on ``n_orders`` over the 10x3 repeated stratified
    splits, with optional per-split (over_ratio, over_k, under_ratio)."""
    ctes, final = _cv_train_ctes(p, resample, feats)
    fplain = ", ".join(feats)
    ctes += [
        f"trk_{p} AS (SELECT split_id, entity_id AS tk, label AS ty, {fplain} FROM {final})",
        _knn_sql(f"trk_{p}", f"qu_{p}", list(feats), k_model, split=True, name=f"nb_{p}", weights=weights),
        f"""votes_{p} AS (SELECT split_id, qk, count(*) FILTER (WHERE ty) AS pos, count(*) AS n FROM nb_{p} GROUP BY ALL)""",
        f"""preds_{p} AS (SELECT q.split_id, q.qk, q.y, pos * 2 > n AS pred, pos / n AS proba
           FROM qu_{p} q JOIN votes_{p} v ON q.split_id = v.split_id AND q.qk = v.qk)""",
    ]
    return ctes + _score_ctes(p)


def _score_ctes(p: str) -> list[str]:
    """``preds_{p}(split_id, y, pred, proba)`` to ``scores_{p}`` and ``summary_{p}``."""
    return [
        f"""ps_{p} AS (SELECT split_id, proba AS score, count(*) FILTER (WHERE y) AS pos,
                  count(*) FILTER (WHERE NOT y) AS neg FROM preds_{p} GROUP BY split_id, proba)""",
        f"""cum_{p} AS (SELECT *, sum(neg) OVER (PARTITION BY split_id ORDER BY score ROWS UNBOUNDED PRECEDING) - neg
                  AS neg_below FROM ps_{p})""",
        f"""auc_{p} AS (SELECT split_id, sum(pos * (neg_below + 0.5 * neg)) / nullif(sum(pos) * sum(neg), 0) AS roc_auc
           FROM cum_{p} GROUP BY split_id)""",
        f"""acc_{p} AS (SELECT split_id, avg(CAST(pred = y AS DOUBLE)) AS accuracy FROM preds_{p} GROUP BY split_id)""",
        f"""scores_{p} AS (SELECT a.split_id, accuracy, roc_auc FROM acc_{p} a JOIN auc_{p} u ON a.split_id = u.split_id)""",
        f"""summary_{p} AS (SELECT avg(accuracy) AS mean_accuracy, stddev_pop(accuracy) AS std_accuracy,
                  avg(roc_auc) AS mean_roc_auc, stddev_pop(roc_auc) AS std_roc_auc FROM scores_{p})""",
    ]


CV_BASE = [fx.ENTITY_SQL, TRAIN_SQL] + _fold_ctes(CV_SPLITS, CV_REPEATS, FOLD_SEED)
SUMMARY_COLS = ("round(mean_accuracy, 6) AS mean_accuracy, round(std_accuracy, 6) AS std_accuracy, "
                "round(mean_roc_auc, 6) AS mean_roc_auc, round(std_roc_auc, 6) AS std_roc_auc")
CV_COLS = SUMMARY_COLS + ", round(1 - mean_accuracy, 6) AS error"


def _cv_folds(spark, sf_dir):
    from rarelab.operators.splits import stratified_folds
    t = _train(spark, sf_dir).select("entity_id", "label", "n_orders")
    return stratified_folds(t, "label", "entity_id", CV_SPLITS, seed=FOLD_SEED, n_repeats=CV_REPEATS)


def _config(resample: tuple) -> dict:
    return dict(zip(("over_ratio", "over_k", "under_ratio"), resample, strict=True))


def _cv_scores(spark, sf_dir, resample=None):
    from rarelab.plans.crossval import cv_knn_scores
    scores = cv_knn_scores(_cv_folds(spark, sf_dir), CV_SPLITS, ["n_orders"], 5, [_config(resample)] if resample else None, SMOTE_SEED)
    return scores.select("split_id", "accuracy", "roc_auc")


@register("cv_scores", with_ctes(*CV_BASE, *_cv_ctes("a", 5), body="""
SELECT CAST(split_id AS INTEGER) AS split_id, round(accuracy, 6) AS accuracy, round(roc_auc, 6) AS roc_auc
FROM scores_a"""))
def q_cv_scores(spark, sf_dir):
    return rounded(_cv_scores(spark, sf_dir))


@register("cv_summary", with_ctes(*CV_BASE, *_cv_ctes("a", 5), body=f"SELECT {CV_COLS} FROM summary_a"))
def q_cv_summary(spark, sf_dir):
    from rarelab.plans.crossval import score_summary
    return rounded(score_summary(_cv_scores(spark, sf_dir)))


@register("smote_cv", with_ctes(*CV_BASE, *_cv_ctes("a", 5, (0.1, 5, 0.5)), body=f"SELECT {CV_COLS} FROM summary_a"))
def q_smote_cv(spark, sf_dir):
    from rarelab.plans.crossval import score_summary
    return rounded(score_summary(_cv_scores(spark, sf_dir, (0.1, 5, 0.5))))


@register("smote_balanced_cv", with_ctes(*CV_BASE, *_cv_ctes("a", 5, (None, 5, None)),
                                         body=f"SELECT {CV_COLS} FROM summary_a"))
def q_smote_balanced_cv(spark, sf_dir):
    from rarelab.plans.crossval import score_summary
    return rounded(score_summary(_cv_scores(spark, sf_dir, (None, 5, None))))


CV_2D = ["n_orders", "wins"]


@register("cv_summary_2d", with_ctes(*CV_BASE, _weights_sql("train", CV_2D),
                                     *_cv_ctes("a", 3, feats=tuple(CV_2D), weights="wt"),
                                     body=f"SELECT {CV_COLS} FROM summary_a"))
def q_cv_summary_2d(spark, sf_dir):
    """I9, I10 with two scaled features (kNN k=3): one blocked search per
    repeat with same-fold pairs masked, no replicated training rows.  The
    scaling weights are fit on all training rows, as the study does."""
    from rarelab.operators.knn import scaling_weights
    from rarelab.operators.splits import stratified_folds
    from rarelab.plans.crossval import cv_knn_predictions, score_summary, split_scores
    t = _train(spark, sf_dir).select("entity_id", "label", *CV_2D)
    folds = stratified_folds(t, "label", "entity_id", CV_SPLITS, seed=FOLD_SEED, n_repeats=CV_REPEATS)
    preds = cv_knn_predictions(folds, CV_SPLITS, CV_2D, 3, weights=scaling_weights(t, CV_2D))
    return rounded(score_summary(split_scores(preds)))


# ------------------------------------------------------------------ sweeps
SWEEPS = {
    # fixed values of the study's sweeps: (param name, values, config builder)
    "sweep_smote_k": [dict(param=k, over_ratio=0.1, over_k=k, under_ratio=0.5) for k in range(1, 11)],
    "sweep_over_ratio": [dict(param=r, over_ratio=r, over_k=6, under_ratio=0.5) for r in (0.1, 0.2, 0.3, 0.4, 0.5)],
    "sweep_under_ratio": [dict(param=r, over_ratio=0.1, over_k=6, under_ratio=r)
                          for r in (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)],
}


def _sweep_sql(configs):
    ctes, bodies = list(CV_BASE), []
    for i, c in enumerate(configs):
        p = f"c{i}"
        ctes += _cv_ctes(p, 5, (c["over_ratio"], c["over_k"], c["under_ratio"]))
        bodies.append(f"SELECT CAST({float(c['param'])} AS DOUBLE) AS param, {SUMMARY_COLS} FROM summary_{p}")
    return with_ctes(*ctes, body="\nUNION ALL\n".join(bodies))


def _sweep_query(name):
    def q(spark, sf_dir):
        from rarelab.plans.crossval import sweep_resampled
        return rounded(sweep_resampled(_cv_folds(spark, sf_dir), CV_SPLITS, ["n_orders"], SWEEPS[name],
                                       model="knn", k=5, seed=SMOTE_SEED))
    q.__name__ = f"q_{name}"
    return q


for _name, _configs in SWEEPS.items():
    register(_name, _sweep_sql(_configs))(_sweep_query(_name))


# ------------------------------------------------------------------- I12
@register("cohort_eval", with_ctes(fx.ENTITY_SQL, TRAIN_SQL, """
tr AS (SELECT entity_id AS tk, label AS ty, n_orders FROM train)""", """
qu AS (SELECT entity_id AS qk, n_orders FROM entity_features WHERE generation > 6)""",
    _knn_sql("tr", "qu", ["n_orders"], 5), VOTES_SQL.format(split=""), """
preds AS (SELECT CAST(e.generation AS VARCHAR) AS cohort, e.label, pos * 2 > n AS pred
          FROM entity_features e JOIN votes ON e.entity_id = votes.qk)""",
    PER_CLASS_SQL.strip().rstrip(","),
    """wprf AS (SELECT cohort, sum(support * precision) / sum(support) AS precision,
                  sum(support * recall) / sum(support) AS recall, sum(support * f1) / sum(support) AS f1
           FROM pc GROUP BY cohort)""", """
acc AS (SELECT cohort, avg(CAST(label = pred AS DOUBLE)) AS accuracy, count(*) AS n FROM preds GROUP BY cohort)""",
    body="""
SELECT a.cohort, round(accuracy, 6) AS accuracy, n, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM acc a JOIN wprf w ON a.cohort = w.cohort"""))
def q_cohort_eval(spark, sf_dir):
    from rarelab.operators import metrics
    from rarelab.operators.knn import KnnModel
    ef = fx.entity_features(spark, sf_dir)
    model = KnnModel(ef.where(F.col("generation") <= 6), ["n_orders"], k=5)
    preds = model.transform(ef.where(F.col("generation") > 6).select(
        "entity_id", F.col("generation").cast("string").alias("cohort"), "label", "n_orders"))
    acc = metrics.accuracy(preds, by="cohort").drop("error")
    return rounded(acc.join(metrics.weighted_prf(preds, by="cohort"), "cohort"))


# ====================================================== logistic (H3-H7)
# The fits have SQL twins: Newton steps unrolled as CTEs, a 2x2 solve each.
NEWTON_STEPS = 14
LOGIT_DIGITS = 4


def _newton_ctes(src: str, name: str) -> list[str]:
    """CTEs ending in ``{name}(g, b0, b1)``: L2 logistic regression (C = 1) of
    ``y`` on ``x`` per group ``g`` of ``src(g, x, y)``; the intercept is not penalised."""
    ctes = [f"data_{name} AS MATERIALIZED (SELECT g, x, CAST(y AS DOUBLE) AS y, count(*) AS n FROM {src} GROUP BY ALL)",
            f"{name}_0 AS (SELECT DISTINCT g, CAST(0 AS DOUBLE) AS b0, CAST(0 AS DOUBLE) AS b1 FROM data_{name})"]
    for i in range(NEWTON_STEPS):
        ctes.append(f"""{name}_{i + 1} AS MATERIALIZED (
          SELECT g, b0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS b0,
                 b1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS b1 FROM (
            SELECT g, b0, b1, sum(n * (p - y)) AS g0, sum(n * (p - y) * x) + b1 AS g1, sum(n * p * (1 - p)) AS h00,
                   sum(n * p * (1 - p) * x) AS h01, sum(n * p * (1 - p) * x * x) + 1 AS h11
            FROM (SELECT d.*, b0, b1, 1 / (1 + exp(-(b0 + b1 * x))) AS p FROM data_{name} d JOIN {name}_{i} t ON d.g = t.g)
            GROUP BY g, b0, b1))""")
    return [*ctes, f"{name} AS (SELECT * FROM {name}_{NEWTON_STEPS})"]


PROBA_SQL = "1 / (1 + exp(-(b0 + b1 * n_orders)))"


def _logit_cv_ctes(p: str, resample: tuple | None = None) -> list[str]:
    """CTEs ending in ``scores_{p}`` and ``summary_{p}`` of the logistic model over the 10x3 splits."""
    ctes, final = _cv_train_ctes(p, resample, ("n_orders",))
    return [*ctes, f"xy_{p} AS (SELECT split_id AS g, n_orders AS x, label AS y FROM {final})", *_newton_ctes(f"xy_{p}", f"th_{p}"),
            f"""preds_{p} AS (SELECT split_id, qk, y, {PROBA_SQL} AS proba, {PROBA_SQL} > 0.5 AS pred
                FROM qu_{p} JOIN th_{p} ON split_id = g)""", *_score_ctes(p)]


ALL_XY = "xy AS (SELECT 0 AS g, n_orders AS x, label AS y FROM train)"
COEF_BODY = f"""
SELECT 'intercept' AS term, round(b0, {LOGIT_DIGITS}) AS coef FROM th UNION ALL SELECT 'n_orders', round(b1, {LOGIT_DIGITS}) FROM th"""


def _inference_sql() -> str:
    """H3: one coefficient without intercept.  The tail of the normal law is
    the classical rational approximation 26.2.17 (error below 7.5e-8)."""
    steps = ["m_0 AS (SELECT CAST(0 AS DOUBLE) AS b)"]
    for i in range(NEWTON_STEPS):
        steps.append(f"""m_{i + 1} AS MATERIALIZED (SELECT b - sum((p - y) * x) / sum(p * (1 - p) * x * x) AS b FROM (
            SELECT x, CAST(y AS DOUBLE) AS y, b, 1 / (1 + exp(-b * x)) AS p FROM xy, m_{i}) GROUP BY b)""")
    last = f"m_{NEWTON_STEPS}"
    return with_ctes(fx.ENTITY_SQL, TRAIN_SQL, ALL_XY, *steps, f"""
    fit AS (SELECT any_value(b) AS b, 1 / sqrt(sum(p * (1 - p) * x * x)) AS se, sum(y * ln(p) + (1 - y) * ln(1 - p)) AS ll,
                   count(*) AS n, avg(y) AS base
            FROM (SELECT x, CAST(y AS DOUBLE) AS y, b, 1 / (1 + exp(-b * x)) AS p FROM xy, {last}))""", """
    tail AS (SELECT *, b / se AS z, 1 / (1 + 0.2316419 * abs(b / se)) AS t,
                    n * (base * ln(base) + (1 - base) * ln(1 - base)) AS ll0 FROM fit)""", body=f"""
SELECT 'n_orders' AS term, round(b, {LOGIT_DIGITS}) AS coef, round(se, {LOGIT_DIGITS}) AS std_err, round(z, {LOGIT_DIGITS}) AS z,
       round(2 * exp(-z * z / 2) / sqrt(2 * pi()) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937
             + t * (-1.821255978 + t * 1.330274429)))), {LOGIT_DIGITS}) AS p_value,
       round(b - 1.959963984540054 * se, {LOGIT_DIGITS}) AS conf_lo, round(b + 1.959963984540054 * se, {LOGIT_DIGITS}) AS conf_hi,
       round(ll, {LOGIT_DIGITS}) AS log_likelihood, round(ll0, {LOGIT_DIGITS}) AS ll_null,
       round(1 - ll / ll0, {LOGIT_DIGITS}) AS pseudo_r2, n AS n_obs FROM tail""")


@register("logit_inference", _inference_sql())
def q_logit_inference(spark, sf_dir):
    from rarelab.operators.logistic import logit_inference
    return rounded(logit_inference(_train(spark, sf_dir), ["n_orders"], fit_intercept=False)[1], LOGIT_DIGITS)


@register("logistic_l2", with_ctes(fx.ENTITY_SQL, TRAIN_SQL, ALL_XY, *_newton_ctes("xy", "th"), body=COEF_BODY))
def q_logistic_l2(spark, sf_dir):
    from rarelab.operators.logistic import fit_logistic
    m = fit_logistic(_train(spark, sf_dir), ["n_orders"])
    return rounded(spark.createDataFrame(m.table(), "term string, coef double"), LOGIT_DIGITS)


@register("logistic_proba", with_ctes(fx.ENTITY_SQL, TRAIN_SQL, ALL_XY, *_newton_ctes("xy", "th"), body=f"""
SELECT entity_id, n_orders, label, round(1 - {PROBA_SQL}, {LOGIT_DIGITS}) AS proba_negative FROM train, th"""))
def q_logistic_proba(spark, sf_dir):
    from rarelab.operators.logistic import fit_logistic
    t = _train(spark, sf_dir)
    m = fit_logistic(t, ["n_orders"])
    return rounded(m.transform(t.select("entity_id", "n_orders", "label")).select(
        "entity_id", "n_orders", "label", "proba_negative"), LOGIT_DIGITS)


@register("logistic_predict", with_ctes(
    fx.ENTITY_SQL, TRAIN_SQL, _holdout_cte(0, 0.1), "xy AS (SELECT 0 AS g, n_orders AS x, label AS y FROM ho WHERE NOT is_test)",
    *_newton_ctes("xy", "th"), body=f"""
SELECT entity_id, generation, label, {PROBA_SQL} > 0.5 AS pred, round({PROBA_SQL}, {LOGIT_DIGITS}) AS proba
FROM entity_features, th WHERE generation > 6"""))
def q_logistic_predict(spark, sf_dir):
    from rarelab.operators.logistic import fit_logistic
    from rarelab.operators.splits import holdout_split
    t = holdout_split(_train(spark, sf_dir), "entity_id", 0.1, 0)
    m = fit_logistic(t.where(~F.col("is_test")), ["n_orders"])
    cohorts = fx.entity_features(spark, sf_dir).where(F.col("generation") > 6)
    return rounded(m.transform(cohorts).select("entity_id", "generation", "label", "pred", "proba"), LOGIT_DIGITS)


# ------------------------------------------- the two final models
# Fixed values of the study: resampling of each final model, fitted on the training part of one holdout.
FINAL_SEED, FINAL_TEST = 0, 0.2
FINAL = {"knn": dict(over_ratio=0.1, over_k=6, under_ratio=1.0), "logistic": dict(over_ratio=0.1, over_k=5, under_ratio=0.7)}


_STORES: dict = {}  # session and state of the source files -> the folder of their models


def _final_split(spark, sf_dir):
    from rarelab.operators.splits import holdout_split
    return holdout_split(_train(spark, sf_dir).select("entity_id", "label", "n_orders"), "entity_id", FINAL_TEST, FINAL_SEED)


def _store(spark, sf_dir, model: str) -> str:
    """The folder that holds the final model, which is fitted and stored at its first use in a session."""
    import uuid
    from rarelab.operators.knn import KnnModel
    from rarelab.operators.logistic import fit_logistic
    from rarelab.operators.model_store import save_model
    from rarelab.operators.resample import over_under
    from rarelab.session import cut_lineage, ensure_checkpoint_dir
    key = (spark.conf.get("spark.app.id", None) or id(spark), fx.source_state(spark, sf_dir))
    root, names = _STORES.setdefault(key, (f"{ensure_checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex}", set()))
    if model not in names:
        c = FINAL[model]
        t = cut_lineage(_final_split(spark, sf_dir))
        fit_on = cut_lineage(over_under(t.where(~F.col("is_test")), ["n_orders"], c["over_ratio"], c["under_ratio"],
                                        k=c["over_k"], seed=SMOTE_SEED))
        fitted = KnnModel(fit_on, ["n_orders"], k=5) if model == "knn" else fit_logistic(fit_on, ["n_orders"])
        save_model(fitted, root, f"final_{model}", 1, spark=spark)
        names.add(model)
    return root


def _later_cohorts(spark, sf_dir):
    return fx.entity_features(spark, sf_dir).where(F.col("generation") > 6).select(
        "entity_id", F.col("generation").cast("string").alias("cohort"), "label", "n_orders")


def _final_predictions(spark, sf_dir, model: str):
    """``(entity_id, cohort, label, pred)`` of the stored model on the holdout's test part and the later cohorts."""
    from rarelab.operators.model_store import load_model
    rows = _final_split(spark, sf_dir).where("is_test").select("entity_id", F.lit("test").alias("cohort"), "label", "n_orders")
    rows = rows.unionByName(_later_cohorts(spark, sf_dir))
    stored = load_model(spark, _store(spark, sf_dir, model), f"final_{model}")
    return stored.transform(rows).select("entity_id", "cohort", "label", "pred")


def _final_ctes(model: str) -> list[str]:
    """CTEs ending in ``fp_{model}(entity_id, cohort, label, pred)``; they start from ``ho``."""
    c = FINAL[model]
    m = model
    ctes = [f"src_{m} AS (SELECT entity_id, label, n_orders FROM ho WHERE NOT is_test)",
            *_smote_ctes(f"src_{m}", c["over_ratio"], c["over_k"], SMOTE_SEED, name=f"over_{m}"),
            *_under_ctes(f"over_{m}", c["under_ratio"], SMOTE_SEED, name=f"fit_{m}"),
            f"""rows_{m} AS (SELECT entity_id AS qk, 'test' AS cohort, label, n_orders FROM ho WHERE is_test UNION ALL
                SELECT entity_id, CAST(generation AS VARCHAR), label, n_orders FROM entity_features WHERE generation > 6)"""]
    if model == "knn":
        return [*ctes, f"trk_{m} AS (SELECT entity_id AS tk, label AS ty, n_orders FROM fit_{m})",
                _knn_sql(f"trk_{m}", f"rows_{m}", ["n_orders"], 5, name=f"nb_{m}"),
                f"""fp_{m} AS (SELECT r.qk AS entity_id, cohort, label, pos * 2 > n AS pred FROM rows_{m} r JOIN (
                    SELECT qk, count(*) FILTER (WHERE ty) AS pos, count(*) AS n FROM nb_{m} GROUP BY qk) v ON r.qk = v.qk)"""]
    return [*ctes, f"xy_{m} AS (SELECT 0 AS g, n_orders AS x, label AS y FROM fit_{m})", *_newton_ctes(f"xy_{m}", f"th_{m}"),
            f"fp_{m} AS (SELECT qk AS entity_id, cohort, label, {PROBA_SQL} > 0.5 AS pred FROM rows_{m}, th_{m})"]


FINAL_BASE = [fx.ENTITY_SQL, TRAIN_SQL, _holdout_cte(FINAL_SEED, FINAL_TEST)]
REPORT_CTES = [
    PER_CLASS_SQL.strip().rstrip(","),
    """wprf AS (SELECT cohort, sum(support * precision) / sum(support) AS precision,
                  sum(support * recall) / sum(support) AS recall, sum(support * f1) / sum(support) AS f1
           FROM pc GROUP BY cohort)""",
    "acc AS (SELECT cohort, avg(CAST(label = pred AS DOUBLE)) AS accuracy, count(*) AS n FROM preds GROUP BY cohort)"]
REPORT_BODY = """
SELECT a.cohort, round(accuracy, 6) AS accuracy, round(1 - accuracy, 6) AS error, n, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1 FROM acc a JOIN wprf w ON a.cohort = w.cohort"""
CONFUSION_BODY = """
SELECT g.cohort, g.actual, g.predicted, coalesce(c.n, 0) AS count FROM (
  SELECT a.cohort, a.cls AS actual, b.cls AS predicted FROM
    (SELECT DISTINCT cohort, label AS cls FROM preds UNION SELECT DISTINCT cohort, pred FROM preds) a JOIN
    (SELECT DISTINCT cohort, label AS cls FROM preds UNION SELECT DISTINCT cohort, pred FROM preds) b ON a.cohort = b.cohort) g
LEFT JOIN (SELECT cohort, label, pred, count(*) AS n FROM preds GROUP BY ALL) c
  ON g.cohort = c.cohort AND g.actual = c.label AND g.predicted = c.pred"""


def _report(preds):
    from rarelab.operators import metrics
    from rarelab.session import cut_lineage
    preds = cut_lineage(preds)
    return rounded(metrics.accuracy(preds, by="cohort").join(metrics.weighted_prf(preds, by="cohort"), "cohort"))


def _final_queries(model: str) -> None:
    preds = [*FINAL_BASE, *_final_ctes(model), f"preds AS (SELECT * FROM fp_{model})"]

    @register(f"final_{model}_metrics", with_ctes(*preds, *REPORT_CTES, body=REPORT_BODY))
    def metrics_query(spark, sf_dir):
        return _report(_final_predictions(spark, sf_dir, model))

    @register(f"final_{model}_confusion", with_ctes(*preds, body=CONFUSION_BODY))
    def confusion_query(spark, sf_dir):
        from rarelab.operators.metrics import confusion_counts
        return confusion_counts(_final_predictions(spark, sf_dir, model), by="cohort")


for _model in FINAL:
    _final_queries(_model)


def _both_final(spark, sf_dir):
    cohort = F.col("cohort") != "test"
    knn = _final_predictions(spark, sf_dir, "knn").where(cohort).select(
        "entity_id", F.col("cohort").cast("int").alias("generation"), "label", F.col("pred").alias("knn_pred"))
    lr = _final_predictions(spark, sf_dir, "logistic").where(cohort).select("entity_id", F.col("pred").alias("logit_pred"))
    return knn.join(lr, "entity_id")


BOTH_CTES = [*FINAL_BASE, *_final_ctes("knn"), *_final_ctes("logistic"), """
both_fits AS (SELECT k.entity_id, CAST(k.cohort AS INTEGER) AS generation, k.label, k.pred AS knn_pred, l.pred AS logit_pred
              FROM fp_knn k JOIN fp_logistic l ON k.entity_id = l.entity_id WHERE k.cohort <> 'test' AND l.cohort <> 'test')"""]


@register("resampled_fit", with_ctes(*BOTH_CTES, body="SELECT * FROM both_fits"))
def q_resampled_fit(spark, sf_dir):
    """H7: the two final models' predictions on the later cohorts side by side."""
    return _both_final(spark, sf_dir)


@register("stored_model_cohorts", with_ctes(*BOTH_CTES, body="""
SELECT 'final_knn' AS model, 1 AS version, generation, entity_id, label, knn_pred AS pred FROM both_fits UNION ALL
SELECT 'final_logistic', 1, generation, entity_id, label, logit_pred FROM both_fits"""))
def q_stored_model_cohorts(spark, sf_dir):
    """Cohorts 7 and 8 scored by the models as they are stored, each read by its name."""
    from rarelab.operators.model_store import load_model
    out = []
    for model in FINAL:
        stored = load_model(spark, _store(spark, sf_dir, model), f"final_{model}")
        scored = stored.transform(_later_cohorts(spark, sf_dir))
        out.append(scored.select(F.lit(stored.row["name"]).alias("model"), F.lit(stored.row["version"]).alias("version"),
                                 F.col("cohort").cast("int").alias("generation"), "entity_id", "label", "pred"))
    return out[0].unionByName(out[1])


@register("model_table", with_ctes(*FINAL_BASE, *_final_ctes("knn"), *_final_ctes("logistic"), body=f"""
SELECT 'final_knn' AS model, 1 AS version, 'knn' AS kind, 5 AS k, count(*) AS n_rows, CAST(NULL AS DOUBLE) AS intercept,
       CAST(NULL AS DOUBLE) AS coef FROM fit_knn UNION ALL
SELECT 'final_logistic', 1, 'logistic', NULL, NULL, round(b0, {LOGIT_DIGITS}), round(b1, {LOGIT_DIGITS}) FROM th_logistic"""))
def q_model_table(spark, sf_dir):
    """The stored models' own table: kind, parameters and the size of the training rows referred to."""
    from rarelab.operators.model_store import stored_models
    for model in FINAL:
        root = _store(spark, sf_dir, model)
    return rounded(stored_models(spark, root).select(F.col("name").alias("model"), "version", "kind", "k", "n_rows", "intercept",
                                                     F.get("coefficients", F.lit(0)).alias("coef")), LOGIT_DIGITS)


@register("knn_logit_agreement", with_ctes(*BOTH_CTES, body="""
SELECT generation AS cohort, knn_pred, logit_pred, count(*) AS count FROM both_fits GROUP BY ALL"""))
def q_knn_logit_agreement(spark, sf_dir):
    """Do the resampled kNN and logistic models predict the same on the
    later cohorts?  Joint counts per cohort."""
    return _both_final(spark, sf_dir).groupBy(F.col("generation").alias("cohort"), "knn_pred", "logit_pred").agg(
        F.count(F.lit(1)).alias("count"))


LOGIT_CV = {"logistic_cv": None, "logistic_smote_cv": (0.1, 5, 0.5), "logistic_balanced_cv": (None, 5, None)}


def _logit_cv_query(name: str, resample: tuple | None) -> None:
    @register(name, with_ctes(*CV_BASE, *_logit_cv_ctes("a", resample), body=f"SELECT {CV_COLS} FROM summary_a"))
    def q(spark, sf_dir):
        from rarelab.plans.crossval import cv_logistic_scores, score_summary
        configs = [_config(resample)] if resample else None
        return rounded(score_summary(cv_logistic_scores(_cv_folds(spark, sf_dir), CV_SPLITS, ["n_orders"], configs, SMOTE_SEED)))


for _name, _resample in LOGIT_CV.items():
    _logit_cv_query(_name, _resample)


# J3-J5 for logistic regression (batched Newton over every config x split).
# The model is an argument, so the under-sampling sweep really fits the
# logistic model.  Over-sampling keeps its default k = 5 here.
LOGISTIC_SWEEPS = {
    "logistic_sweep_smote_k": [dict(param=k, over_ratio=0.1, over_k=k, under_ratio=0.5) for k in range(1, 8)],
    "logistic_sweep_over_ratio": [dict(param=r, over_ratio=r, over_k=5, under_ratio=0.5)
                                  for r in (0.1, 0.2, 0.3, 0.4, 0.5)],
    "logistic_sweep_under_ratio": [dict(param=r, over_ratio=0.1, over_k=5, under_ratio=r)
                                   for r in (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)],
}


def _logit_sweep_sql(configs) -> str:
    ctes, bodies = list(CV_BASE), []
    for i, c in enumerate(configs):
        ctes += _logit_cv_ctes(f"c{i}", (c["over_ratio"], c["over_k"], c["under_ratio"]))
        bodies.append(f"SELECT CAST({float(c['param'])} AS DOUBLE) AS param, {SUMMARY_COLS} FROM summary_c{i}")
    return with_ctes(*ctes, body="\nUNION ALL\n".join(bodies))


def _logistic_sweep_query(name):
    def q(spark, sf_dir):
        from rarelab.plans.crossval import sweep_resampled
        return rounded(sweep_resampled(_cv_folds(spark, sf_dir), CV_SPLITS, ["n_orders"], LOGISTIC_SWEEPS[name],
                                       model="logistic", seed=SMOTE_SEED))
    q.__name__ = f"q_{name}"
    return q


for _name, _configs in LOGISTIC_SWEEPS.items():
    register(_name, _logit_sweep_sql(_configs))(_logistic_sweep_query(_name))
