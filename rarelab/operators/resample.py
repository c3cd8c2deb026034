"""Class rebalancing on training rows (inventory G4-G7).

* :func:`smote` - synthetic minority over-sampling.  Synthetic point ``j``
  draws ``d = floor(u(seed, 'draw', j) * n_min * k)``: base row ``d div k`` of
  the minority (dense index in key order), neighbour ``d mod k + 1`` of that
  row's k nearest minority rows, and lands at
  ``base + u(seed, 'gap', j) * (neighbour - base)``.
* :func:`undersample` - random under-sampling of the majority without
  replacement: the rows with the lowest ``md5(seed:split:key)`` are kept.

Both work per ``split`` (cross-validation splits are independent problems)
and are deterministic functions of (seed, split, key).  Target sizes follow
the float ``sampling_strategy`` of the usual Python library: over-sampling
adds ``int(n_maj * ratio - n_min)`` rows, under-sampling keeps
``int(n_min / ratio)`` majority rows; impossible targets raise.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarelab.functions.hashing import hash_string, uniform
from rarelab.operators.cuts import before_cut, hash_cuts
from rarelab.operators.knn import knn_neighbors
from rarelab.operators.ordered import running_sum
from rarelab.session import cut_lineage

CHUNK = 10_000  # synthetic rows that one row of the plan expands to


def _split_list(split):
    return [split] if isinstance(split, str) else list(split or [])


def _on_split(df: DataFrame, table: DataFrame, split: list[str]) -> DataFrame:
    """Per-split parameters beside the rows of their split.  Without split
    columns the table has one row for each configuration that the caller lists."""
    if split:
        return df.join(table, split)
    rows = [F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in table.schema]) for r in table.collect()]
    return df.select("*", F.inline(F.array(*rows)))


def class_counts(df: DataFrame, label: str, split: list[str], key: str | None = None) -> tuple[DataFrame, object, object]:
    """``(split..., n_min, n_maj)`` as a table, the minority and the majority
    class.  Every split must have the same two classes and the same minority;
    with ``key``, keys must leave the negative numbers to synthetic rows."""
    per_class = cut_lineage(df.groupBy(*split, label).agg(F.count(F.lit(1)).alias("n")))
    name = F.struct("n", F.col(label).cast("string").alias("t"), F.col(label).alias("c"))
    table = per_class.groupBy(*split).agg(F.count(F.lit(1)).alias("classes"), F.min(name).alias("lo"), F.max(name).alias("hi"))
    wrong = table.where("classes <> 2").select(*split, "classes").first()
    if wrong is not None:
        raise ValueError(f"split {tuple(wrong[c] for c in split)}: resampling needs exactly two classes, got {wrong['classes']}")
    pairs = table.select(F.col("lo.c").alias("lo"), F.col("hi.c").alias("hi")).distinct().limit(2).collect()
    if len(pairs) > 1:
        raise ValueError("the minority class differs between splits")
    if not pairs:
        raise ValueError("resampling needs rows")
    if key is not None and isinstance(df.schema[key].dataType, T.NumericType) and df.where(F.col(key) < 0).limit(1).count():
        raise ValueError(f"{key} has negative values, which number the synthetic rows")
    out = cut_lineage(table.select(*split, F.col("lo.n").alias("n_min"), F.col("hi.n").alias("n_maj")))
    return out, pairs[0]["lo"], pairs[0]["hi"]


def _refuse(table: DataFrame, bad, split: list[str], message: str) -> None:
    row = table.where(bad).first()
    if row is not None:
        raise ValueError(f"split {tuple(row[c] for c in split)}: {message} ({row.asDict()})")


def _numbered(plan: DataFrame) -> DataFrame:
    """Each plan row once for every ``__j`` in ``0 .. n_new - 1``.  Large counts
    are cut into chunks that are dealt out before they expand."""
    chunks = plan.where("n_new > 0").withColumn("__c", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("n_new") - 1, F.lit(CHUNK).cast("bigint"))))
    # a number of partitions of its own: Spark would put so few small rows into one task
    dealt = chunks.repartition(int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*chunks.columns))
    return dealt.withColumn("__j", F.explode(F.sequence(
        F.col("__c"), F.least(F.col("__c") + F.lit(CHUNK - 1), F.col("n_new") - 1)))).drop("__c")


def smote(df: DataFrame, features: list[str], label: str = "label", key: str = "entity_id",
          ratio: float | None = None, k: int = 5, seed: int = 42, split=None,
          weights=None, neighbors: DataFrame | None = None) -> DataFrame:
    """G4 (``ratio=None``: balance), G5 (float ratio, chosen k).

    Returns ``(split..., key, label, features (double)..., is_synthetic)``:
    the input rows plus synthetic minority rows with negative keys.
    ``neighbors`` - a precomputed list of depth >= k (see :func:`minority_neighbors`),
    shared by sweeps over k and ratios."""
    split = _split_list(split)
    df = cut_lineage(df.select(*split, key, label, *features))
    counts, mino, _ = class_counts(df, label, split, key)
    target = F.col("n_maj").cast("double") if ratio is None else F.col("n_maj") * F.lit(float(ratio))
    plan = counts.withColumn("n_new", (target - F.col("n_min")).cast("bigint"))
    _refuse(plan, F.col("n_new") < 0, split, f"ratio {ratio} would remove minority rows")
    _refuse(plan, F.col("n_min") - 1 < k, split, f"k={k} needs at least {k + 1} minority rows")
    feats = [F.col(f).cast("double").alias(f) for f in features]
    base = df.select(*split, key, label, *feats)
    original = base.withColumn("is_synthetic", F.lit(False))
    minority = base.where(F.col(label) == F.lit(mino))
    if neighbors is None:
        neighbors = minority_neighbors(df, features, k, label, key, split, weights, mino)
    bases = minority_bases(minority, neighbors, features, key, split)
    synthetic = synthetic_points(plan.withColumn("__k", F.lit(k)), bases, split, seed)
    return original.unionByName(synthetic.select(
        *split, (-(F.col("__j") + 1)).cast(df.schema[key].dataType).alias(key),
        F.lit(mino).cast(df.schema[label].dataType).alias(label),
        *[F.col("__point")[i].alias(f) for i, f in enumerate(features)], F.lit(True).alias("is_synthetic")))


def minority_bases(minority: DataFrame, neighbors: DataFrame, features: list[str], key: str, split: list[str]) -> DataFrame:
    """``(split..., __i, __base, __near)``: the minority rows numbered in key order, with their own features and
    those of their nearest minority rows, nearest first."""
    indexed = running_sum(minority.withColumn("__one", F.lit(1).cast("bigint")), split, [key], ["__one"],
                          materialize=False).select(*split, key, (F.col("cum___one") - 1).alias("__i"),
                                                    F.array(*features).alias("__base"))
    return indexed.join(neighbors, [*split, key]).select(
        *split, "__i", "__base", F.transform("neighbors", lambda n: n["neighbor_label"]).alias("__near"))


def synthetic_points(plan: DataFrame, bases: DataFrame, split: list[str], seed: int) -> DataFrame:
    """The columns of ``plan`` but the counts, ``__j`` and ``__point``: each row of ``plan`` - ``(split..., n_min, n_new, __k)`` and
    others - gets the points ``0 .. n_new - 1``.  A draw meets its base row, which brings its neighbours
    along, in one join on (split, index)."""
    syn = _numbered(plan)
    draw = F.floor(uniform(seed, F.lit("draw"), *split, "__j") * (F.col("n_min") * F.col("__k"))).cast("bigint")
    syn = syn.withColumns({"__d": draw, "__gap": uniform(seed, F.lit("gap"), *split, "__j")})
    syn = syn.withColumns({"__i": F.floor(F.col("__d") / F.col("__k")).cast("bigint"),
                           "__r": F.pmod(F.col("__d"), F.col("__k")).cast("int")})
    near = F.get(F.col("__near"), F.col("__r"))
    point = F.zip_with("__base", near, lambda b, n: b + F.col("__gap") * (n - b))
    # Spark takes the exploded counts for a few rows: neither side may be sent to every task
    pts = syn.join(bases.hint("merge"), [*split, "__i"]).withColumn("__point", point)
    return pts.drop("n_min", "n_maj", "n_new", "__k", "__d", "__gap", "__i", "__r", "__base", "__near")


def minority_neighbors(df: DataFrame, features: list[str], k: int, label: str = "label",
                       key: str = "entity_id", split=None, weights=None, minority=None) -> DataFrame:
    """``(split..., key, neighbors)``: the k nearest other minority rows of every minority row, per split, as an
    array of ``(neighbor_key, neighbor_label, distance)`` whose ``neighbor_label`` holds the neighbour's features."""
    split = _split_list(split)
    if minority is None:
        minority = class_counts(df, label, split)[1]
    feats = [F.col(f).cast("double").alias(f) for f in features]
    m = df.where(F.col(label) == F.lit(minority)).select(*split, key, *feats).withColumn("__features", F.array(*features))
    return knn_neighbors(m, m, features, k, key=key, label="__features", split=split, weights=weights,
                         exclude_self=True, as_arrays=True)


def undersample(df: DataFrame, ratio: float, label: str = "label", key: str = "entity_id",
                seed: int = 42, split=None) -> DataFrame:
    """Keep ``int(n_min / ratio)`` majority rows per split (lowest hash
    first); minority rows are untouched.  Keeps every input column."""
    split = _split_list(split)
    df = cut_lineage(df)
    counts, _, maj = class_counts(df, label, split)
    keep = counts.withColumn("__keep", (F.col("n_min") / F.lit(float(ratio))).cast("bigint"))
    _refuse(keep, F.col("__keep") > F.col("n_maj"), split, f"ratio {ratio} needs more majority rows than there are")
    majority = df.where(F.col(label) == F.lit(maj)).withColumn("__h", F.md5(hash_string(seed, *split, key)))
    cuts = hash_cuts(majority.select(*split, "__h", F.col(key).alias("__k")), split,
                     keep.select(*split, F.col("n_maj").alias("n"), F.col("__keep").alias("take")))
    kept = _cut_rows(majority, cuts, key, split).select(*df.columns)
    return df.where(F.col(label) != F.lit(maj)).unionByName(kept)


def _cut_rows(rows: DataFrame, cuts: DataFrame, key: str, split: list[str]) -> DataFrame:
    """The rows before their split's cut."""
    if not split:
        one = cuts.first()
        return rows.where(before_cut(F.col("__h"), F.col(key), F.lit(one["__cut_h"]), F.lit(one["__cut_k"])) if one else F.lit(False))
    return rows.join(cuts, split).where(before_cut(F.col("__h"), F.col(key), F.col("__cut_h"), F.col("__cut_k")))


def over_under(df: DataFrame, features: list[str], over_ratio: float, under_ratio: float,
               label: str = "label", key: str = "entity_id", k: int = 5, seed: int = 42,
               split=None, weights=None) -> DataFrame:
    """SMOTE to ``over_ratio`` then under-sample to ``under_ratio``, on
    training rows only."""
    over = smote(df, features, label, key, over_ratio, k, seed, split, weights)
    return undersample(over, under_ratio, label, key, seed, split)


def resample_grid(df: DataFrame, features: list[str], configs: list[dict], label: str = "label",
                  key: str = "entity_id", seed: int = 42, split=None, config_col: str = "config",
                  neighbors: DataFrame | None = None) -> DataFrame:
    """Many resampling configurations at once, keyed by ``(config, split...)``.

    ``configs``: ``{"over_ratio": r or None (balance), "over_k": k,
    "under_ratio": r or None}`` per config id (list position).  Rows equal
    those of :func:`smote` then :func:`undersample` run per configuration:
    the draws hash (seed, split, j) and the under-sampling order hashes
    (seed, split, key), neither depends on the configuration.  The minority
    index, the neighbour list (at the largest k) and the majority ranking are
    computed once per split; only synthetic and kept rows are produced per
    configuration."""
    split = _split_list(split)
    df = cut_lineage(df.select(*split, key, label, *[F.col(f).cast("double").alias(f) for f in features]))
    counts, mino, maj = class_counts(df, label, split, key)
    max_k = max(c.get("over_k", 5) for c in configs)
    listed = F.array(*[F.struct(  # the caller's list of configurations
        F.lit(i).alias(config_col), F.lit(c.get("over_ratio")).cast("double").alias("__over"),
        F.lit(int(c.get("over_k", 5))).cast("bigint").alias("__k"), F.lit(c.get("under_ratio")).cast("double").alias("__under"))
        for i, c in enumerate(configs)])
    target = F.coalesce(F.col("n_maj") * F.col("__over"), F.col("n_maj").cast("double"))
    plan = counts.select("*", F.inline(listed)).withColumn("n_new", (target - F.col("n_min")).cast("bigint"))
    plan = cut_lineage(plan.withColumn("__keep", F.coalesce(
        ((F.col("n_min") + F.col("n_new")) / F.col("__under")).cast("bigint"), F.col("n_maj"))))
    gcols = [config_col] + split
    _refuse(plan, F.col("n_new") < 0, gcols, "the over-sampling ratio would remove minority rows")
    _refuse(plan, F.col("n_min") - 1 < F.col("__k"), gcols, "k needs more minority rows")
    _refuse(plan, F.col("__keep") > F.col("n_maj"), gcols, "the under-sampling ratio cannot be met")

    minority = df.where(F.col(label) == F.lit(mino))
    if neighbors is None:
        neighbors = minority_neighbors(df, features, max_k, label, key, split, None, mino)
    bases = minority_bases(minority, neighbors, features, key, split)
    points = synthetic_points(plan.select(*gcols, "n_min", "n_new", "__k"), bases, split, seed)
    synthetic = points.select(
        *gcols, (-(F.col("__j") + 1)).cast(df.schema[key].dataType).alias(key),
        F.lit(mino).cast(df.schema[label].dataType).alias(label),
        *[F.col("__point")[i].alias(f) for i, f in enumerate(features)], F.lit(True).alias("is_synthetic"))

    # the hash order of a split's majority is the same for all configurations; each has its own cut
    majority = df.where(F.col(label) == F.lit(maj)).withColumn("__h", F.md5(hash_string(seed, *split, key)))
    every = majority.withColumn(config_col, F.explode(F.sequence(F.lit(0), F.lit(len(configs) - 1))))
    cuts = hash_cuts(every.select(*gcols, "__h", F.col(key).alias("__k")), gcols,
                     plan.select(*gcols, F.col("n_maj").alias("n"), F.col("__keep").alias("take")))
    kept = _cut_rows(every, cuts, key, gcols).select(*gcols, key, label, *features, F.lit(False).alias("is_synthetic"))
    originals = minority.withColumn(config_col, F.explode(F.sequence(F.lit(0), F.lit(len(configs) - 1)))).select(
        *gcols, key, label, *features, F.lit(False).alias("is_synthetic"))
    return originals.unionByName(kept).unionByName(synthetic)


def _fold_plan(folds: DataFrame, n_splits: int, configs: list[dict], label: str) -> tuple[list[dict], object, object]:
    """What every (configuration, split) of repeated folds needs, from one count per (repeat, fold, class): rows
    of the caller's own splits and configurations.  Refuses as :func:`resample_grid` does."""
    counts: dict[int, dict[int, dict]] = {}
    for r in folds.groupBy("repeat", "fold", label).agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault(r["repeat"], {}).setdefault(r["fold"], {})[r[label]] = r["n"]
    plan, order = [], set()
    for repeat, of_fold in sorted(counts.items()):
        for fold in range(n_splits):
            split = repeat * n_splits + fold
            total: dict = {}
            for f, classes in of_fold.items():
                for c, n in classes.items():
                    total[c] = total.get(c, 0) + (n if f != fold else 0)
            classes = sorted((n, str(c), c) for c, n in total.items() if n)
            if len(classes) != 2:
                raise ValueError(f"split {split}: resampling needs exactly two classes, got {len(classes)}")
            (n_min, _, mino), (n_maj, _, maj) = classes
            order.add((mino, maj))
            for i, c in enumerate(configs):
                over, under, k = c.get("over_ratio"), c.get("under_ratio"), int(c.get("over_k", 5))
                n_new = int((float(n_maj) if over is None else n_maj * float(over)) - n_min)
                if n_new < 0:
                    raise ValueError(f"split {split}: the over-sampling ratio would remove minority rows")
                if n_min - 1 < k:
                    raise ValueError(f"split {split}: k needs more minority rows")
                take = n_maj if under is None else int((n_min + n_new) / float(under))
                if take > n_maj:
                    raise ValueError(f"split {split}: the under-sampling ratio cannot be met")
                plan.append({"config": i, "repeat": repeat, "split_id": split, "n_min": n_min, "n_maj": n_maj, "n_new": n_new,
                             "take": take, "__k": k})
    if len(order) > 1:
        raise ValueError("the minority class differs between splits")
    if not order:
        raise ValueError("resampling needs rows")
    return plan, *order.pop()


def resampled_members(folds: DataFrame, n_splits: int, features: list[str], configs: list[dict], label: str = "label",
                      key: str = "entity_id", seed: int = 42) -> DataFrame:
    """The training rows of every (configuration, split) of repeated folds without copies of rows:
    ``(repeat, key, label, features (double)..., __in)``.

    ``folds``: ``(repeat, fold, key, label, features...)``.  ``__in`` lists what a row trains for, as
    ``config * n_splits + fold``: a minority row for every fold but its own, a majority row for those whose
    under-sampling keeps it, a synthetic row (negative key) for one.  Per member the rows are those
    of :func:`resample_grid` on the copied training rows: minority rows are indexed by one running count per
    repeat, less the rows of the fold that is left out; the hash cut of every split is found by
    :func:`rarelab.operators.cuts.hash_cuts`; only minority keys are read once for each split, where draws meet them."""
    folds = cut_lineage(folds.select("repeat", "fold", key, label, *[F.col(f).cast("double").alias(f) for f in features]))
    if isinstance(folds.schema[key].dataType, T.NumericType) and folds.where(F.col(key) < 0).limit(1).count():
        raise ValueError(f"{key} has negative values, which number the synthetic rows")
    plan, mino, maj = _fold_plan(folds, n_splits, configs, label)
    spark = folds.sparkSession
    plan = spark.createDataFrame([tuple(p.values()) for p in plan], "config int, repeat int, split_id int, n_min bigint, "
                                 "n_maj bigint, n_new bigint, take bigint, __k int")
    every_fold = F.sequence(F.lit(0), F.lit(n_splits - 1))
    others = F.filter(every_fold, lambda f: f != F.col("fold"))

    # The minority of a split is the repeat's without one fold; so is its order
    minority = folds.where(F.col(label) == F.lit(mino))
    one = {f"__f{f}": (F.col("fold") == F.lit(f)).cast("bigint") for f in range(n_splits)}
    placed = running_sum(minority.withColumns({**one, "__one": F.lit(1).cast("bigint")}), ["repeat"], [key], ["__one", *one],
                         materialize=False)
    before = F.array(*[F.col(f"cum_{f}") for f in one])
    placed = cut_lineage(placed.select("repeat", "fold", key, *features, F.array(*features).alias("__features"),
                                       (F.col("cum___one") - 1).alias("__at"), before.alias("__before")))
    max_k = max(int(c.get("over_k", 5)) for c in configs)
    asks = placed.select("repeat", key, *features, "__at", "__before", "__features", F.explode(others).alias("of"))
    asks = asks.withColumn("__pair", F.concat_ws(":", "of", key))
    near = knn_neighbors(placed, asks.withColumn("fold", F.col("of")), features, max_k + 1, key=key, label="__features",
                         query_key="__pair", split="repeat", exclude_col="fold", as_arrays=True)
    split_id = (F.col("repeat") * n_splits + F.col("of")).cast("int").alias("split_id")
    bases = asks.join(near, ["repeat", "__pair"]).select(
        split_id, (F.col("__at") - F.element_at("__before", F.col("of") + 1)).alias("__i"), F.col("__features").alias("__base"),
        F.transform(F.filter("neighbors", lambda n: n["neighbor_key"] != F.col(key)), lambda n: n["neighbor_label"]).alias("__near"))
    points = synthetic_points(plan.drop("take"), bases, ["split_id"], seed)
    member = lambda config, fold: (config * F.lit(n_splits) + fold).cast("int")
    synthetic = points.select("repeat", (-(F.col("__j") + 1)).cast(folds.schema[key].dataType).alias(key),
                              F.lit(mino).cast(folds.schema[label].dataType).alias(label),
                              *[F.col("__point")[i].alias(f) for i, f in enumerate(features)],
                              F.array(member(F.col("config"), F.col("split_id") % n_splits)).alias("__in"))

    # One cut per (configuration, split); a row asks each whether it comes before it
    majority = folds.where(F.col(label) == F.lit(maj))
    listed = F.sequence(F.lit(0), F.lit(len(configs) - 1))
    hashed = majority.select("repeat", key, F.explode(others).alias("of"))
    hashed = hashed.select(split_id, F.col(key).alias("__k")).withColumn("__h", F.md5(hash_string(seed, "split_id", "__k")))
    full = plan.groupBy("config").agg(F.min(F.col("take") == F.col("n_maj")).alias("all"))
    if full.where("NOT all").isEmpty():  # nothing is under-sampled
        kept = majority.withColumn("__in", F.flatten(F.transform(listed, lambda c: F.transform(others, lambda f: member(c, f)))))
    else:
        groups = ["config", "split_id"]
        cuts = hash_cuts(hashed, groups, plan.select(*groups, F.col("n_maj").alias("n"), "take"), ["split_id"])
        # at most n_splits * configs structs a repeat; a row is hashed once for each fold
        table = cuts.groupBy("split_id").agg(F.collect_list(F.struct("config", "__cut_h", "__cut_k")).alias("cuts"))
        table = table.groupBy(F.floor(F.col("split_id") / n_splits).cast("int").alias("repeat")).agg(
            F.collect_list(F.struct((F.col("split_id") % n_splits).alias("of"), "split_id", "cuts")).alias("__cuts"))
        own = F.transform(F.filter("__cuts", lambda c: c["of"] != F.col("fold")), lambda c: F.struct(
            c["of"].alias("of"), c["cuts"].alias("cuts"),
            F.md5(F.concat_ws(":", F.lit(str(seed)), c["split_id"].cast("string"), F.col(key).cast("string"))).alias("h")))
        stays = F.transform(own, lambda s: F.transform(
            F.filter(s["cuts"], lambda c: before_cut(s["h"], F.col(key), c["__cut_h"], c["__cut_k"])), lambda c: member(c["config"], s["of"])))
        # one row per repeat: joined by key, as many tasks as there are repeats would hash all rows
        kept = majority.join(F.broadcast(table), "repeat").withColumn("__in", F.flatten(stays))
        kept = kept.where(F.size("__in") > 0)
    original = folds.where(F.col(label) == F.lit(mino)).withColumn(
        "__in", F.flatten(F.transform(listed, lambda c: F.transform(others, lambda f: member(c, f)))))
    names = ["repeat", key, label, *features, "__in"]
    return original.select(*names).unionByName(kept.select(*names)).unionByName(synthetic.select(*names))
