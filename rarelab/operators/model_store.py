"""Fitted models as tables in shared storage, written once and read by name and version.

A model is a folder ``<root>/<name>/v<version>`` of Parquet: ``model`` with one
row - kind, features, coefficients or k and weights, the scaler's statistics -
and, for neighbour models, ``rows`` with the training rows that it refers to.
``model`` is written last, so a model that can be seen is complete.  Cohorts are
scored from the stored model, in whatever session, without another fit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rarelab.operators.features import ScalerModel
from rarelab.operators.knn import KnnModel
from rarelab.operators.logistic import LogisticModel

_ROW = ("name string, version int, kind string, features array<string>, coefficients array<double>, intercept double, k int, "
        "weights array<double>, key string, label string, n_rows bigint, scaled array<string>, means array<double>, "
        "stds array<double>")


def _folder(root: str, name: str, version: int) -> str:
    if not name or any(c in name for c in "/*?[]{}\\"):
        raise ValueError(f"a model's name is one plain part of a path, not {name!r}")
    return f"{root.rstrip('/')}/{name}/v{version:06d}"


def stored_models(spark: SparkSession, root: str) -> DataFrame:
    """One row per stored model and version; raises where nothing is stored under ``root``."""
    return spark.read.schema(_ROW).parquet(f"{root.rstrip('/')}/*/v*/model")


def save_model(model: KnnModel | LogisticModel, root: str, name: str, version: int, scaler: ScalerModel | None = None,
               spark: SparkSession | None = None) -> None:
    """Store a fitted model; a version that is there already raises.  ``scaler`` is applied to rows before they
    are scored (a neighbour model's training rows are stored as they are).  ``spark``: the active session."""
    folder = _folder(root, name, version)
    spark = spark or SparkSession.active()
    row = dict.fromkeys(f.split()[0] for f in _ROW.split(", "))
    row |= {"name": name, "version": version}
    if isinstance(model, KnnModel):
        if model.split:
            raise ValueError("a model of several splits is not stored")
        features = [model.features] if isinstance(model.features, str) else list(model.features)
        model.train.select(model.key, model.label, *features).write.mode("error").parquet(f"{folder}/rows")
        row |= {"kind": "knn-array" if isinstance(model.features, str) else "knn", "features": features, "k": model.k,
                "weights": None if model.weights is None else [float(w) for w in model.weights], "key": model.key,
                "label": model.label, "n_rows": spark.read.parquet(f"{folder}/rows").count()}
    else:
        row |= {"kind": "logistic", "features": model.features, "coefficients": [float(c) for c in model.coefficients],
                "intercept": float(model.intercept)}
    if scaler is not None:
        stats = [(c, mean, std) for c, (mean, std) in scaler.stats.items()]
        row |= dict(zip(("scaled", "means", "stds"), map(list, zip(*stats, strict=True)), strict=True))
    spark.createDataFrame([tuple(row.values())], _ROW).coalesce(1).write.mode("error").parquet(f"{folder}/model")


class StoredModel:
    """A model read back: its row, and what scores with it."""

    def __init__(self, row, model: KnnModel | LogisticModel, scaler: ScalerModel | None):
        self.row, self.model, self.scaler = row, model, scaler

    def transform(self, rows: DataFrame) -> DataFrame:
        """The rows with ``pred`` and ``proba``; features keep the values that they came with."""
        if self.scaler is None:
            return self.model.transform(rows)
        key = "__unscaled"
        kept = rows.withColumn(key, F.struct(*self.scaler.stats))
        scored = self.model.transform(self.scaler.transform(kept))
        return scored.withColumns({c: F.col(key)[c] for c in self.scaler.stats}).drop(key)


def load_model(spark: SparkSession, root: str, name: str, version: int | None = None) -> StoredModel:
    """The stored model of that name: the version asked for, or the highest."""
    found = stored_models(spark, root).where(F.col("name") == F.lit(name))
    if version is not None:
        found = found.where(F.col("version") == F.lit(version))
    row = found.orderBy(F.desc("version")).first()
    if row is None:
        raise LookupError(f"no model {name!r}" + ("" if version is None else f" of version {version}"))
    scaler = ScalerModel({c: (m, s) for c, m, s in zip(row["scaled"], row["means"], row["stds"], strict=True)}) if row["scaled"] else None
    if row["kind"] == "logistic":
        return StoredModel(row, LogisticModel(row["features"], row["coefficients"], row["intercept"]), scaler)
    train = spark.read.parquet(f"{_folder(root, name, row['version'])}/rows")
    features = row["features"][0] if row["kind"] == "knn-array" else row["features"]
    return StoredModel(row, KnnModel(train, features, k=row["k"], key=row["key"], label=row["label"], weights=row["weights"]), scaler)
