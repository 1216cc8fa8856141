"""Saving and loading everything a scoring job needs."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.ml.stages import CategoricalEncoderModel, FeatureSelectorModel
from panelwright.sources.ledger import flatten_rows


@dataclass
class Artifacts:
    model: PipelineModel
    threshold: float = 0.5
    features: list[str] = field(default_factory=list)
    inputs: list[str] = field(default_factory=list)
    version: str = "unknown"
    config: dict = field(default_factory=dict)


def save_artifacts(spark: SparkSession, path: str, artifacts: Artifacts, metrics: DataFrame | None = None) -> None:
    """Model, settings, feature names, metrics, flattened config, category maps and dropped columns."""
    artifacts.model.write().overwrite().save(f"{path}/model")
    settings = [(artifacts.threshold, artifacts.version, artifacts.features, artifacts.inputs, json.dumps(artifacts.config))]
    _one_file(spark.createDataFrame(settings, "threshold double, version string, features array<string>, inputs array<string>, config string"),
              f"{path}/settings")
    if artifacts.config:
        _one_file(spark.createDataFrame(flatten_rows(artifacts.config), "key string, value string"), f"{path}/config")
    if metrics is not None:
        _one_file(metrics, f"{path}/metrics")
    for stage in artifacts.model.stages:
        if isinstance(stage, CategoricalEncoderModel):
            for feature, table in stage.tables.items():
                (table.select(F.col(feature).cast("string").alias("category"), F.col("value").cast("double").alias("value"))
                 .write.mode("overwrite").parquet(f"{path}/category_maps/{feature}"))
        if isinstance(stage, FeatureSelectorModel):
            _one_file(spark.createDataFrame([(c,) for c in stage.fitted["dropped"]], "feature string"), f"{path}/dropped")


def _one_file(table: DataFrame, path: str) -> None:
    table.coalesce(1).write.mode("overwrite").json(path)


def load_artifacts(spark: SparkSession, path: str) -> Artifacts:
    """The model is required; without stored settings the defaults apply."""
    model = PipelineModel.load(f"{path}/model")
    try:
        r = spark.read.schema("threshold double, version string, features array<string>, inputs array<string>, config string").json(
            f"{path}/settings").first()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return Artifacts(model)
    return Artifacts(model, r["threshold"], r["features"] or [], r["inputs"] or [], r["version"], json.loads(r["config"] or "{}"))


def describe_model(spark: SparkSession, a: Artifacts) -> DataFrame:
    """(item, value): type, threshold, feature count, all names, algorithm, flattened config."""
    rows = [("model_type", type(a.model.stages[-1]).__name__), ("threshold", str(a.threshold)), ("algorithm", a.version),
            ("n_features", str(len(a.features))), ("features", ",".join(a.features))]
    rows += [(f"config.{k}", v) for k, v in flatten_rows(a.config)]
    return spark.createDataFrame(rows, "item string, value string")
