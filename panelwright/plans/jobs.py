"""The end-to-end jobs: prepare a panel table, train on it, analyse a scored table.

Each takes a session, paths and a settings dict; a spark-submit script only has to call one of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.rules import error_class, right_closed_bin
from panelwright.ml.models import classifier_of, feature_importances, shapley_attributions
from panelwright.operators import metrics, profile
from panelwright.operators.labelling import top_share
from panelwright.operators.quality import MissingRate, Range, quality_report
from panelwright.plans.panel import order_panel
from panelwright.plans.training import Columns, Training, search, train_model, with_best
from panelwright.runtime import materialize
from panelwright.sources.artifacts import Artifacts, save_artifacts
from panelwright.sources.ledger import RunLedger
from panelwright.sources.readers import load_data
from panelwright.sources.writers import json_records, write_csv, write_json, write_partitioned


def prepare_panel(spark: SparkSession, sf_dir: str, path: str, prevalence: float = 0.07) -> DataFrame:
    """Raw tables to a stored panel: derived groups, exact-prevalence target, partitioned by period.
    Returns the summary of the stored table."""
    derived = order_panel(spark, sf_dir).drop("label").withColumn(
        "order_group", right_closed_bin(F.col("n_orders"), [0, 1, 3, float("inf")], ["one", "few", "many"]))
    stored = materialize(derived, "derived")
    write_partitioned(top_share(stored, "n_orders", prevalence, ["entity", "period"]), path, ["period"])
    return profile.dataset_summary(spark.read.parquet(path), "entity", "period", "target")


def training_job(spark: SparkSession, data: str, out: str, config: dict, columns: Columns, rules: Sequence | None = None) -> Training:
    """Read, check (a report, never a stop), optionally search, train, save, attribute, record."""
    processing = config.get("processing", {})
    df = load_data(spark, data, sample_fraction=processing.get("sample_fraction", 1.0), key=columns.keys, period=columns.period)
    df = materialize(df, "training-input")
    ledger = RunLedger(spark, f"{out}/ledger")
    ledger.log_params(config)
    checks = rules or [MissingRate(c, 0.1) for c in df.columns] + [Range(columns.label, 0, 1)]
    write_json(quality_report(df, checks).coalesce(1), f"{out}/quality")
    if config.get("hpo", {}).get("enabled"):
        trials = materialize(search(df, config, columns), "trials")
        write_json(trials.coalesce(1), f"{out}/trials")
        config = with_best(config, trials)
    result = train_model(df, config, columns)
    save_artifacts(spark, out, Artifacts(result.model, result.threshold, result.features, result.inputs,
                                         result.algorithm, config), result.summary)
    ledger.log_metrics({r["metric"]: {"mean": r["mean"], "std": r["std"]} for r in result.summary.collect()})  # a few metrics
    ledger.log_metrics({"threshold": result.threshold})
    write_csv(feature_importances(result.model, result.features), f"{out}/importances")
    if config.get("explain", {}).get("enabled"):
        ready = df
        for stage in result.model.stages[:-2]:
            ready = stage.transform(ready)
        table = shapley_attributions(classifier_of(result.model), ready, result.features, columns.keys,
                                     fraction=config["explain"].get("fraction", 1.0))
        write_csv(table, f"{out}/attributions")
    ledger.log_artifact("model", f"{out}/model")
    return result


def analysis_job(scored: DataFrame, dimensions: Sequence[str], features: Sequence[str], path: str | None = None) -> DataFrame:
    """(section, record) JSON rows: metrics, slices, calibration, error classes and their contrast."""
    tagged = scored.withColumn("error_class", error_class(F.col("label"), F.col("pred")))
    sections = {
        "metrics": metrics.classification_metrics(scored),
        "slices": metrics.slice_metrics(scored, dimensions),
        "calibration": metrics.calibration_curve(scored),
        "calibration_error": metrics.calibration_error(scored),
        "error_classes": profile.value_counts(tagged, "error_class"),
        "error_contrast": metrics.error_contrast(tagged, features),
    }
    out = None
    for name, table in sections.items():
        part = json_records(table).select(F.lit(name).alias("section"), "record")
        out = part if out is None else out.unionByName(part)
    if path:
        write_json(out, path)
    return out
