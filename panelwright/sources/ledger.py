"""Run ledger: an append-only Parquet table (run_id, kind, key, value, step, ts)."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "run_id string, kind string, key string, value string, step long, ts timestamp"


def flatten_rows(tree: Mapping, prefix: str = "") -> list[tuple[str, str]]:
    """Nested settings as (dotted key, text value) pairs."""
    out: list[tuple[str, str]] = []
    for key, value in tree.items():
        name = f"{prefix}.{key}" if prefix else str(key)
        if isinstance(value, Mapping):
            out.extend(flatten_rows(value, name))
        else:
            out.append((name, str(value)))
    return out


class RunLedger:
    """Appends the parameters, metrics and artifact locations of one run."""

    def __init__(self, spark: SparkSession, path: str, run_id: str | None = None):
        self.spark, self.path, self.run_id = spark, path, run_id or uuid.uuid4().hex

    def _append(self, kind: str, rows: list[tuple[str, str]], step: int | None) -> None:
        data = [(self.run_id, kind, k, v, step) for k, v in rows]
        if data:
            (self.spark.createDataFrame(data, "run_id string, kind string, key string, value string, step long")
             .withColumn("ts", F.current_timestamp()).coalesce(1)
             .write.mode("append").parquet(self.path))

    def log_params(self, params: Mapping) -> None:
        self._append("param", flatten_rows(params), None)

    def log_metrics(self, metrics: Mapping, step: int | None = None) -> None:
        self._append("metric", flatten_rows(metrics), step)

    def log_artifact(self, name: str, location: str) -> None:
        self._append("artifact", [(name, location)], None)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path).where(F.col("run_id") == self.run_id)
