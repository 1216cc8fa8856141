"""Sinks: partitioned Parquet, CSV and JSON for bounded result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("year",), mode: str = "errorifexists") -> None:
    """Parquet partitioned by ``by``. Rows are rebalanced on the partition columns: small values share
    a writer, a value holding much of the table is split over several."""
    (df.hint("rebalance", *by).write.mode(mode).option("compression", "snappy")
     .partitionBy(*by).parquet(path))


def write_csv(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One CSV file with a header; for bounded result tables."""
    table.coalesce(1).write.mode(mode).option("header", True).csv(path)


def json_records(df: DataFrame, out: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """Each row as one JSON object text."""
    return df.select(*keep, F.to_json(F.struct(*df.columns)).alias(out))


def write_json(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    table.write.mode(mode).json(path)
