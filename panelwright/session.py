"""Session construction with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE resizes shuffle partitions at run time and splits skewed join partitions;
# the session time zone fixes timestamp_ntz -> timestamp casts.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g",
                  app: str = "panelwright", extra: dict | None = None) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", memory)
               .config("spark.driver.host", "127.0.0.1")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_session(app: str = "panelwright") -> SparkSession:
    """A session for spark-submit: master, memory and shuffle partitions come from the cluster."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
