"""Structured Streaming: continuous scoring, health counters, replay protection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from panelwright.functions.rules import nan_to_null, number
from panelwright.operators.quality import Rule
from panelwright.plans.scoring import Scorer, answer


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return nan_to_null(reader.load(path))


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """A watermark needs a zoned timestamp; local ones are read in the session zone (UTC)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def drop_replays(df: DataFrame, ts: str, keys: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """Each key once within the watermark; the state is dropped when the watermark passes."""
    return event_time(df, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def score_stream(df: DataFrame, scorer: Scorer, keep: Sequence[str], sink: str, rejected_sink: str, checkpoint: str,
                 threshold: float = 0.5, version: str = "unknown", rules: Sequence[Rule] = (),
                 available_now: bool = True) -> StreamingQuery:
    """Check, score and store every micro-batch; rejected rows also go to a second table.

    A batch writes to its own folder and overwrites it, so a repeated batch after a failure leaves
    no duplicates.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        scored = answer(batch, scorer, keep, threshold, version, rules, with_violations=True).persist()
        try:
            scored.drop("violations").write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
            (scored.where(F.size("violations") > 0).select(*keep, "violations")
             .write.mode("overwrite").parquet(f"{rejected_sink}/batch={batch_id}"))
        finally:
            scored.unpersist()

    writer = df.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


LATENCIES = {"latency_p50": 0.5, "latency_p95": 0.95}
SKETCH = 800             # items of a latency sketch: its ranks are off by about 0.3 percent


def health_counters(df: DataFrame, ts: str, is_error: Column | None = None, window: str = "1 hour",
                    delay: str = "10 minutes", by: Sequence[str] = (), latency: str | None = None) -> DataFrame:
    """(window_start, by, processed, errors) per event-time window; late rows within ``delay`` count.

    With a ``latency`` column also its total and its median and 95th percentile: the window's state then holds a sketch of bounded size that
    merges across tasks and batches. While a window has fewer values than the sketch's items, the percentiles are values of the window.
    """
    error = F.lit(False) if is_error is None else is_error
    told = [F.count("*").alias("processed"), F.count_if(error).alias("errors")]
    names = ["processed", "errors"]
    if latency is not None:
        value = number(latency)
        told += [F.sum(value).alias("latency_total"), F.kll_sketch_agg_double(value, SKETCH).alias("_sketch")]
        names += ["latency_total", *[F.kll_sketch_get_quantile_double("_sketch", F.lit(p)).alias(n) for n, p in LATENCIES.items()]]
    return (event_time(df, ts).withWatermark(ts, delay)
            .groupBy(F.window(ts, window).alias("w"), *by).agg(*told)
            .select(F.col("w.start").alias("window_start"), *by, *names))


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run the stream over what is there now and append the result to a Parquet table."""
    (df.writeStream.format("parquet").outputMode(mode).option("path", path)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
