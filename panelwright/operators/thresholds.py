"""Decision thresholds from a scored table. Each returns one row (threshold, objective)."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.metrics import curve, score_histogram
from panelwright.runtime import div0, safe_div

# The F1 grid is 100 evenly spaced thresholds from 0.1 to 0.9.
GRID = [0.1 + i * (0.8 / 99) for i in range(99)] + [0.9]
DEFAULT = 0.5


def f1_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(step, threshold, tp, fp, fn, precision, recall, f1) for every grid threshold.

    A score falls into one grid cell, cells are summed (at most 101 rows), and the sums above each
    grid threshold follow from that small table.
    """
    hist = score_histogram(df, label, score, None)
    cells = Bucketizer(splits=[-math.inf, *GRID, math.inf], inputCol="score", outputCol="cell").transform(hist)
    counts = cells.groupBy("cell").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # Cell c lies above the thresholds 0 … c-1; cell 0 is below the whole grid.
    grid = df.sparkSession.range(len(GRID), numPartitions=1).select(
        F.col("id").cast("int").alias("step"), F.element_at(F.array(*map(F.lit, GRID)), (F.col("id") + 1).cast("int")).alias("threshold"))
    slots = df.sparkSession.range(len(GRID) + 1, numPartitions=1).select(F.col("id").cast("double").alias("cell"))
    filled = slots.join(counts, "cell", "left").fillna(0, ["pos", "neg"])
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(F.lit(0))
    sums = filled.select((F.col("cell") - 1).cast("int").alias("step"), F.sum("pos").over(down).alias("tp"),
                         F.sum("neg").over(down).alias("fp"), F.sum("pos").over(whole).alias("p"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("p") - F.col("tp")
    return grid.join(sums, "step").select(
        "step", "threshold", "tp", "fp", fn.alias("fn"), div0(tp, tp + fp).alias("precision"),
        div0(tp, tp + fn).alias("recall"), div0(2 * tp, 2 * tp + fp + fn).alias("f1"))


def _or_default(best: DataFrame) -> DataFrame:
    return best.select(F.coalesce("threshold", F.lit(DEFAULT)).alias("threshold"), "objective")


def f1_grid_threshold(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """The grid threshold with the best F1; the lowest among equals; 0.5 if no F1 is above 0."""
    best = f1_curve(df, label, score).where(F.col("f1") > 0).agg(
        F.max_by("threshold", F.struct("f1", -F.col("step"))).alias("threshold"),
        F.coalesce(F.max("f1"), F.lit(0.0)).alias("objective"))
    return _or_default(best)


def pr_threshold(df: DataFrame, label: str = "label", score: str = "score", **options) -> DataFrame:
    """The observed score maximising F1 on the precision-recall curve; the lowest among equals."""
    c = curve(df, label, score, **options)
    total = c.agg(F.sum("pos").alias("p")).scalar()
    scored = (c.withColumns({"precision": safe_div(F.col("tp"), F.col("tp") + F.col("fp")),
                             "recall": safe_div(F.col("tp"), total)})
              .withColumn("f", 2 * F.col("precision") * F.col("recall")
                          / (F.col("precision") + F.col("recall") + 1e-8)))
    return _or_default(scored.agg(F.max_by("score", F.struct("f", -F.col("score"))).alias("threshold"),
                                  F.max("f").alias("objective")))


def youden_threshold(df: DataFrame, label: str = "label", score: str = "score", **options) -> DataFrame:
    """The observed score maximising tpr - fpr, the highest among equals; infinity when no score
    beats predicting nothing."""
    c = curve(df, label, score, **options)
    totals = c.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    j = (safe_div(F.col("tp"), totals.select("p").scalar())
         - safe_div(F.col("fp"), totals.select("n").scalar()))
    best = c.withColumn("j", j).where(F.col("j") > 0).agg(
        F.max_by("score", F.struct("j", "score")).alias("t"), F.max("j").alias("objective"))
    return best.select(F.coalesce("t", F.lit(float("inf"))).alias("threshold"),
                       F.coalesce("objective", F.lit(0.0)).alias("objective"))


# What precision and recall count for in the weighted choice unless told otherwise.
WEIGHTS = {"precision": 0.3, "recall": 0.7}


def weighted_threshold(df: DataFrame, label: str = "label", score: str = "score", weights: dict[str, float] | None = None, **options) -> DataFrame:
    """The observed score at which the weighted mean of precision and recall is highest; the highest score among equals."""
    w = weights or WEIGHTS
    c = curve(df, label, score, **options)
    total = c.agg(F.sum("pos").alias("p")).scalar()
    both = w["precision"] + w["recall"]
    value = (w["precision"] * safe_div(F.col("tp"), F.col("tp") + F.col("fp")) + w["recall"] * safe_div(F.col("tp"), total)) / both
    best = c.withColumn("v", value).agg(F.max_by("score", F.struct("v", "score")).alias("threshold"), F.max("v").alias("objective"))
    return _or_default(best)


METHODS = {"weighted": weighted_threshold, "f1_optimal": f1_grid_threshold, "precision_recall_curve": pr_threshold,
           "youden_j": youden_threshold}


def optimize_threshold(df: DataFrame, method: str = "f1_optimal", label: str = "label",
                       score: str = "score", **options) -> float:
    """The threshold of one of the methods; ``options`` are the method's own, such as ``weights``."""
    if method not in METHODS:
        raise ValueError(f"unknown optimization method: {method}")
    return float(METHODS[method](df, label, score, **options).first()["threshold"])
