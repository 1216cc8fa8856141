"""Classification metrics of a scored table with columns (label, pred, score), all 0/1 and double.

Everything starts from one histogram over distinct scores (map-side combined, unique per group and
score). Ranking metrics are sums over its running totals, so rows are never sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.rules import number
from panelwright.operators.prefix import ROWS_PER_RANGE, running_sums
from panelwright.runtime import div0, materialize, null_safe_join, quoted, safe_div


def score_histogram(df: DataFrame, label: str = "label", score: str = "score", pred: str | None = "pred",
                    by: Sequence[str] = ()) -> DataFrame:
    """(by, score, pos, neg[, hit, alarm]): class counts per distinct score.

    ``hit`` and ``alarm`` count the positives and negatives with prediction 1. Rows without a label, a
    score (NULL or NaN) or, where predictions are asked for, a prediction are left out.
    """
    df = scored_rows(df, label, score)
    if pred is not None:
        df = df.where(F.col(pred).isNotNull())
    y = F.col(label).cast("long")
    aggs = [F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")]
    if pred is not None:
        p = F.col(pred).cast("long")
        aggs += [F.sum(p * y).alias("hit"), F.sum(p * (1 - y)).alias("alarm")]
    return df.groupBy(*by, F.col(score).alias("score")).agg(*aggs)


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Rates of a confusion matrix; an empty denominator gives 0, no positive prediction gives an
    infinite number needed to screen."""
    precision, recall = div0(tp, tp + fp), div0(tp, tp + fn)
    return {
        "accuracy": div0(tp + tn, tp + fp + fn + tn),
        "precision": precision,
        "recall": recall,
        "f1_score": div0(2 * tp, 2 * tp + fp + fn),
        "specificity": div0(tn, tn + fp),
        "sensitivity": recall,
        "npv": div0(tn, tn + fn),
        "ppv": precision,
        "number_needed_to_screen": F.when(tp > 0, safe_div(tp + fp, tp)).otherwise(F.lit(float("inf"))),
    }


def confusion(df: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """True/false negative/positive counts with the derived rates, one row per group."""
    y, p = F.col(label), F.col(pred)
    counts = df.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("true_negatives"),
        F.count_if((y == 0) & (p == 1)).alias("false_positives"),
        F.count_if((y == 1) & (p == 0)).alias("false_negatives"),
        F.count_if((y == 1) & (p == 1)).alias("true_positives"))
    return counts.withColumns(rates(F.col("true_positives"), F.col("false_positives"),
                                    F.col("false_negatives"), F.col("true_negatives")))


def curve(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = (),
          rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(by, score, pos, neg, tp, fp): class totals at or above each distinct score."""
    hist = materialize(score_histogram(df, label, score, None, by), "scores")
    return running_sums(hist, "score", {"tp": "pos", "fp": "neg"}, by=by, descending=True,
                        rows_per_range=rows_per_range)


def _ranking(pos: Column, neg: Column, tp: Column, fp: Column) -> dict[str, Column]:
    """AUC with ties counted half, and average precision; NULL when a class is absent."""
    p, n = F.sum(pos).cast("double"), F.sum(neg).cast("double")
    area = F.sum(neg.cast("double") * (tp.cast("double") - pos / 2))
    steps = F.sum(pos.cast("double") * safe_div(tp, tp + fp))
    return {"roc_auc": safe_div(area, p * n), "pr_auc": safe_div(steps, p)}


def ranking_metrics(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = (),
                    rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(by, roc_auc, pr_auc)."""
    c = curve(df, label, score, by, rows_per_range)
    r = _ranking(*[F.col(x) for x in ("pos", "neg", "tp", "fp")])
    return c.groupBy(*by).agg(*[v.alias(k) for k, v in r.items()])


def classification_metrics(df: DataFrame, label: str = "label", score: str = "score", pred: str = "pred",
                           by: Sequence[str] = (), min_rows: int = 0,
                           rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """All confusion counts, rates and ranking metrics with the sample size, from one scan.

    Groups below ``min_rows`` are left out before anything is ranked.
    """
    by = list(by)
    hist = materialize(score_histogram(df, label, score, pred, by), "scores")
    if min_rows > 0 and by:
        big = (hist.groupBy(*by).agg(F.sum(F.col("pos") + F.col("neg")).alias("_n"))
               .where(F.col("_n") >= min_rows).drop("_n"))
        hist = null_safe_join(hist, big, by)
    ranked = running_sums(hist, "score", {"tp": "pos", "fp": "neg"}, by=by, descending=True,
                          rows_per_range=rows_per_range)
    r = _ranking(*[F.col(x) for x in ("pos", "neg", "tp", "fp")])
    out = ranked.groupBy(*by).agg(
        F.sum("hit").alias("true_positives"), F.sum("alarm").alias("false_positives"),
        F.sum(F.col("pos") - F.col("hit")).alias("false_negatives"),
        F.sum(F.col("neg") - F.col("alarm")).alias("true_negatives"),
        F.sum(F.col("pos") + F.col("neg")).alias("sample_size"),
        safe_div(F.sum("pos"), F.sum(F.col("pos") + F.col("neg"))).alias("positive_rate"),
        *[v.alias(k) for k, v in r.items()])
    return out.withColumns(rates(F.col("true_positives"), F.col("false_positives"),
                                 F.col("false_negatives"), F.col("true_negatives")))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score",
              rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, and the (inf, 0, 0) start point."""
    c = curve(df, label, score, (), rows_per_range)
    totals = c.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    points = c.select(F.col("score").alias("threshold"),
                      safe_div(F.col("fp"), totals.select("n").scalar()).alias("fpr"),
                      safe_div(F.col("tp"), totals.select("p").scalar()).alias("tpr"))
    start = totals.select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                          F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def pr_curve(df: DataFrame, label: str = "label", score: str = "score",
             rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(threshold, precision, recall) for every distinct score, and the closing point (NULL, 1, 0)."""
    c = curve(df, label, score, (), rows_per_range)
    totals = c.agg(F.sum("pos").alias("p"))
    points = c.select(F.col("score").alias("threshold"),
                      safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                      safe_div(F.col("tp"), totals.select("p").scalar()).alias("recall"))
    end = totals.select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                        F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def by_slices(df: DataFrame, dimensions: Sequence[str], keep: Sequence[str] = ("label", "pred", "score")) -> DataFrame:
    """One row per input row and slice dimension: (dimension, slice, kept columns). Missing slice
    values belong to no slice."""
    cells = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("slice"))
                      for d in dimensions])
    return df.select(*keep, F.inline(cells)).where(F.col("slice").isNotNull())


def slice_metrics(df: DataFrame, dimensions: Sequence[str], label: str = "label", score: str = "score",
                  pred: str = "pred", min_rows: int = 10,
                  rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """All metrics per (dimension, slice), every dimension in the same job."""
    long = by_slices(df, dimensions, (label, pred, score))
    return classification_metrics(long, label, score, pred, ("dimension", "slice"), min_rows, rows_per_range)


def missing_impact(df: DataFrame, features: Sequence[str], **options) -> DataFrame:
    """(cases, all metrics): rows whose ``features`` are all there ('complete') against the others ('incomplete') and all of them ('all')."""
    gaps = F.lit(False)
    for c in features:
        gaps = gaps | number_or_null(df, c).isNull()
    both = df.withColumn("cases", F.explode(F.array(F.lit("all"), F.when(gaps, "incomplete").otherwise("complete"))))
    return classification_metrics(both, by=["cases"], **options)


def number_or_null(df: DataFrame, column: str) -> Column:
    """The column, with NULL for NaN where it can hold one."""
    return number(column) if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)) else F.col(quoted(column))


def top_categories(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The n most frequent values (ties by value), with their counts."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), column).limit(n))


def top_slice_metrics(df: DataFrame, column: str, n: int = 5, **options) -> DataFrame:
    """Slice metrics restricted to the n most frequent values of one column."""
    top = [r[0] for r in top_categories(df, column, n).collect()]        # n values
    return slice_metrics(df.where(F.col(column).isin(top)), [column], **options)


def classification_report(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """(class, precision, recall, f1, support) per class with accuracy, macro and weighted averages."""
    counts = confusion(df, label, pred)
    tp, fp, fn, tn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives",
                                         "true_negatives"))

    def entry(name, tp, fp, fn, support):
        return F.struct(F.lit(name).alias("class"), div0(tp, tp + fp).alias("precision"),
                        div0(tp, tp + fn).alias("recall"), div0(2 * tp, 2 * tp + fp + fn).alias("f1"),
                        support.alias("support"))

    one, zero = entry("1", tp, fp, fn, tp + fn), entry("0", tn, fn, fp, tn + fp)
    total = tp + fp + fn + tn
    acc = div0(tp + tn, total)
    macro = F.struct(F.lit("macro avg").alias("class"), *[
        ((zero[m] + one[m]) / 2).alias(m) for m in ("precision", "recall", "f1")], total.alias("support"))
    weighted = F.struct(F.lit("weighted avg").alias("class"), *[
        div0(zero[m] * zero["support"] + one[m] * one["support"], total).alias(m)
        for m in ("precision", "recall", "f1")], total.alias("support"))
    overall = F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"),
                       acc.alias("f1"), total.alias("support"))
    return counts.select(F.inline(F.array(zero, one, overall, macro, weighted)))


def scored_rows(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """The rows that count in a metric of scores: those with a label and a score that is a number."""
    return df.where(F.col(label).isNotNull() & number(score).isNotNull())


def brier(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    d = F.col(score) - F.col(label)
    return scored_rows(df, label, score).agg(F.avg(d * d).alias("brier_score"))


def calibration_error(df: DataFrame, label: str = "label", score: str = "score", bins: int = 10) -> DataFrame:
    """(brier_score, expected_calibration_error); bins are (lo, hi], a score of 0 lies in none.

    Rows without a label or a score (NULL or NaN) don't count.
    """
    df = scored_rows(df, label, score)
    d = F.col(score) - F.col(label)
    per_bin = df.groupBy(F.when(F.col(score) > 0, F.ceil(F.col(score) * bins)).alias("bin")).agg(
        F.count("*").alias("n"), F.sum(score).alias("conf"), F.sum(label).alias("pos"),
        F.sum(d * d).alias("sq"))
    gap = F.when(F.col("bin").isNotNull(), F.abs(F.col("conf") - F.col("pos")))
    return per_bin.agg(safe_div(F.sum("sq"), F.sum("n")).alias("brier_score"),
                       F.coalesce(safe_div(F.sum(gap), F.sum("n")), F.lit(0.0))
                       .alias("expected_calibration_error"))


def calibration_curve(df: DataFrame, label: str = "label", score: str = "score", bins: int = 10) -> DataFrame:
    """(bin, n, mean_predicted, fraction_positive) of the non-empty bins; a score of 0 is in bin 1.

    Rows without a label or a score (NULL or NaN) don't count.
    """
    return (scored_rows(df, label, score).groupBy(F.greatest(F.ceil(F.col(score) * bins), F.lit(1)).cast("int").alias("bin"))
            .agg(F.count("*").alias("n"), F.avg(score).alias("mean_predicted"),
                 F.avg(label).alias("fraction_positive")))


def error_contrast(df: DataFrame, features: Sequence[str], error: str = "error_class",
                   pairs: Sequence[tuple[str, str]] = (("FP", "TN"), ("FN", "TP"))) -> DataFrame:
    """(pair, feature, mean_error, mean_correct, difference) of error classes and their counterparts."""
    classes = sorted({c for p in pairs for c in p})
    means = df.agg(*[F.avg(F.when(F.col(error) == c, F.col(f))).alias(f"{c}|{f}")
                     for c in classes for f in features])
    return means.select(F.inline(F.array(*[
        F.struct(F.lit(f"{a} vs {b}").alias("pair"), F.lit(f).alias("feature"),
                 F.col(f"`{a}|{f}`").alias("mean_error"), F.col(f"`{b}|{f}`").alias("mean_correct"),
                 (F.col(f"`{a}|{f}`") - F.col(f"`{b}|{f}`")).alias("difference"))
        for a, b in pairs for f in features])))


def compare_models(df: DataFrame, model: str = "model", **options) -> DataFrame:
    """One row of metrics per model, best ROC-AUC first."""
    return classification_metrics(df, by=[model], **options).orderBy(F.desc_nulls_last("roc_auc"), model)


def best_model(table: DataFrame, metric: str = "roc_auc", model: str = "model") -> DataFrame:
    """The model with the highest metric (ties: first name)."""
    return (table.where(F.col(metric).isNotNull()).orderBy(F.desc(metric), model).limit(1)
            .select(model, metric))


def metric_differences(table: DataFrame, metrics: Sequence[str], model: str = "model") -> DataFrame:
    """(metric, model_a, model_b, difference, significant, p_value) for every pair of models.

    The rule of thumb: above 0.01 for AUC metrics, above 0.05 otherwise; no p-value is computed.
    ``table`` holds one row per model, so the pairs stay few.
    """
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in metrics])
    long = table.select(F.col(model).alias("m"), F.inline(cells))
    a = long.select("metric", F.col("m").alias("model_a"), F.col("v").alias("va"))
    b = long.select("metric", F.col("m").alias("model_b"), F.col("v").alias("vb"))
    diff = F.abs(F.col("va") - F.col("vb"))
    limit = F.when(F.col("metric").contains("auc"), 0.01).otherwise(0.05)
    return (a.join(b, "metric").where(F.col("model_a") < F.col("model_b"))
            .select("metric", "model_a", "model_b", diff.alias("difference"),
                    (diff > limit).alias("significant"), F.lit(None).cast("double").alias("p_value")))


def fold_summary(folds: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(metric, mean, std) over a table with one row per fold; population deviation."""
    wide = folds.agg(*[f(m).alias(f"{n}|{m}") for m in metrics
                       for n, f in (("mean", F.avg), ("std", F.stddev_pop))])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"`mean|{m}`").alias("mean"), F.col(f"`std|{m}`").alias("std"))
        for m in metrics])))


def group_gap(slices: DataFrame, metric: str) -> DataFrame:
    """Largest minus smallest value of a metric over the slices of each dimension."""
    return slices.groupBy("dimension").agg((F.max(metric) - F.min(metric)).alias("gap"),
                                           F.count("*").alias("n_slices"))


