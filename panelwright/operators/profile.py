"""Table profiling: counts, moments, quartiles, correlations, missingness, outliers, histograms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.rules import number
from panelwright.operators.gram import gram_correlations
from panelwright.operators.quantiles import exact_quantiles, statistics
from panelwright.runtime import quoted, safe_div


# Column pairs that one plan holds as aggregate expressions; beyond that the Gram matrix gives them.
INLINE_PAIRS = 66


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _long(one_row: DataFrame, cols: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Turn one aggregate row with ``name|column`` fields into one row per column."""
    return one_row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(f"`{n}|{c}`").alias(n) for n in names]) for c in cols])))


def _quantile_columns(names: Sequence[str]) -> list[Column]:
    return [F.col("quantiles")[i].alias(name) for i, name in enumerate(names)]


def describe(df: DataFrame, cols: Sequence[str] | None = None, **options) -> DataFrame:
    """(feature, count, mean, std, min, q25, q50, q75, max) per numeric column."""
    told = statistics(df, list(cols or numeric_columns(df)), [0.25, 0.5, 0.75], **options)
    return told.select("feature", "count", "mean", "std", "min", "max", *_quantile_columns(["q25", "q50", "q75"]))


def describe_by(df: DataFrame, by: str, cols: Sequence[str], **options) -> DataFrame:
    """(by, feature, count, mean, std, median) per group of a low-cardinality column."""
    told = statistics(df.where(F.col(by).isNotNull()), cols, [0.5], [by], **options)
    return told.select(by, "feature", "count", "mean", "std", *_quantile_columns(["median"]))


def five_number(df: DataFrame, by: str, cols: Sequence[str], **options) -> DataFrame:
    """(by, feature, min, q25, median, q75, max): the data of a box plot."""
    told = statistics(df.where(F.col(by).isNotNull()), cols, [0.25, 0.5, 0.75], [by], **options)
    return told.select(by, "feature", "min", "max", *_quantile_columns(["q25", "median", "q75"]))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(column, n, share), most frequent first; missing values are not counted."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), column)


def distinct_counts(df: DataFrame, cols: Sequence[str], exact: bool = True, rsd: float = 0.02) -> DataFrame:
    """(feature, n_distinct) per column; the sketch form costs one pass without a shuffle of values."""
    if not exact:
        agg = df.agg(*[F.approx_count_distinct(c, rsd).alias(f"n_distinct|{c}") for c in cols])
        return _long(agg, cols, ["n_distinct"])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v"))
                      for c in cols])
    distinct = df.select(F.inline(cells)).where(F.col("v").isNotNull()).groupBy("feature", "v").agg(F.lit(1).alias("one"))
    return distinct.groupBy("feature").agg(F.count("*").alias("n_distinct"))


def group_label_stats(df: DataFrame, by: str, label: str = "label") -> DataFrame:
    """(by, count, mean) of the label per category."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(label).alias("count"), F.avg(label).alias("mean"))


def label_crosstab(df: DataFrame, by: str, label: str = "label") -> DataFrame:
    """(by, negative, positive, total, positive_rate, negative_share, positive_share) per category."""
    y = F.col(label)
    n0, n1 = F.count_if(y == 0), F.count_if(y == 1)
    return (df.groupBy(by).agg(n0.alias("negative"), n1.alias("positive"))
            .withColumn("total", F.col("negative") + F.col("positive"))
            .withColumns({"positive_rate": safe_div(F.col("positive"), F.col("total")),
                          "negative_share": safe_div(F.col("negative"), F.col("total")),
                          "positive_share": safe_div(F.col("positive"), F.col("total"))}))


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence, other: str | None = None) -> DataFrame:
    """Counts of each given ``columns`` value per ``rows`` value, and their shares among the row's cells that hold a value.

    A value outside the list fails the job, or is counted under ``other`` where that is given; missing values are not counted.
    """
    c = F.col(quoted(columns))
    listed = {str(v): F.count_if(c == v) for v in values}
    rest = F.count_if(c.isNotNull() & ~c.isin(list(values)))
    if other is None:
        first = F.max(F.when(~c.isin(list(values)), c.cast("string")))
        unlisted = F.raise_error(F.concat(F.lit(f"{columns} holds a value outside the list: "), first)).cast("long")
        rest = F.when(rest == 0, F.lit(0).cast("long")).otherwise(unlisted)
    counted = df.groupBy(F.col(quoted(rows))).agg(*[n.alias(v) for v, n in listed.items()], rest.alias(other or "_rest"))
    names = [*listed, other or "_rest"]
    total = sum((F.col(quoted(v)) for v in names), F.lit(0))
    shares = counted.withColumns({f"{v}_share": safe_div(F.col(quoted(v)), total) for v in (names if other else listed)})
    return shares if other else shares.drop("_rest")


def period_trend(df: DataFrame, period: str, label: str, means: Sequence[str]) -> DataFrame:
    """(period, n, positives, rate, mean_*) per period."""
    return df.groupBy(period).agg(F.count("*").alias("n"), F.sum(label).alias("positives"),
                                  F.avg(label).alias("rate"), *[F.avg(c).alias(f"mean_{c}") for c in means])


def column_summary(df: DataFrame, column: str, **options) -> DataFrame:
    """(min, max, mean, std, median) of one column."""
    return statistics(df, [column], [0.5], **options).select("min", "max", "mean", "std", *_quantile_columns(["median"]))


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, r) for every column pair, rows with a missing side left out; one aggregation, of column blocks where there are many pairs."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if len(pairs) > INLINE_PAIRS:
        return gram_correlations(df, cols).drop("n")
    row = df.agg(*[_pearson(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)])))


def _pearson(a: str, b: str) -> Column:
    r = F.corr(number(a), number(b))
    return F.when(~F.isnan(r), r)


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, r) for all ordered pairs, the diagonal included."""
    pairs = correlation_pairs(df, cols)
    mirrored = pairs.select(F.inline(F.array(
        F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("r")))))
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "a string, b string, r double")
    return mirrored.unionByName(diagonal)


def high_correlations(df: DataFrame, cols: Sequence[str], limit: float = 0.7) -> DataFrame:
    return correlation_pairs(df, cols).where(F.abs("r") > limit)


def label_correlations(df: DataFrame, cols: Sequence[str], label: str = "label", top: int = 15) -> DataFrame:
    """The ``top`` columns by absolute correlation with the label, sign kept."""
    row = df.agg(*[_pearson(c, label).alias(f"r|{c}") for c in cols])
    return _long(row, cols, ["r"]).orderBy(F.desc_nulls_last(F.abs("r")), "feature").limit(top)


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None, only_missing: bool = True) -> DataFrame:
    """(feature, n_missing, percent) per column, most missing first."""
    cols = list(cols or df.columns)
    row = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    out = row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("n_missing"),
                 safe_div(F.col(f"m{i}") * 100, F.col("n")).alias("percent")) for i, c in enumerate(cols)])))
    return (out.where(F.col("n_missing") > 0) if only_missing else out).orderBy(F.desc("n_missing"), "feature")


def completeness(df: DataFrame) -> DataFrame:
    """(completeness): percent of the cells that are filled."""
    filled = sum((F.count(c) for c in df.columns), F.lit(0))
    return df.agg(safe_div(filled * 100, F.count("*") * len(df.columns)).alias("completeness"))


def completeness_flag(df: DataFrame, limit: float = 0.7) -> DataFrame:
    """(completeness, complete_enough): percent of the cells that are filled, and whether that reaches ``limit``."""
    return completeness(df).withColumn("complete_enough", F.col("completeness") >= 100 * limit)


def missing_patterns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(pattern, n, share): how often which columns are missing together, as a comma list of names; rows without gaps have the empty one."""
    gaps = F.concat_ws(",", *[F.when(F.col(quoted(c)).isNull(), F.lit(c)) for c in cols])
    counts = df.groupBy(gaps.alias("pattern")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def complete_rows(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def iqr_fences(df: DataFrame, cols: Sequence[str], factor: float = 1.5, **options) -> DataFrame:
    """(feature, q1, q3, low, high) per column."""
    q = statistics(df, cols, [0.25, 0.75], **options).select("feature", *_quantile_columns(["q1", "q3"]))
    iqr = F.col("q3") - F.col("q1")
    return q.withColumns({"low": F.col("q1") - factor * iqr, "high": F.col("q3") + factor * iqr})


def iqr_outliers(df: DataFrame, cols: Sequence[str], factor: float = 1.5, **options) -> DataFrame:
    """(feature, q1, q3, low, high, n_outliers, percent) per column; percent of all rows."""
    fences = {r["feature"]: r for r in iqr_fences(df, cols, factor, **options).collect()}   # one row per column
    row = df.agg(F.count("*").alias("n"), *[
        F.count_if((number(c) < fences[c]["low"]) | (number(c) > fences[c]["high"])).alias(f"o{i}")
        for i, c in enumerate(cols)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.lit(fences[c][k]).alias(k) for k in ("q1", "q3", "low", "high")],
                 F.col(f"o{i}").alias("n_outliers"), safe_div(F.col(f"o{i}") * 100, F.col("n")).alias("percent"))
        for i, c in enumerate(cols)])))


def outlier_rows(df: DataFrame, column: str, factor: float = 1.5, **options) -> DataFrame:
    """The rows outside the fences of one column."""
    f = iqr_fences(df, [column], factor, **options).first()
    return df.where((number(column) < f["low"]) | (number(column) > f["high"]))


def outlier_label_stats(df: DataFrame, flag: str, label: str = "label") -> DataFrame:
    """(flag, count, sum, mean) of the label among outliers and normal rows."""
    return df.groupBy(flag).agg(F.count(label).alias("count"), F.sum(label).alias("sum"), F.avg(label).alias("mean"))


def mean_outlier_rate(outliers: DataFrame) -> DataFrame:
    """(mean_rate): outlier cells over all cells, from the ``iqr_outliers`` table."""
    return outliers.agg((F.avg("percent") / 100).alias("mean_rate"))


def two_sample_tests(df: DataFrame, cols: Sequence[str], label: str = "label") -> DataFrame:
    """(feature, t, effect, dof, p_value): pooled two-sample t of label 1 against label 0, the
    standardised mean difference, and the two-sided p-value."""
    row = df.agg(*[g(F.when(F.col(label) == k, number(c))).alias(f"{n}{k}|{c}")
                   for c in cols for k in (0, 1)
                   for n, g in (("n", F.count), ("m", F.avg), ("v", F.var_samp))])
    names = [f"{n}{k}" for k in (0, 1) for n in "nmv"]
    s = _long(row, cols, names)
    dof = F.col("n0") + F.col("n1") - 2
    pooled = ((F.col("n0") - 1) * F.col("v0") + (F.col("n1") - 1) * F.col("v1")) / F.nullif(dof, F.lit(0))
    t = safe_div(F.col("m1") - F.col("m0"), F.sqrt(pooled * (1 / F.col("n0") + 1 / F.col("n1"))))
    effect = safe_div(F.col("m1") - F.col("m0"), F.sqrt((F.col("v0") + F.col("v1")) / 2))
    out = s.where((F.col("n0") > 0) & (F.col("n1") > 0)).select(
        "feature", t.alias("t"), effect.alias("effect"), dof.alias("dof"))
    rows = [(r["feature"], r["t"], r["effect"], r["dof"],
             None if r["t"] is None or r["dof"] <= 0 else t_two_sided(r["t"], r["dof"]))
            for r in out.collect()]                            # one row per column
    return df.sparkSession.createDataFrame(
        rows, "feature string, t double, effect double, dof long, p_value double")


def t_two_sided(t: float, dof: float) -> float:
    """Two-sided p-value of Student's t: the regularised incomplete beta function at dof/(dof+t²)."""
    x = dof / (dof + t * t)
    return _betainc(dof / 2.0, 0.5, x)


def _betainc(a: float, b: float, x: float) -> float:
    """Continued fraction for the regularised incomplete beta function (Lentz's method)."""
    if x <= 0.0 or x >= 1.0:
        return min(max(x, 0.0), 1.0)
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _betainc(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
    value = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
            c = 1.0 + num / c
            c = c if abs(c) > 1e-300 else 1e-300
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * value


def percentile_threshold(df: DataFrame, column: str, p: float, **options) -> DataFrame:
    """(threshold): the p-quantile of a column."""
    return exact_quantiles(df, [column], [p], **options).select(F.col("value").alias("threshold"))


def histogram(df: DataFrame, column: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """(by, bin, lo, hi, n) over equal-width bins between the column's extremes; the last bin is closed."""
    c = number(column)
    lo, hi = df.agg(F.min(c), F.max(c)).first()
    if lo is None:
        raise ValueError(f"{column} has no values")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    index = F.least(F.floor((c - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    keys = [F.col(by)] if by else []
    counts = df.where(c.isNotNull()).groupBy(*keys, index.alias("bin")).agg(F.count("*").alias("n"))
    return counts.withColumns({"lo": lo + F.col("bin") * width, "hi": lo + (F.col("bin") + 1) * width})


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """(negatives, positives, ratio, severity)."""
    y = F.col(label)
    ratio = safe_div(F.col("negatives"), F.col("positives"))
    return (df.agg(F.count_if(y == 0).alias("negatives"), F.count_if(y == 1).alias("positives"))
            .withColumn("ratio", ratio)
            .withColumn("severity", F.when(F.col("ratio") > 10, "Severe").when(F.col("ratio") > 3, "Moderate")
                        .otherwise("Mild")))


def interaction_correlation(df: DataFrame, a: str, b: str, label: str = "label") -> DataFrame:
    """(r): correlation of the product of two columns with the label."""
    return df.agg(F.corr(F.col(a) * F.col(b), F.col(label).cast("double")).alias("r"))


def zscore_outliers(df: DataFrame, cols: Sequence[str], cut: float, out: str = "max_z") -> DataFrame:
    """Add the largest absolute standardised value of a row and whether it exceeds ``cut``."""
    stats = df.agg(*[f(c).alias(f"{n}|{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    z = [F.abs(F.col(c) - F.lit(stats[f"m|{c}"])) / F.lit(stats[f"s|{c}"] or 1.0) for c in cols]
    worst = F.greatest(*z) if len(z) > 1 else z[0]
    return df.withColumns({out: worst, "is_outlier": F.coalesce((worst > cut), F.lit(False)).cast("int")})


def dataset_summary(df: DataFrame, entity: str, period: str, label: str) -> DataFrame:
    """(item, value) rows: records, entities, prevalence, columns, nulls per column, and every period."""
    entities = df.groupBy(entity).agg(F.lit(1).alias("_one")).agg(F.count("*").alias("n"))
    periods = df.where(F.col(period).isNotNull()).select(F.col(period).cast("string").alias("value")).distinct()
    row = df.agg(F.count("*").alias("records"), F.avg(label).alias("prevalence"),
                 *[F.count_if(F.col(c).isNull()).alias(f"nulls.{c}") for c in df.columns])
    items = [F.struct(F.lit("records").alias("item"), F.col("records").cast("string").alias("value")),
             F.struct(F.lit("prevalence").alias("item"), F.format_string("%.6f", F.col("prevalence")).alias("value")),
             F.struct(F.lit("columns").alias("item"), F.lit(",".join(df.columns)).alias("value"))]
    items += [F.struct(F.lit(f"nulls.{c}").alias("item"), F.col(f"`nulls.{c}`").cast("string").alias("value"))
              for c in df.columns]
    return (row.select(F.inline(F.array(*items)))
            .unionByName(entities.select(F.lit("entities").alias("item"), F.col("n").cast("string").alias("value")))
            .unionByName(periods.select(F.lit("period").alias("item"), "value")))
