"""Drift between two tables: exact two-sample Kolmogorov-Smirnov distance and population stability of every column in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.rules import number
from panelwright.operators.prefix import ROWS_PER_RANGE, running_sums
from panelwright.runtime import materialize, quoted

BINS = 10
# Customary limits of the stability index.
LEVELS = ((0.1, "none"), (0.25, "moderate"))


def _level(psi: Column) -> Column:
    ladder = F.when(psi.isNull(), F.lit(None).cast("string"))
    for limit, name in LEVELS:
        ladder = ladder.when(psi < limit, name)
    return ladder.otherwise("major")


def _term(bins: Column | int) -> Column:
    """A bin's part of the stability index, with half a row more on either side, so that an empty one counts."""
    a = (F.col("_a") + 0.5) / (F.col("n_base") + 0.5 * bins)
    b = (F.col("_b") + 0.5) / (F.col("n_new") + 0.5 * bins)
    return F.when((F.col("n_base") > 0) & (F.col("n_new") > 0), (a - b) * F.log(a / b))


def numeric_drift(base: DataFrame, new: DataFrame, cols: Sequence[str], bins: int = BINS, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(feature, n_base, n_new, ks, p_value, psi, level) per column; NULL and NaN cells don't count.

    Both tables become one histogram over distinct values; its running sums give the largest gap of the two distributions, exactly. A value lies
    in the stability bin that the share of ``base`` rows below it names, so bins hold about equally many base rows, and equal values
    share one. ``p_value`` is the asymptotic one. A column without values in either table has NULL figures.
    """
    def cells(df: DataFrame, a: int, b: int) -> DataFrame:
        long = F.array(*[F.struct(F.lit(c).alias("feature"), number(c).alias("_v")) for c in cols])
        return df.select(F.inline(F.filter(long, lambda x: x["_v"].isNotNull())), F.lit(a).alias("_a"), F.lit(b).alias("_b"))

    hist = materialize(cells(base, 1, 0).unionByName(cells(new, 0, 1)).groupBy("feature", "_v").agg(
        F.sum("_a").alias("_a"), F.sum("_b").alias("_b")), "drift")
    sums = hist.groupBy(F.col("feature").alias("_f")).agg(F.sum("_a").alias("n_base"), F.sum("_b").alias("n_new"))
    ranked = running_sums(hist, "_v", {"_ca": "_a", "_cb": "_b"}, by=["feature"], rows_per_range=rows_per_range)
    ranked = ranked.join(F.broadcast(sums), F.col("feature") == F.col("_f"))                    # one row a column
    share = F.try_divide(F.col("_ca") - F.col("_a"), F.col("n_base"))
    binned = ranked.withColumns({"_bin": F.least(F.floor(share * bins), F.lit(bins - 1)),
                                 "_gap": F.abs(F.try_divide("_ca", "n_base") - F.try_divide("_cb", "n_new"))})
    per_bin = binned.groupBy("feature", "n_base", "n_new", "_bin").agg(
        F.sum("_a").alias("_a"), F.sum("_b").alias("_b"), F.max("_gap").alias("_gap"))
    found = per_bin.groupBy("feature", "n_base", "n_new").agg(F.max("_gap").alias("ks"), F.sum(_term(bins)).alias("psi"))
    out = found.select("feature", "n_base", "n_new", "ks", ks_p_value(F.col("ks"), F.col("n_base"), F.col("n_new")).alias("p_value"), "psi")
    return out.withColumn("level", _level(F.col("psi")))


def ks_p_value(distance: Column, n: Column, m: Column, terms: int = 40) -> Column:
    """The asymptotic two-sided p-value of a two-sample distance: 2 sum (-1)^(k-1) exp(-2 k^2 x^2) with x = d sqrt(nm / (n + m)), at most 1."""
    x = distance * F.sqrt(F.try_divide(n.cast("double") * m, (n + m).cast("double")))
    steps = F.transform(F.sequence(F.lit(1), F.lit(terms)), lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x * x))
    total = F.aggregate(steps, F.lit(0.0), lambda s, v: s + v)
    return F.when(x < 0.2, F.lit(1.0)).when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def category_drift(base: DataFrame, new: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, n_base, n_new, n_categories, unseen, psi, level) of text columns; NULL is a category, ``unseen`` the share of new rows whose
    category the base does not hold."""
    def cells(df: DataFrame, a: int, b: int) -> DataFrame:
        long = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(quoted(c)).cast("string").alias("_v")) for c in cols])
        return df.select(F.inline(long), F.lit(a).alias("_a"), F.lit(b).alias("_b"))

    hist = materialize(cells(base, 1, 0).unionByName(cells(new, 0, 1)).groupBy("feature", "_v").agg(
        F.sum("_a").alias("_a"), F.sum("_b").alias("_b")), "category-drift")
    sums = hist.groupBy(F.col("feature").alias("_f")).agg(F.sum("_a").alias("n_base"), F.sum("_b").alias("n_new"), F.count("*").alias("n_categories"))
    joined = hist.join(F.broadcast(sums), F.col("feature") == F.col("_f"))                      # one row a column
    out = joined.groupBy("feature", "n_base", "n_new", "n_categories").agg(
        F.try_divide(F.sum(F.when(F.col("_a") == 0, F.col("_b")).otherwise(0)), F.first("n_new")).alias("unseen"),
        F.sum(_term(F.col("n_categories"))).alias("psi"))
    return out.withColumn("level", _level(F.col("psi")))
