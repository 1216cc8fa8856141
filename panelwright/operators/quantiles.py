"""Moments and exact quantiles with linear interpolation, at any size, in two scans.

The first scan gathers each column's moments and a sketch that brackets every quantile; the second picks the values. Spark's
``percentile`` keeps every distinct value of a column in one aggregation buffer, so it does that only where the first scan counted few
cells. Beyond that the rows below a bracket are counted, and only the values inside it (a few in ten thousand) are
shuffled and ranked. Both ways give the same rows: NaN and NULL cells are missing, NULL is a group like others, a column without
values has NULL quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.rules import number
from panelwright.operators.prefix import ROWS_PER_RANGE, running_sums
from panelwright.runtime import lookup_join, materialize, quoted

SMALL_CELLS = 100_000
ACCURACY = 10_000
# Brackets a plan may carry as literals; beyond that they are joined to the rows.
LITERALS = 600
MOMENTS = ("count", "mean", "std", "min", "max")


def long_form(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, value) rows of the numeric columns."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), number(c).alias("value")) for c in cols])
    return df.select(*by, F.inline(cells))


def statistics(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
               small_cells: int = SMALL_CELLS, accuracy: int = ACCURACY, literals: int = LITERALS,
               rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(by, feature, count, mean, std, min, max, quantiles): one row per group and column, ``quantiles`` in the order of ``probs``."""
    cols, probs, by = list(cols), [float(p) for p in probs], list(by)
    taken = {"feature", "quantiles", *MOMENTS} & set(by)
    if taken:
        raise ValueError(f"the result has columns of these names: {sorted(taken)}")
    # One struct for the group, in which NULL equals NULL; names that no table has.
    group = F.struct(*[F.col(quoted(b)).alias(f"_{i}") for i, b in enumerate(by)]) if by else F.struct(F.lit(0).alias("_0"))
    base = df.select(group.alias("_k"), *[number(c).alias(f"_c{j}") for j, c in enumerate(cols)])
    told = materialize(_first_scan(base, len(cols), probs, bool(by), accuracy), "brackets")
    long = told.select("_k", F.inline(F.array(*[F.struct(F.lit(j).alias("_j"), F.lit(c).alias("feature"), f"_s{j}.*") for j, c in enumerate(cols)])))
    cells, rows = long.agg(F.sum("count"), F.count("*")).first()
    if (cells or 0) <= small_cells:
        found = base.groupBy("_k").agg(*[F.percentile(f"_c{j}", F.array(*map(F.lit, probs))).alias(f"_p{j}") for j in range(len(cols))])
        found = found.select("_k", F.inline(F.array(*[F.struct(F.lit(j).alias("_j"), F.col(f"_p{j}").alias("quantiles")) for j in range(len(cols))])))
    else:
        found = _select(base, long, probs, accuracy, rows * len(probs) <= literals, rows_per_range)
    found = found.select(F.col("_k").alias("_rk"), F.col("_j").alias("_rj"), "quantiles")
    joined = long.join(found, (F.col("_k") == F.col("_rk")) & (F.col("_j") == F.col("_rj")), "left")
    return joined.select(*[F.col(f"_k._{i}").alias(b) for i, b in enumerate(by)], "feature", *MOMENTS, "quantiles")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), **options) -> DataFrame:
    """(by, feature, prob, value): the quantiles of each column."""
    taken = {"prob", "value"} & set(by)
    if taken:
        raise ValueError(f"the result has columns of these names: {sorted(taken)}")
    cells = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.col("quantiles")[i].alias("value")) for i, p in enumerate(probs)])
    return statistics(df, cols, probs, by, **options).select(*map(quoted, by), "feature", F.inline(cells))


def _first_scan(base: DataFrame, width: int, probs: Sequence[float], grouped: bool, accuracy: int) -> DataFrame:
    """(_k, _s0, _s1, …): per column the moments and the values around the wanted ranks. The sketch is off by at most n / accuracy
    ranks; one step more on either side covers rounding and the interpolation partner."""
    step = 3.0 / accuracy
    asked = [q for p in probs for q in (max(0.0, p - step), min(1.0, p + step))]

    def told(c: Column) -> Column:
        return F.struct(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"),
                        F.max(c).alias("max"), F.percentile_approx(c, asked, accuracy).alias("_around"))

    sums = [told(F.col(f"_c{j}")).alias(f"_s{j}") for j in range(width)]
    if grouped:
        return base.groupBy("_k").agg(*sums)
    return base.agg(*sums).withColumn("_k", F.struct(F.lit(0).alias("_0")))


def _select(base: DataFrame, long: DataFrame, probs: Sequence[float], accuracy: int, few: bool, rows_per_range: int) -> DataFrame:
    """(_k, _j, quantiles): count the values below each bracket and the distinct ones inside, then pick the ranks."""
    step, below = 3.0 / accuracy, F.lit(float("-inf"))

    def bound(i: int, side: str, at_end: bool) -> Column:
        whole = (F.col("count") < accuracy) | F.lit(at_end)                         # few values, or an end of the range
        return F.when(whole, F.col(side)).otherwise(F.col("_around")[2 * i + (side == "max")])

    brackets = long.where(F.col("count") > 0).select("_k", "_j", F.col("count").alias("_n"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("_i"), F.lit(p).alias("_p"), bound(i, "min", p <= step).alias("_lo"), bound(i, "max", p >= 1 - step).alias("_hi"))
        for i, p in enumerate(probs)])))
    if few:
        cells = []
        for r in brackets.collect():                                                # at most LITERALS rows
            v = F.col(f"_c{r['_j']}")
            mine = v <= r["_hi"]
            for name, value in r["_k"].asDict().items():
                mine = mine & F.col(f"_k.{name}").eqNullSafe(F.lit(value))
            cells.append(F.struct(F.lit(r["_j"]).alias("_j"), F.lit(r["_i"]).alias("_i"),
                                  F.when(mine, F.when(v >= r["_lo"], v).otherwise(below)).alias("_v")))
        inside = base.select("_k", F.inline(F.filter(F.array(*cells), lambda x: x["_v"].isNotNull())))
    else:
        width = len([c for c in base.columns if c != "_k"])
        per_key = materialize(brackets.groupBy("_k", "_j").agg(F.collect_list(F.struct("_i", "_lo", "_hi")).alias("_b")), "bracket-lists")   # one per prob
        values = base.select("_k", F.inline(F.filter(F.array(*[F.struct(F.lit(j).alias("_j"), F.col(f"_c{j}").alias("_x")) for j in range(width)]),
                                                     lambda x: x["_x"].isNotNull())))
        near = F.filter("_b", lambda b: F.col("_x") <= b["_hi"])
        inside = (lookup_join(values, per_key, ["_k", "_j"], "inner").select("_k", "_j", "_x", F.inline(near))
                  .select("_k", "_j", "_i", F.when(F.col("_x") >= F.col("_lo"), F.col("_x")).otherwise(below).alias("_v")))
    keys = ["_k", "_j", "_i"]
    hist = materialize(inside.groupBy(*keys, "_v").agg(F.count("*").alias("_cnt")), "bracket-hist")
    cum = running_sums(hist, "_v", {"_cum": "_cnt"}, by=keys, rows_per_range=rows_per_range)
    # Only (key, bracket) rows: the sizes go to the counts, not to the values.
    sized = lookup_join(cum, brackets.select(*keys, "_n", "_p"), keys, "inner")
    position = F.col("_p") * (F.col("_n") - 1)
    found = sized.groupBy(*keys, "_n", "_p").agg(
        F.min(F.when(F.col("_cum") > F.floor(position), F.col("_v"))).alias("_a"),
        F.min(F.when(F.col("_cum") > F.ceil(position), F.col("_v"))).alias("_b"))
    missed = F.col("_a").isNull() | F.col("_b").isNull() | (F.col("_a") == below)
    value = F.when(missed, F.raise_error(F.lit("quantile outside its bracket")).cast("double")).otherwise(
        F.col("_a") + (F.col("_b") - F.col("_a")) * (position - F.floor(position)))
    picked = found.select(*keys, value.alias("_value")).groupBy("_k", "_j").agg(F.array_sort(F.collect_list(F.struct("_i", "_value"))).alias("_q"))
    return picked.select("_k", "_j", F.transform("_q", lambda x: x["_value"]).alias("quantiles"))
