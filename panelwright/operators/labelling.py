"""Exact-prevalence labels: the riskiest share of the rows becomes positive."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.prefix import ROWS_PER_RANGE, rank_cutoff, running_sums
from panelwright.runtime import lookup_join, materialize


def top_share(df: DataFrame, risk: str, prevalence: float, keys: Sequence[str], out: str = "target",
              rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Label floor(n * prevalence) rows of highest risk 1, ties by ascending numeric keys.

    ``df`` is read several times; materialize it when it is expensive.
    """
    n = math.floor(df.count() * prevalence)
    cut = rank_cutoff(df.where(F.col(risk).isNotNull()), [(risk, True), *[(k, False) for k in keys]], n,
                      rows_per_range)
    return df.withColumn(out, F.lit(0) if cut is None else F.coalesce(cut, F.lit(False)).cast("int"))


def top_share_by_group(df: DataFrame, risk: str, prevalence: float, key: str, group: str, out: str = "target",
                       rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The same inside every group; ``key`` is numeric and unique in its group.

    Per group a histogram gives the risk value at the cut and how many rows tied on it still fit;
    among those rows a second histogram over the key gives the last key that fits.
    """
    d = df.where(F.col(risk).isNotNull() & F.col(group).isNotNull())
    quota = df.groupBy(group).agg(F.floor(F.count("*") * F.lit(float(prevalence))).alias("_quota"))
    quota = materialize(quota.where(F.col("_quota") > 0), "quota")
    hist = materialize(d.groupBy(group, risk).agg(F.count("*").alias("_c")), "risk-hist")
    cum = running_sums(hist, risk, {"_cum": "_c"}, by=[group], descending=True, rows_per_range=rows_per_range)
    at_cut = (lookup_join(cum, quota, [group], "inner").where(F.col("_cum") >= F.col("_quota"))
              .groupBy(group).agg(F.max_by(F.struct(F.col(risk).alias("_edge"),
                                                    (F.col("_quota") - F.col("_cum") + F.col("_c")).alias("_fit")),
                                           F.struct(-F.col("_cum"))).alias("_x"))
              .select(group, "_x.*"))
    at_cut = materialize(at_cut, "risk-cut")
    tied = lookup_join(d, at_cut, [group], "inner").where(F.col(risk) == F.col("_edge"))
    keys = materialize(tied.groupBy(group, "_fit", key).agg(F.count("*").alias("_c")), "tie-hist")
    last = (running_sums(keys, key, {"_cum": "_c"}, by=[group], rows_per_range=rows_per_range)
            .where(F.col("_cum") <= F.col("_fit")).groupBy(group).agg(F.max(key).alias("_last")))
    bounds = lookup_join(at_cut, materialize(last, "tie-cut"), [group], "left")
    marked = lookup_join(df, materialize(bounds, "bounds"), [group], "left")
    inside = (F.col(risk) > F.col("_edge")) | ((F.col(risk) == F.col("_edge")) & (F.col(key) <= F.col("_last")))
    return marked.withColumn(out, F.coalesce(inside, F.lit(False)).cast("int")).drop("_edge", "_fit", "_last")
