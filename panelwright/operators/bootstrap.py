"""Bootstrap intervals of ranking metrics: all replicates in one pass over the rows and one over the score histogram.

A row is in a replicate as often as a Poisson number of mean 1 says, which for many rows is drawing with replacement. The numbers come
from a digest of the row's key, so any task, run or engine draws the same. Replicates are columns of the histogram over distinct scores;
its running sums rank all of them at once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.operators.metrics import _ranking, scored_rows
from panelwright.operators.prefix import ROWS_PER_RANGE, running_sums
from panelwright.runtime import materialize, quoted

DRAWS_PER_DIGEST = 8     # four hexadecimal digits each
STEPS = 1 << 16


def poisson_limits(steps: int = STEPS) -> list[int]:
    """The draws below limit i, out of ``steps``, give a number of at most i; what is left over gives the largest."""
    limits, total, term = [], 0.0, math.exp(-1.0)
    for i in range(1, 12):
        total += term
        term /= i
        limits.append(math.floor(total * steps))
    return sorted(set(limits))


def poisson_weights(key: Sequence[str], replicates: int, seed: int = 42) -> list[Column]:
    """How often a row is in each replicate, from a digest of its key columns."""
    text = F.concat_ws(":", *[F.coalesce(F.col(quoted(k)).cast("string"), F.lit("")) for k in key])
    limits = poisson_limits()
    out = []
    for first in range(0, replicates, DRAWS_PER_DIGEST):
        digest = F.md5(F.concat(F.lit(f"{seed}:{first // DRAWS_PER_DIGEST}:"), text))
        for i in range(min(DRAWS_PER_DIGEST, replicates - first)):
            draw = F.conv(F.substring(digest, 4 * i + 1, 4), 16, 10).cast("int")
            out.append(sum((F.when(draw >= limit, 1).otherwise(0) for limit in limits), F.lit(0)))
    return out


def bootstrap_replicates(df: DataFrame, key: Sequence[str], label: str = "label", score: str = "score", replicates: int = 48,
                         seed: int = 42, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(replicate, roc_auc, pr_auc); replicate 0 is the table itself. Rows without a label or a score don't count; a replicate without
    both classes has NULL metrics."""
    rows = scored_rows(df, label, score)
    y = F.col(quoted(label)).cast("long")
    weights = [F.lit(1), *poisson_weights(key, replicates, seed)]
    # The digests are computed once a row, before the sums use them twice.
    drawn = rows.select(F.col(quoted(score)).alias("_score"), y.alias("_y"), *[w.alias(f"_w{r}") for r, w in enumerate(weights)])
    hist = materialize(drawn.groupBy("_score").agg(*[
        F.sum(F.when(F.col("_y") == side, F.col(f"_w{r}")).otherwise(0)).alias(f"_{name}{r}")
        for r in range(replicates + 1) for name, side in (("p", 1), ("n", 0))]), "replicates")
    sums = {f"_c{name}{r}": f"_{name}{r}" for r in range(replicates + 1) for name in "pn"}
    ranked = running_sums(hist, "_score", sums, descending=True, rows_per_range=rows_per_range)
    metrics = [_ranking(*[F.col(f"_{c}{r}") for c in ("p", "n", "cp", "cn")]) for r in range(replicates + 1)]
    row = ranked.agg(*[v.alias(f"{name}|{r}") for r, m in enumerate(metrics) for name, v in m.items()])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(r).alias("replicate"), *[F.col(f"`{name}|{r}`").alias(name) for name in ("roc_auc", "pr_auc")])
        for r in range(replicates + 1)])))


def bootstrap_intervals(df: DataFrame, key: Sequence[str], label: str = "label", score: str = "score", replicates: int = 48, level: float = 0.95,
                        seed: int = 42, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(metric, value, low, high, std): the metric of the table and the percentile interval over the replicates."""
    found = bootstrap_replicates(df, key, label, score, replicates, seed, rows_per_range)
    long = found.select("replicate", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("_v")) for m in ("roc_auc", "pr_auc")])))
    drawn = F.when(F.col("replicate") > 0, F.col("_v"))
    tail = (1.0 - level) / 2.0
    return long.groupBy("metric").agg(F.max(F.when(F.col("replicate") == 0, F.col("_v"))).alias("value"), F.percentile(drawn, tail).alias("low"),
                                      F.percentile(drawn, 1.0 - tail).alias("high"), F.stddev_samp(drawn).alias("std"))
