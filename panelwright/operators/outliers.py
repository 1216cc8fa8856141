"""Multivariate outliers: an isolation forest grown and scored by Spark tasks.

Every tree sees its own small sample (at most ``sample_size`` rows) and is grown by one task; the
forest is a bounded table of nodes, so it can be sent to all executors to score the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.neighbors import as_vector
from panelwright.operators.quantiles import exact_quantiles
from panelwright.operators.scale import scaling_parameters
from panelwright.runtime import materialize, stored_rows

NODES = "tree int, node int, left int, right int, feature int, cut double, size int"


def average_path(n: float) -> float:
    """Mean length of an unsuccessful search in a binary search tree of n values."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(seed: int, limit: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        x = np.stack(pdf.sort_values("order")["x"].to_numpy())
        nodes, todo = [], [(0, np.arange(len(x)), 0)]
        used = 1
        while todo:
            node, rows, depth = todo.pop()
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            spread = np.flatnonzero(high > low)
            if depth >= limit or len(rows) <= 1 or len(spread) == 0:
                nodes.append((tree, node, -1, -1, -1, 0.0, len(rows)))
                continue
            f = int(rng.choice(spread))
            cut = float(rng.uniform(low[f], high[f]))
            left = x[rows, f] <= cut
            nodes.append((tree, node, used, used + 1, f, cut, len(rows)))
            todo += [(used, rows[left], depth + 1), (used + 1, rows[~left], depth + 1)]
            used += 2
        return pd.DataFrame(nodes, columns=["tree", "node", "left", "right", "feature", "cut", "size"])

    return grow


def fit_isolation_forest(df: DataFrame, key: str, features: Sequence[str] | str, trees: int = 100,
                         sample_size: int = 256, seed: int = 42) -> DataFrame:
    """The node table of the forest.

    A row is drawn by hashes of its key: one hash per pass decides whether and for which tree. On a
    large table one pass serves all trees; a small table needs several, since the trees share rows.
    The lowest hashes of a tree are kept, so a tree never holds more than ``sample_size`` rows.
    """
    rows = df.select(F.col(key).alias("k"), as_vector(df, features).alias("x"))
    n = rows.count()
    if n == 0:
        raise ValueError("no rows to fit")
    size = min(sample_size, n)
    # Twice the wanted rate makes a short sample very unlikely; the surplus is cut by rank.
    rate = min(1.0, 2.0 * size / n + 20.0 / n)
    per_pass = max(1, math.floor(1.0 / rate))           # trees that fit side by side into one hash
    passes = math.ceil(trees / per_pass)

    def draw(i):
        u = F.pmod(F.xxhash64(F.col("k"), i, F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
        slot = F.floor(u / rate)
        tree = (i * per_pass + slot).cast("int")
        return F.struct(F.when((slot < per_pass) & (tree < trees), tree).alias("tree"), u.alias("order"))

    drawn = F.inline(F.array(*[draw(F.lit(i)) for i in range(passes)]))
    picked = rows.select("k", "x", drawn).where(F.col("tree").isNotNull())
    w = Window.partitionBy("tree").orderBy("order", "k")            # about 2 * sample_size rows per tree
    sample = picked.withColumn("r", F.row_number().over(w)).where(F.col("r") <= size).select("tree", "order", "x")
    limit = max(1, math.ceil(math.log2(size)))
    return materialize(sample.groupBy("tree").applyInPandas(_grow(seed, limit), NODES), "forest")


def score_isolation_forest(df: DataFrame, forest: DataFrame, features: Sequence[str] | str, sample_size: int,
                           out: str = "anomaly") -> DataFrame:
    """Add the anomaly score in (0, 1): 2 ** (-mean path length / expected path length)."""
    nodes = forest.toPandas()                   # trees x (2 * sample_size - 1) rows at most
    packed = []
    for _, t in nodes.groupby("tree"):
        t = t.sort_values("node")
        packed.append((t["left"].to_numpy(), t["right"].to_numpy(), t["feature"].to_numpy(), t["cut"].to_numpy(),
                       np.array([average_path(s) for s in t["size"]])))
    shared = df.sparkSession.sparkContext.broadcast(packed)
    expected = average_path(sample_size) or 1.0

    def depth(batches):
        for xs in batches:
            x = np.stack(xs.to_numpy()) if len(xs) else np.zeros((0, 1))
            total = np.zeros(len(x))
            for left, right, feature, cut, rest in shared.value:
                at = np.zeros(len(x), dtype=int)
                steps = np.zeros(len(x))
                inner = left[at] >= 0
                while inner.any():
                    i = np.flatnonzero(inner)
                    node = at[i]
                    goes_left = x[i, feature[node]] <= cut[node]
                    at[i] = np.where(goes_left, left[node], right[node])
                    steps[i] += 1
                    inner[i] = left[at[i]] >= 0
                total += steps + rest[at]
            yield pd.Series(np.power(2.0, -(total / max(1, len(shared.value))) / expected))

    def typed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return depth(batches)

    typed.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    score = F.pandas_udf(typed, "double")
    return df.withColumn(out, score(as_vector(df, features)))


def isolation_outliers(df: DataFrame, key: str, features: Sequence[str], contamination: float = 0.05, trees: int = 100,
                       sample_size: int = 256, seed: int = 42) -> DataFrame:
    """Standardise, fit, score, and add ``anomaly`` and ``is_outlier`` for the ``contamination`` share
    of highest scores. ``key`` only drives the sampling. Columns without any value are left out. The input is evaluated once, and stored."""
    df = materialize(df, "outlier-input")
    parameters = scaling_parameters(df, features)
    features = [c for c in features if c in parameters]
    if not features:
        raise ValueError("no feature has a value")
    x = F.array(*[(F.col(c).cast("double") - a) / w for c, (a, w) in ((c, parameters[c]) for c in features)])
    n = stored_rows(df)
    prepared = df.withColumn("_x", x)
    forest = fit_isolation_forest(prepared, key, "_x", trees, sample_size, seed)
    scored = materialize(score_isolation_forest(prepared, forest, "_x", min(sample_size, n)).drop("_x"), "anomaly")
    cut = exact_quantiles(scored, ["anomaly"], [1.0 - contamination]).first()["value"]
    return scored.withColumn("is_outlier", (F.col("anomaly") > cut).cast("int"))
