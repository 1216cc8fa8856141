"""Class rebalancing: synthetic minority rows and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.operators.neighbors import nearest_neighbors
from panelwright.operators.prefix import rank_cutoff
from panelwright.runtime import lookup_join, materialize


def class_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Add n / (2 * n_class) per row."""
    counts = df.agg(F.count(label).alias("n"), F.sum(label).alias("p")).first()
    n, p = counts["n"], counts["p"] or 0
    if p in (0, n):
        raise ValueError("class weights need both classes")
    return df.withColumn(out, F.when(F.col(label) == 1, n / (2.0 * p)).otherwise(n / (2.0 * (n - p))))


def synthetic_count(n_minority: int, n_majority: int, ratio: float) -> int:
    """Rows to add so that the minority reaches ``ratio`` times the majority."""
    new = int(ratio * n_majority - n_minority)
    if new < 0:
        raise ValueError("the ratio is below the one already present")
    return new


def _draw(seed: int, *parts: Column) -> Column:
    """A repeatable number in [0, 1) per row."""
    return F.pmod(F.xxhash64(*parts, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _between(first: int, width: int) -> Column:
    """The slots from ``first`` on at the random share of the way."""
    return F.transform(F.slice("_x", first + 1, width), lambda x, j: x + F.col("_u") * (F.get("_y", j + first) - x))


def neighbors_for(rows: int) -> int:
    """Neighbours to draw from when none are configured. One for every 50 rows, at most 3."""
    return min(3, max(1, rows // 50))


def smote(df: DataFrame, features: Sequence[str], key: str, label: str = "label", ratio: float = 0.1, k: int | None = 5,
          seed: int = 42, minority: int = 1) -> DataFrame:
    """Append synthetic minority rows with ``is_synthetic`` = 1.

    Each new row lies between a minority row and one of its k nearest minority neighbours, at a
    random share of the way; vector columns among the features mix slot by slot. New rows are spread evenly over the minority rows; which rows get one
    more, the neighbour and the share depend on the key and the seed only. Columns other than the
    features and the label are NULL in synthetic rows. With ``k`` None the number of rows decides it.
    """
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).where(
        F.col(label).isin(0, 1)).collect()}
    n_min, n_maj = counts.get(minority, 0), counts.get(1 - minority, 0)
    new = synthetic_count(n_min, n_maj, ratio)
    tagged = df.withColumn("is_synthetic", F.lit(0))
    if new == 0:
        return tagged
    k = neighbors_for(n_min + n_maj) if k is None else k
    if n_min <= k:
        raise ValueError(f"{k} neighbours need more than {k} minority rows, found {n_min}")
    vectors = [f.name for f in df.schema if f.name in features and isinstance(f.dataType, VectorUDT)]
    held = df.select(*[F.size(vector_to_array(c)).alias(c) for c in vectors]).first().asDict() if vectors else {}
    width = [held.get(c, 1) for c in features]
    parts = [vector_to_array(c) if c in vectors else F.array(F.col(c).cast("double")) for c in features]
    small = materialize(df.where(F.col(label) == minority).select(
        F.col(key).cast("long").alias("_id"), F.concat(*parts).alias("_x"),
        F.xxhash64(F.col(key), F.lit(seed)).alias("_h")), "minority")
    base, extra = divmod(new, n_min)
    more = rank_cutoff(small, [("_h", False), ("_id", False)], extra)
    copies = F.lit(base) + (F.lit(0) if more is None else more.cast("int"))
    wanted = small.withColumn("_copies", copies).where(F.col("_copies") > 0)
    near = nearest_neighbors(small, "_id", "_x", k)
    drawn = (wanted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
             .withColumn("rank", (F.floor(_draw(seed, F.col("_id"), F.col("_copy"), F.lit("who")) * k) + 1).cast("int")))
    pairs = drawn.join(near.select("_id", "neighbor", "rank"), ["_id", "rank"])
    # A row that many others are near to is met by many pairs: the lookup splits them.
    partner = materialize(small.select(F.col("_id").alias("neighbor"), F.col("_x").alias("_y")), "partners")
    share = _draw(seed, F.col("_id"), F.col("_copy"), F.lit("far"))
    mixed = lookup_join(pairs, partner, ["neighbor"], "inner").select(
        "_x", "_y", share.alias("_u"))
    types = {f.name: f.dataType for f in df.schema}
    cols = []
    for c in df.columns:
        if c in features:
            i = sum(width[:list(features).index(c)])
            cols.append((array_to_vector(_between(i, held[c])) if c in vectors else F.col("_x")[i] + F.col("_u") * (F.col("_y")[i] - F.col("_x")[i])).alias(c))
        elif c == label:
            cols.append(F.lit(minority).cast(types[c]).alias(c))
        else:
            cols.append(F.lit(None).cast(types[c]).alias(c))
    synthetic = mixed.select(*cols, F.lit(1).alias("is_synthetic"))
    doubles = tagged.withColumns({c: F.col(c).cast("double") for c in features if c not in vectors})
    return doubles.unionByName(synthetic)
