"""Categorical encodings. Maps are small tables joined by a size-checked lookup."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.runtime import BROADCAST_ROWS, lookup_join, materialize, safe_div, stored_rows

# Values of a column that become columns of their own.
MAX_ONE_HOT = 1_000


def smoothed(n: Column, total: Column, overall: Column, m: float) -> Column:
    """weight * mean + (1 - weight) * overall with weight = 1 / (1 + exp(-(n - m) / m))."""
    weight = 1.0 / (1.0 + F.exp(-(n - F.lit(float(m))) / F.lit(float(m))))
    return F.coalesce(weight * safe_div(total, n) + (1.0 - weight) * overall, overall)


def category_stats(df: DataFrame, features: Sequence[str], label: str = "label", fold: str | None = None) -> DataFrame:
    """(feature, category[, fold], n, s): label count and sum per category of all features, stored.

    One scan serves every feature. Missing categories are kept, so each feature's rows add up to the
    whole table.
    """
    mixed = len({df.schema[f].dataType for f in features}) > 1      # one type keeps its type
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), (F.col(f).cast("string") if mixed else F.col(f)).alias("category"))
                      for f in features])
    extra = [fold] if fold else []
    stats = df.select(label, *extra, F.inline(cells)).groupBy("feature", "category", *extra).agg(
        F.count(label).alias("n"), F.sum(label).alias("s"))
    return materialize(stats, "category-stats")


def overall_mean(stats: DataFrame) -> float:
    """The label mean of the whole table, from the rows of any one feature."""
    row = stats.groupBy("feature").agg((F.sum("s") / F.sum("n")).alias("m")).first()
    return float(row["m"]) if row and row["m"] is not None else 0.0


def full_map(stats: DataFrame, feature: str, overall: float, m: float = 20) -> DataFrame:
    """(feature column, value): the smoothed label mean of every category."""
    own = stats.where((F.col("feature") == feature) & F.col("category").isNotNull())
    total = own.groupBy(F.col("category").alias(feature)).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    return total.select(feature, smoothed(F.col("n"), F.col("s"), F.lit(overall), m).alias("value"))


def fold_map(stats: DataFrame, feature: str, fold: str, overall: float, m: float = 20) -> DataFrame:
    """(feature column, fold, value): per fold the smoothed mean over the *other* folds, which is the
    category's total minus its own fold."""
    own = stats.where((F.col("feature") == feature) & F.col("category").isNotNull())
    w = Window.partitionBy("category")                      # at most one row per fold
    others = own.select(F.col("category").alias(feature), fold, (F.sum("n").over(w) - F.col("n")).alias("n"),
                        (F.sum("s").over(w) - F.col("s")).alias("s"))
    return others.select(feature, fold, smoothed(F.col("n"), F.col("s"), F.lit(overall), m).alias("value"))


def target_map(df: DataFrame, feature: str, label: str = "label", m: float = 20) -> DataFrame:
    stats = category_stats(df, [feature], label)
    return full_map(stats, feature, overall_mean(stats), m)


def apply_map(df: DataFrame, table: DataFrame, keys: Sequence[str], default, out: str) -> DataFrame:
    """Add the table's value for the row's keys; unknown and missing categories get ``default``."""
    renamed = table.select(*keys, F.col("value").alias("_value"))
    return (lookup_join(df, renamed, keys)
            .withColumn(out, F.coalesce(F.col("_value"), F.lit(default))).drop("_value"))


def target_encode(df: DataFrame, feature: str, label: str = "label", m: float = 20, out: str | None = None) -> DataFrame:
    stats = category_stats(df, [feature], label)
    overall = overall_mean(stats)
    return apply_map(df, full_map(stats, feature, overall, m), [feature], overall, out or f"{feature}_encoded")


def hash_fold(keys: Sequence[str], folds: int, seed: int = 42) -> Column:
    """A fold number that depends on the row's key and the seed only."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(folds)).cast("int")


def target_encode_oof(df: DataFrame, feature: str, fold: str, label: str = "label", m: float = 20,
                      out: str | None = None) -> DataFrame:
    """Every row is encoded with the label statistics of the other folds; the overall mean is over all rows."""
    stats = category_stats(df, [feature], label, fold)
    overall = overall_mean(stats)
    return apply_map(df, fold_map(stats, feature, fold, overall, m), [feature, fold], overall, out or f"{feature}_encoded")


def label_map(df: DataFrame, feature: str, checked_rows: int = BROADCAST_ROWS,
              rows_per_range: int = 1_000_000) -> DataFrame:
    """(feature, value): 0, 1, … over the sorted distinct values.

    A large domain is sorted by ranges: the range number is stored with the values, ranges are
    counted, and each is numbered from the total of the earlier ones.
    """
    distinct = materialize(df.where(F.col(feature).isNotNull()).select(feature).distinct(), "classes")
    n = stored_rows(distinct)
    if n <= checked_rows:
        w = Window.partitionBy(F.lit(0)).orderBy(feature)
        return distinct.select(feature, (F.row_number().over(w) - 1).cast("long").alias("value"))
    ranges = materialize(
        distinct.repartitionByRange(math.ceil(n / rows_per_range) + 1, feature)
        .withColumn("_part", F.spark_partition_id()), "class-ranges")
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("_part").agg(F.count("*").alias("c")).select(
        "_part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_part").orderBy(feature)
    return (ranges.join(F.broadcast(offsets), "_part")      # one row per range
            .select(feature, (F.col("_off") + F.row_number().over(w) - 1).cast("long").alias("value")))


def label_encode(df: DataFrame, feature: str, table: DataFrame | None = None, unknown: str = "error",
                 out: str | None = None) -> DataFrame:
    """Class numbers of a text column. ``unknown``: 'error' fails the job on a value that the map
    does not hold, 'keep' gives it -1."""
    if unknown not in ("error", "keep"):
        raise ValueError(f"unknown policy: {unknown}")
    out = out or f"{feature}_code"
    table = materialize(label_map(df, feature), "label-map") if table is None else table
    joined = lookup_join(df, table.select(feature, F.col("value").alias("_code")), [feature])
    missing = (F.lit(-1).cast("long") if unknown == "keep" else
               F.raise_error(F.concat(F.lit(f"unseen value in {feature}: "), F.coalesce(F.col(feature), F.lit("NULL")))).cast("long"))
    return joined.withColumn(out, F.when(F.col("_code").isNotNull(), F.col("_code")).otherwise(missing)).drop("_code")


def categories(df: DataFrame, feature: str, output: str = "columns", limit: int = MAX_ONE_HOT) -> list[str] | DataFrame:
    """What ``one_hot`` needs: the sorted distinct values as text for 'columns', a stored (feature, value) map of them for 'vector'.

    The output is the caller's choice and does not depend on the data; more than ``limit`` columns are refused, a vector holds any number.
    """
    if output not in ("columns", "vector"):
        raise ValueError(f"unknown one-hot output: {output}")
    text = df.select(F.col(feature).cast("string").alias(feature)).where(F.col(feature).isNotNull())
    if output == "vector":
        return materialize(label_map(text, feature), "one-hot-map")
    rows = text.distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{feature} has more than {limit} values for columns of their own; choose the vector output")
    return sorted(r[feature] for r in rows)


def one_hot(df: DataFrame, feature: str, values: Sequence[str] | DataFrame, size: int | None = None) -> DataFrame:
    """``{feature}_{value}`` per value and ``{feature}_nan``; the original column is dropped.

    With a map instead of a list, one sparse vector ``{feature}_onehot``: a slot per value in the map's order and a
    last one for missing cells. ``size``, the map's number of values, is counted if not given.
    """
    if isinstance(values, DataFrame):
        return _one_hot_vector(df, feature, values, values.count() if size is None else size)
    x = F.col(feature).cast("string")
    flags = {f"{feature}_{v}": F.coalesce(x == v, F.lit(False)).cast("int") for v in values}
    return df.withColumns({**flags, f"{feature}_nan": x.isNull().cast("int")}).drop(feature)


def _one_hot_vector(df: DataFrame, feature: str, table: DataFrame, size: int) -> DataFrame:
    out = f"{feature}_onehot"
    coded = lookup_join(df.withColumn(feature, F.col(feature).cast("string")), table.select(feature, F.col("value").alias("_code")), [feature])
    # A number beyond the slots is a value the map does not hold; it gets no flag, as with columns.
    slot = F.when(F.col(feature).isNull(), size).otherwise(F.coalesce("_code", F.lit(size + 1))).cast("double")
    encoder = OneHotEncoder(inputCols=["_slot"], outputCols=[out], handleInvalid="keep", dropLast=True).fit(
        df.sparkSession.createDataFrame([(float(size),)], "_slot double"))
    return encoder.transform(coded.withColumn("_slot", slot)).drop(feature, "_code", "_slot").withMetadata(
        out, {"ml_attr": {"num_attrs": size + 1}})
