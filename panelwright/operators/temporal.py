"""Rolling, trend and lag features per entity.

A window covers the last k *rows* of the entity up to the current one, not k calendar periods.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.operators.prefix import LEAST_TOTALS, in_ranges, running_sums
from panelwright.runtime import materialize, null_safe_join, require_columns, stored_rows

AGGREGATIONS = ("mean", "std", "min", "max", "trend")
# An entity above this many rows is cut into pieces; below it its rows fit one window buffer.
HOT_ENTITY_ROWS = 500_000


def detect_features(df: DataFrame, entity: str, period: str, exclude: Sequence[str] = ("age", "target")) -> list[str]:
    """Numeric columns other than the keys and the excluded ones."""
    skip = {entity, period, *exclude}
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def feature_names(features: Sequence[str], k: int, aggs: Sequence[str], lag: bool = True) -> list[str]:
    rolled = [f"{f}_rolling_{a}_{k}y" for f in features for a in aggs]
    return rolled + ([f"{f}_lag_1y" for f in features] if lag else [])


def _windowed(features, period, k, min_periods, aggs, lag, partition, order) -> dict[str, Column]:
    rows = Window.partitionBy(*partition).orderBy(*order)
    frame = rows.rowsBetween(-(k - 1), 0)

    def filled(agg, f):
        enough = F.count(f).over(frame) >= max(min_periods, 1)
        return F.coalesce(F.when(enough, agg(F.col(f)).over(frame)).cast("double"), F.lit(0.0))

    def slope(f):
        n = F.count(F.lit(1)).over(frame)
        complete = (n >= 2) & (F.count(f).over(frame) == n)
        x, y = F.col(period).cast("double"), F.col(f).cast("double")
        return F.coalesce(F.when(complete, F.regr_slope(y, x).over(frame)), F.lit(0.0))

    simple = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    out = {}
    for f in features:
        for a in aggs:
            out[f"{f}_rolling_{a}_{k}y"] = slope(f) if a == "trend" else filled(simple[a], f)
    if lag:
        for f in features:
            out[f"{f}_lag_1y"] = F.coalesce(F.lag(f, 1).over(rows).cast("double"), F.lit(0.0))
    return out


def rolling_features(df: DataFrame, entity: str, period: str, features: Sequence[str] | None = None,
                     k: int = 3, min_periods: int = 1, aggs: Sequence[str] = ("mean", "std", "trend"),
                     lag: bool = True, bounded_entities: bool = False,
                     hot_rows: int = HOT_ENTITY_ROWS) -> DataFrame:
    """Add ``{f}_rolling_{agg}_{k}y`` and ``{f}_lag_1y`` columns; gaps are filled with 0.

    All columns share one window specification: one shuffle, one sort. ``bounded_entities`` states
    that an entity has few rows (for instance one per year, as after a group-by on entity and
    year). Without it the row count per entity is checked, and an entity above ``hot_rows`` is
    windowed in pieces, so no task has to hold it whole.
    """
    require_columns(df, [entity, period])
    unknown = [a for a in aggs if a not in AGGREGATIONS]
    if unknown:
        raise ValueError(f"unknown aggregations: {unknown}")
    features = [f for f in (features or detect_features(df, entity, period)) if f in df.columns]
    order = [period]
    if not bounded_entities:
        # Rows of one entity and period have no order of their own: a row hash makes it repeatable.
        df = df.withColumn("_tie", F.xxhash64(*df.columns))
        order = [period, "_tie"]
        hot = materialize(df.groupBy(entity).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows), "hot")
        if stored_rows(hot):
            # At most rows / hot_rows entities; NULL is one like others.
            same = df[entity].eqNullSafe(F.col("_hot"))
            hot = F.broadcast(hot.select(F.col(entity).alias("_hot")))
            calm, busy = df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")
            done = calm.withColumns(_windowed(features, period, k, min_periods, aggs, lag, [entity], order))
            return done.unionByName(
                _in_pieces(busy, entity, period, features, k, min_periods, aggs, lag, hot_rows)).drop("_tie")
    out = df.withColumns(_windowed(features, period, k, min_periods, aggs, lag, [entity], order))
    return out.drop("_tie") if not bounded_entities else out


def _in_pieces(df, entity, period, features, k, min_periods, aggs, lag, piece_rows):
    """Windows over hot entities: every row gets its ordinal, ordinals are cut into pieces, and each
    piece borrows the rows just before it, which are dropped again after the window."""
    # The low bits of the tie-break separate exact copies of a row; writing the table fixes them.
    low = F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(1 << 24))
    fixed = materialize(df.withColumn("_tie", F.shiftleft(F.shiftright("_tie", 24), 24) + low), "hot-rows")
    numbered = materialize(row_ordinal(fixed, entity, period, "_tie", rows_per_range=piece_rows), "ordinal")
    halo = max(k - 1, 1)
    piece = F.floor(F.col("_ordinal") / piece_rows)
    lent = numbered.where(F.col("_ordinal") % piece_rows >= piece_rows - halo)
    both = (numbered.withColumns({"_piece": piece, "_lent": F.lit(False)})
            .unionByName(lent.withColumns({"_piece": piece + 1, "_lent": F.lit(True)})))
    return (both.withColumns(_windowed(features, period, k, min_periods, aggs, lag,
                                       [entity, "_piece"], ["_ordinal"]))
            .where(~F.col("_lent")).drop("_piece", "_lent", "_ordinal"))


def row_ordinal(df: DataFrame, entity: str, period: str, tie: str, out: str = "_ordinal",
                rows_per_range: int = HOT_ENTITY_ROWS) -> DataFrame:
    """0, 1, 2, … per entity in (period, tie) order, for entities and periods of any size.

    The rows are dealt to ranges in the order of all three; a row's number is its place among its entity's rows of the range, after those of
    the ranges before. ``df`` is read several times: pass a materialized table.
    """
    total = stored_rows(df)
    tagged = in_ranges(df, [entity, period, tie], df.count() if total is None else total, rows_per_range)
    sizes = materialize(tagged.groupBy(entity, "_range").agg(F.count("*").alias("_m")), "ordinal-sizes")
    sums = running_sums(sizes, "_range", {"_up_to": "_m"}, by=[entity], rows_per_range=max(LEAST_TOTALS, rows_per_range))
    first = sums.select(entity, "_range", (F.col("_up_to") - F.col("_m")).alias("_first"))
    w = Window.partitionBy(entity, "_range").orderBy(period, tie)
    return (null_safe_join(tagged, first, [entity, "_range"])
            .withColumn(out, F.col("_first") + F.row_number().over(w) - 1).drop("_first", "_range"))


def entity_ordinal(df: DataFrame, entity: str, period: str, out: str = "ordinal", bounded_entities: bool = False) -> DataFrame:
    """Position of the row in its entity's history (0, 1, …); one row per entity and period."""
    return running_total(df.withColumn("_one", F.lit(1)), entity, period, "_one", out, bounded_entities).withColumn(
        out, F.col(out) - 1).drop("_one")


def running_total(df: DataFrame, entity: str, period: str, value: str, out: str, bounded_entities: bool = False,
                  rows_per_range: int = HOT_ENTITY_ROWS) -> DataFrame:
    """Sum of the entity's values up to and including the current row; one row per entity and period.

    Unless the entities are known to be small, their sizes are checked and a large one is summed in
    ranges of the period.
    """
    if bounded_entities:
        w = Window.partitionBy(entity).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(value).over(w))
    return running_sums(materialize(df, "running"), period, {out: value}, by=[entity], rows_per_range=rows_per_range)
