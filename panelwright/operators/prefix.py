"""Running sums and order statistics over a global order, without a single-task sort.

All inputs are *histograms*: tables unique on (by, order) that carry additive counts. The rows are dealt, in the order of
(by, order), to ranges of about equal row counts. Spark samples the bounds from the columns themselves, so they have the columns' own
types: long texts that begin alike, dates and decimals part as well as numbers do, and the rows of a large group lie in
neighbouring ranges. The number of its range is stored with every row, so a recomputed task sees the same ranges. A range is summed
on its own; the totals of the earlier ranges of a group are added, and are themselves summed by ranges where there are many.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.runtime import materialize, null_safe_join, quoted, stored_rows

ROWS_PER_RANGE = 250_000
# Totals of a group that one window may hold however small the ranges are; below it a further level costs more than it saves.
LEAST_TOTALS = 16


def in_ranges(df: DataFrame, order: Sequence[str], total: int, rows_per_range: int = ROWS_PER_RANGE, out: str = "_range") -> DataFrame:
    """``df``, stored, with the number of the range each row lies in; ranges follow the ascending order, NULL first.

    Rows that are equal in all columns of ``order`` share a range.
    """
    ranges = max(1, math.ceil(total / rows_per_range))
    return materialize(df.repartitionByRange(ranges, *[F.col(quoted(c)) for c in order]).withColumn(out, F.spark_partition_id()), "ranges")


def _sizes(hist: DataFrame, by: Sequence[str], rows_per_range: int) -> tuple[int, int]:
    """(rows of the largest group, all rows); the count of a stored table that is small anyway comes from its files."""
    known = stored_rows(hist)
    if known is not None and known <= rows_per_range:
        return known, known
    groups = hist.groupBy(*by).agg(F.count("*").alias("_rows")) if by else hist.agg(F.count("*").alias("_rows"))
    largest, total = groups.agg(F.max("_rows"), F.sum("_rows")).first()
    return largest or 0, total or 0


def running_sums(hist: DataFrame, order: str, sums: dict[str, str], by: Sequence[str] = (),
                 descending: bool = False, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add inclusive running sums ``{output: input}`` along ``order`` inside each ``by`` group.

    ``hist`` is read several times: pass a materialized table. NULL comes first, or last if descending.
    """
    return _sums(hist, order, sums, list(by), descending, rows_per_range, Window.currentRow)


def _sums(hist: DataFrame, order: str, sums: dict[str, str], by: list[str], descending: bool, rows_per_range: int, end: int, level: int = 0) -> DataFrame:
    """Running sums up to the row itself (``end`` 0) or the one before it (-1). ``level`` counts how often ranges were summed by ranges."""
    largest, total = _sizes(hist, by, rows_per_range)
    direction = F.desc if descending else F.asc
    keys = [F.col(quoted(c)) for c in by]

    def up_to(*group: Column):
        return Window.partitionBy(*(group or [F.lit(0)])).orderBy(direction(quoted(order))).rowsBetween(Window.unboundedPreceding, end)

    if largest <= rows_per_range:
        return hist.withColumns({out: F.sum(quoted(src)).over(up_to(*keys)) for out, src in sums.items()})
    part = f"_range{level}"
    tagged = in_ranges(hist, [*by, order], total, rows_per_range, part)
    totals = materialize(tagged.groupBy(*keys, part).agg(*[F.sum(quoted(s)).alias(f"_t_{o}") for o, s in sums.items()]), "range-totals")
    # A group has one row for each range it touches.
    before = _sums(totals, part, {f"_o_{o}": f"_t_{o}" for o in sums}, by, descending, max(LEAST_TOTALS, rows_per_range), -1, level + 1)
    offsets = before.select(*keys, part, *[f"_o_{o}" for o in sums])
    inside = up_to(*keys, F.col(part))

    def whole(name: str, source: str) -> Column:                              # NULL until the first value, as in one window
        own, earlier = F.sum(quoted(source)).over(inside), F.col(f"_o_{name}")
        return F.coalesce(own + earlier, own, earlier)

    return (null_safe_join(tagged, offsets, [*by, part]).withColumns({o: whole(o, s) for o, s in sums.items()})
            .drop(part, *[f"_o_{o}" for o in sums]))


def rank_cutoff(df: DataFrame, order: Sequence[tuple[str, bool]], n: int,
                rows_per_range: int = ROWS_PER_RANGE) -> Column | None:
    """A predicate that holds for exactly the first ``n`` rows of ``df`` in the given order.

    ``order`` lists (column, descending) pairs; together they must be unique. NULL comes after all values, in either
    direction. The rows are never sorted: per order column one histogram finds the value the n-th row has, and only rows
    tied on it go on to the next column. None means the predicate holds for no row.
    """
    if n <= 0:
        return None
    rest, tied, accepted = df, None, F.lit(False)
    for name, descending in order:
        c = F.col(quoted(name))
        hist = materialize(rest.groupBy(c.alias("_value")).agg(F.count("*").alias("_cnt")), "rank")
        filled, empty = hist.agg(F.sum(F.when(F.col("_value").isNotNull(), F.col("_cnt"))), F.sum(F.when(F.col("_value").isNull(), F.col("_cnt")))).first()
        filled, empty = filled or 0, empty or 0
        if n > filled + empty:            # n exceeds the rows: take all of them
            return accepted | (tied if tied is not None else F.lit(True))
        scope = (lambda x: x if tied is None else tied & x)
        if n > filled:
            accepted, equal, reached, own = accepted | scope(c.isNotNull()), c.isNull(), filled + empty, empty
        else:
            known = materialize(hist.where(F.col("_value").isNotNull()), "rank-known") if empty else hist
            cum = running_sums(known, "_value", {"_cum": "_cnt"}, descending=descending, rows_per_range=rows_per_range)
            value, reached, own = cum.where(F.col("_cum") >= n).orderBy("_cum").select("_value", "_cum", "_cnt").first()
            ahead = c > F.lit(value) if descending else c < F.lit(value)
            accepted, equal = accepted | scope(F.coalesce(ahead, F.lit(False))), c.eqNullSafe(F.lit(value))
        if reached == n:
            return accepted | scope(equal)
        n -= reached - own
        tied = scope(equal)
        rest = rest.where(equal)
    raise ValueError("the order columns do not identify a row; add a unique one")
