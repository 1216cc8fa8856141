"""Time-based train/validation splits with disjoint entities."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.operators.prefix import ROWS_PER_RANGE, rank_cutoff, running_sums
from panelwright.runtime import lookup_join, materialize, quoted, safe_div, stored_rows

# Periods that may stand in for a wanted cut, by their distance from it, the preferred ones first.
NEARBY = (0, -1, 1, -2, 2)


@dataclass(frozen=True)
class Split:
    """Train: period <= cut - gap. Validation: period > cut, without entities seen in train."""
    cut: int
    gap: int
    n_train: int
    n_val: int


def first_periods(df: DataFrame, entity: str, period: str) -> DataFrame:
    return df.groupBy(entity).agg(F.min(period).alias("_first"))


def with_first_period(df: DataFrame, entity: str, period: str) -> DataFrame:
    """Add the entity's earliest period. An entity is in train exactly when that period is."""
    return lookup_join(df, materialize(first_periods(df, entity, period), "first-period"), [entity])


def roles(period: Column, first: Column, cut: int, gap: int, disjoint: bool = True) -> Column:
    """'train', 'val' or NULL for rows in neither."""
    after = period > cut
    if disjoint:
        after = after & (first > cut - gap)
    return F.when(period <= cut - gap, "train").when(after, "val")


def cut_marks(df: DataFrame, entity: str, period: str, label: str, gap: int, disjoint: bool) -> DataFrame:
    """(at, train, val, pos, all_pos, known), stored: what changes when the cut reaches ``at``; a few rows per period.

    A row trains for every cut from its period + gap on. It validates for every cut below its period and, with
    disjoint entities, below its entity's first period + gap; so both need one number per row. ``known`` marks
    the periods themselves. Rows without a period play no role.
    """
    whole = isinstance(df.schema[period].dataType, T.IntegralType)
    p_type, zero, none = "long" if whole else "double", F.lit(0).cast("long"), F.lit(0.0)
    y = F.coalesce(F.col(label).cast("double"), none)
    # Rows are counted per entity and period before anything else; the first period is found among those counts.
    counts = df.where(F.col(period).isNotNull()).groupBy(F.col(entity).alias("_e"), F.col(period).cast(p_type).alias("_p")).agg(
        F.count("*").alias("_n"), F.sum(y).alias("_y"))
    p, n, pos = F.col("_p"), F.col("_n"), F.col("_y")
    if disjoint:                                                        # rows without an entity have no first period
        counts = counts.withColumn("_first", F.when(F.col("_e").isNotNull(), F.min("_p").over(Window.partitionBy("_e"))))
        until = F.when(F.col("_first").isNotNull(), F.least(p, F.col("_first") + gap))
    else:
        until = p

    def mark(at: Column, train: Column, val: Column, pos: Column, all_pos: Column, known: int) -> Column:
        return F.struct(at.cast(p_type).alias("at"), train.alias("train"), val.alias("val"), pos.alias("pos"),
                        all_pos.alias("all_pos"), F.lit(known).alias("known"))

    marks = counts.select(F.inline(F.array(mark(p + gap, n, zero, none, pos, 0), mark(until, zero, n, pos, none, 0),
                                           mark(p.cast("long"), zero, zero, none, none, 1))))
    return materialize(marks.where(F.col("at").isNotNull()).groupBy("at").agg(
        *[F.sum(c).alias(c) for c in ("train", "val", "pos", "all_pos")], F.max("known").alias("known")), "cut-marks")


def _whole(marks: DataFrame) -> tuple[int, float, float]:
    """(validating rows, their positives, share of positives among all rows)."""
    t = marks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("train", "val", "pos", "all_pos")]).first()
    return t["val"], t["pos"], t["all_pos"] / t["train"] if t["train"] else 0.0


def candidate_table(df: DataFrame, entity: str, period: str, label: str, gap: int = 1, disjoint: bool = True,
                    rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(cut, n_train, n_val, val_rate, prevalence_gap) for every period as a cut."""
    marks = cut_marks(df, entity, period, label, gap, disjoint)
    val, pos, overall = _whole(marks)
    sums = running_sums(marks, "at", {"n_train": "train", "_val": "val", "_pos": "pos"}, rows_per_range=rows_per_range)
    kind = "int" if not isinstance(df.schema[period].dataType, T.LongType) else "long"
    n_val = F.lit(val) - F.col("_val")
    rate = safe_div(F.lit(pos) - F.col("_pos"), n_val)
    return sums.where("known = 1").select(
        F.col("at").cast(kind).alias("cut"), F.col("n_train").cast("long").alias("n_train"), n_val.cast("long").alias("n_val"),
        rate.alias("val_rate"), F.abs(rate - F.lit(overall)).alias("prevalence_gap"))


def _at_rank(hist: DataFrame, order: str, known: str, ranks: Sequence[int], rows_per_range: int) -> dict[int, object]:
    """{rank: value} of the ``known`` rows with the given ranks (a few), counted from 1."""
    ranked = running_sums(hist, order, {"_rank": known}, rows_per_range=rows_per_range)
    found = ranked.where((F.col(known) == 1) & F.col("_rank").isin(sorted(set(ranks)))).select("_rank", order).collect()
    return {int(r["_rank"]): r[order] for r in found}


class StratifiedTemporalSplitter:
    """Cut periods near given quantiles whose validation prevalence is closest to the overall one."""

    def __init__(self, n_splits: int = 5, test_size: float = 0.2, gap: int = 1, period: str = "year",
                 entity: str = "patient_id", label: str = "target", group_disjoint: bool = True, rows_per_range: int = ROWS_PER_RANGE):
        self.rows_per_range = rows_per_range
        self.n_splits, self.test_size, self.gap = n_splits, test_size, gap
        self.period, self.entity, self.label, self.group_disjoint = period, entity, label, group_disjoint

    def cuts(self, df: DataFrame) -> list[Split]:
        """The chosen cuts; empty when only the chronological fallback applies. What is collected grows with ``n_splits`` only."""
        marks = cut_marks(df, self.entity, self.period, self.label, self.gap, self.group_disjoint)
        inner = marks.where("known = 1").count() - 2
        if inner < 1:
            return []
        # The wanted quantiles of the periods between the first and the last one, from the two neighbours of each.
        places = [q * (inner - 1) for q in np.linspace(0.2, 0.8, self.n_splits)]
        at = _at_rank(marks, "at", "known", [r + 2 for x in places for r in (math.floor(x), math.ceil(x))], self.rows_per_range)
        aims = []
        for x in places:
            low, high = int(at[math.floor(x) + 2]), int(at[math.ceil(x) + 2])
            aims.append(int(np.quantile([low, high], x - math.floor(x))))
        val, pos, overall = _whole(marks)
        wanted = sorted({aim + d for aim in aims for d in NEARBY})
        cuts = df.sparkSession.createDataFrame([(w,) for w in wanted], "cut long")
        reached = marks.join(F.broadcast(cuts), F.col("at") <= F.col("cut")).groupBy("cut").agg(
            *[F.sum(c).alias(c) for c in ("train", "val", "pos")],
            F.max(F.when(F.col("at") == F.col("cut"), F.col("known"))).alias("known")).collect()
        known: set[int] = set()
        gaps: dict[int, float] = {}
        found: dict[int, Split] = {}
        for r in reached:
            cut, n_train, n_val = r["cut"], int(r["train"]), int(val - r["val"])
            if r["known"]:
                known.add(cut)
            if n_train and n_val:
                gaps[cut], found[cut] = abs((pos - r["pos"]) / n_val - overall), Split(cut, self.gap, n_train, n_val)
        # An aim takes the smallest gap within two periods; among equal gaps the earlier entry of NEARBY. Aims without rows on both sides fall out.
        picks = [min((aim + d for d in NEARBY if aim + d in found and (not d or aim + d in known)), key=gaps.get) for aim in aims if aim in found]
        # Equal sizes mean equal sets here: training sets are nested in the cut.
        different: dict[tuple[int, int], Split] = {}
        for p in picks:
            different.setdefault((found[p].n_train, found[p].n_val), found[p])
        return list(different.values())[:self.n_splits]

    def split(self, df: DataFrame, order: Sequence[str] | None = None, cuts: list[Split] | None = None) -> list[tuple[DataFrame, DataFrame]]:
        """(train, validation) frames; the chronological fallback when no cut works. ``cuts`` are found unless given."""
        cuts = self.cuts(df) if cuts is None else cuts
        if not cuts:
            return [chronological(df, order or [self.period, self.entity], self.test_size, self.gap)]
        # Stored once: every fold is then a filter on two columns that reaches the scan.
        tagged = materialize(with_first_period(df, self.entity, self.period), "tagged")
        out = []
        for s in cuts:
            role = roles(F.col(self.period), F.col("_first"), s.cut, s.gap, self.group_disjoint)
            out.append((tagged.where(role == "train").drop("_first"), tagged.where(role == "val").drop("_first")))
        return out


def chronological_role(df: DataFrame, order: Sequence[str], test_size: float = 0.2, gap: int = 1,
                       rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``role`` by row order: of the n rows with a period (``order``'s first column), the first n·(1 - test_size) - gap train, those
    from n·(1 - test_size) on validate, the gap between has none. Rows without a period have no role and no place."""
    dated = F.col(quoted(order[0])).isNotNull()
    known = df.where(dated)
    cut = int(known.count() * (1 - test_size))
    keys = [(c, False) for c in order]
    train = rank_cutoff(known, keys, max(0, cut - gap), rows_per_range)
    before_val = rank_cutoff(known, keys, cut, rows_per_range)
    role = F.when(dated & train if train is not None else F.lit(False), "train")
    late = ~before_val if before_val is not None else F.lit(True)
    return df.withColumn("role", role.when(dated & late, "val"))


def chronological(df: DataFrame, order: Sequence[str], test_size: float = 0.2, gap: int = 1):
    tagged = chronological_role(df, order, test_size, gap)
    return tagged.where("role = 'train'").drop("role"), tagged.where("role = 'val'").drop("role")


def last_periods_role(df: DataFrame, period: str, gap: int = 1, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``role``: the last fifth of the distinct periods validates."""
    periods = materialize(df.where(F.col(period).isNotNull()).select(period).distinct().withColumn("_one", F.lit(1)), "periods")
    n = stored_rows(periods)
    if n < 2:
        raise ValueError("needs at least two periods; use the chronological split")
    rank = int(n * 0.8) + 1
    cut = _at_rank(periods, period, "_one", [rank], rows_per_range)[rank]
    return df.withColumn("role", F.when(F.col(period) <= cut - gap, "train").when(F.col(period) > cut, "val"))


def without_entities(df: DataFrame, others: DataFrame, entity: str) -> DataFrame:
    """Rows whose entity does not occur in ``others``."""
    return df.join(others.select(entity).distinct(), entity, "left_anti")


def entity_overlap(a: DataFrame, b: DataFrame, entity: str) -> DataFrame:
    """Entities present on both sides; empty for a sound split."""
    return a.select(entity).intersect(b.select(entity))
