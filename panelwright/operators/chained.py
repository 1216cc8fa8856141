"""Missing numbers from the other columns: chained regressions, and the mean of the nearest donors."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.rules import number
from panelwright.operators import blocks
from panelwright.operators.blocks import nearest_of
from panelwright.operators.gram import FAN_IN, cells_of, matrix
from panelwright.runtime import lookup_join, materialize, quoted, stored_rows

BLOCK = 4_096            # rows of a cell, about
TREE_ROWS = 1 << 16      # rows from which the cells are learnt, at most
TREE_NUMBERS = 1 << 20   # numbers of these rows, at most
BOUND_ROWS = 4_096       # of them, rows that give the first bounds
SUMS = "target int, part int, cell array<double>"


@dataclass
class ChainedFill:
    """Regressions of each column on all others, one set a round, in units of the columns' deviations."""

    columns: list[str]
    center: list[float]
    width: list[float]
    rounds: list[dict[int, list[float]]] = field(default_factory=list)     # target -> intercept and one weight a column

    def state(self) -> dict:
        """Plain values, for a fitted stage."""
        return {**asdict(self), "rounds": [{str(k): v for k, v in r.items()} for r in self.rounds]}

    @classmethod
    def of(cls, state: dict) -> ChainedFill:
        return cls(**{**state, "rounds": [{int(k): v for k, v in r.items()} for r in state["rounds"]]})

    def standard(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.center)) / np.array(self.width)

    def filled(self, z: np.ndarray) -> np.ndarray:
        """Standardised rows with their gaps filled: means first, then every round from the one before it."""
        gaps = np.isnan(z)
        out = np.where(gaps, 0.0, z)
        for weights in self.rounds:
            with_one = np.concatenate([np.ones((len(out), 1)), out], axis=1)
            fresh = out.copy()
            for j, w in weights.items():
                rows = gaps[:, j]
                fresh[rows, j] = with_one[rows] @ np.array(w)
            out = fresh
        return out


def _moments(fill: ChainedFill, targets: Sequence[int]):
    width = len(fill.columns)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, part = np.zeros((len(targets), width + 1, width + 1)), None
        for batch in stream:
            z = fill.standard(matrix(batch.column("x"), width))
            rows = np.concatenate([np.ones((len(z), 1)), fill.filled(z)], axis=1)
            for i, j in enumerate(targets):
                own = rows[~np.isnan(z[:, j])]
                sums[i] += own.T @ own
            part = batch.column("part")[0].as_py()
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array(targets, pa.int32()), pa.array([part] * len(targets), pa.int32()),
                                              pa.array([s.ravel() for s in sums], pa.list_(pa.float64()))], ["target", "part", "cell"])

    return run


def _added(group: pa.Table) -> pa.Table:
    total = sum(v.values.to_numpy(zero_copy_only=False) for chunk in group["cell"].chunks for v in chunk)
    return pa.table({"target": group["target"][:1], "part": group["part"][:1], "cell": pa.array([total])})


def chained_fill(df: DataFrame, cols: Sequence[str], rounds: int = 10, tolerance: float = 1e-3) -> ChainedFill:
    """Learn the regressions that fill the gaps of ``cols``.

    Gaps start at the mean. In each round one pass gives, for every column with gaps, the second moments of all columns over the rows that hold
    it, and so its least-squares regression on the others as they are filled so far; the columns move together. It ends after ``rounds``, or when no weight
    moves by more than ``tolerance``. Nothing is stored between rounds: a pass fills its rows with the earlier rounds' regressions. (columns + 1)^2
    numbers a column with gaps reach the driver. A column without any value is filled with nothing and predicts nothing; one without gaps is filled
    with its mean in new rows.
    """
    cols = list(cols)
    aggs = [f(number(c)).alias(f"{n}|{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_pop), ("n", F.count))]
    row = df.agg(F.count("*").alias("n"), *aggs).first()
    known = [c for c in cols if row[f"n|{c}"]]
    fill = ChainedFill(known, [float(row[f"m|{c}"]) for c in known], [float(row[f"s|{c}"]) or 1.0 for c in known])
    targets = [j for j, c in enumerate(known) if row[f"n|{c}"] < row["n"]]
    if not targets or len(known) < 2:
        return fill
    rows = df.select(cells_of(known).alias("x"), F.spark_partition_id().alias("part"))
    size = len(known) + 1
    before: dict[int, np.ndarray] = {}
    for _ in range(rounds):
        partial = rows.mapInArrow(_moments(fill, targets), SUMS).withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        total = partial.groupBy("target", "part").applyInArrow(_added, SUMS).groupBy("target").applyInArrow(_added, SUMS)
        moments = {r["target"]: np.array(r["cell"]).reshape(size, size) for r in total.select("target", "cell").collect()}
        weights = {}
        for j in targets:
            others = [i for i in range(size) if i != j + 1]
            g = moments[j]
            w = np.zeros(size)
            w[others] = np.linalg.lstsq(g[np.ix_(others, others)], g[others, j + 1], rcond=1e-10)[0]
            weights[j] = w
        fill.rounds.append({j: w.tolist() for j, w in weights.items()})
        moved = max(np.abs(weights[j] - before.get(j, np.inf)).max() for j in targets)
        before = weights
        if moved <= tolerance:
            break
    return fill


def apply_chained(df: DataFrame, fill: ChainedFill) -> DataFrame:
    """Fill the gaps of the learnt columns, which become double; present values stay as they are."""
    present = [c for c in fill.columns if c in df.columns]
    if not present:
        return df
    cells = F.array(*[number(c) if c in df.columns else F.lit(None).cast("double") for c in fill.columns])

    @F.pandas_udf("array<double>")
    def gaps(x: pd.Series) -> pd.Series:
        rows = np.array([np.asarray(v, float) for v in x]).reshape(len(x), -1)
        out = fill.filled(fill.standard(rows)) * np.array(fill.width) + np.array(fill.center)
        return pd.Series(list(out))

    filled = df.withColumn("_filled", gaps(cells))
    return filled.withColumns({c: F.coalesce(number(c), F.col("_filled")[fill.columns.index(c)]) for c in present}).drop("_filled")


def _distances(x: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Distances over the cells that both rows hold, scaled up to all columns; infinite without a common cell."""
    width = x.shape[1]
    square, joint, some = np.zeros((len(x), len(d))), 0, None
    for j in range(width):
        a, b = np.isnan(x[:, j]), np.isnan(d[:, j])
        if a.all() or b.all():
            continue
        gap = x[:, j, None] - d[None, :, j]
        if a.any() or b.any():
            both = ~np.isnan(gap)
            some = both.astype(float) if some is None else some + both
            square += np.where(both, gap * gap, 0.0)
        else:
            square += np.square(gap, out=gap)
            joint += 1
    joint = joint if some is None else joint + some
    with np.errstate(all="ignore"):
        far = np.sqrt(square * width / joint) if some is not None or joint else np.full(square.shape, np.inf)
    if some is not None:
        far[joint == 0] = np.inf
    return far


def _cells(x: np.ndarray, most: int) -> dict[str, np.ndarray]:
    """A tree that cuts rows like those given into cells of at most ``most`` of them: by what is missing, then at the middle of the widest column.

    A node has the ``column`` it asks for, a ``limit`` (NaN: whether the cell is missing) and two nodes below it, numbered; cells are
    numbered from left to right, so that cells near in number are near in space.
    """
    column, limit, below, cell = [], [], [], []
    with np.errstate(all="ignore"):
        scale = np.array([np.ptp(v[~np.isnan(v)]) if (~np.isnan(v)).any() else 0.0 for v in x.T])
    cells = 0
    todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(x)), -1, 0)]
    while todo:                                                    # depth first, the left side first
        rows, parent, side = todo.pop()
        me = len(column)
        if parent >= 0:
            below[parent][side] = me
        v = x[rows]
        gone = np.isnan(v)
        column.append(-1), limit.append(np.nan), below.append([-1, -1]), cell.append(-1)
        if len(rows) > most:
            mixed = np.flatnonzero(gone.any(axis=0) & ~gone.all(axis=0))
            if len(mixed):
                column[me] = int(mixed[0])
                left = ~gone[:, mixed[0]]
            else:
                whole = np.flatnonzero(~gone.any(axis=0) & (scale > 0))
                wide = np.ptp(v[:, whole], axis=0) / scale[whole] if len(whole) else np.zeros(0)
                if len(wide) and wide.max() > 0:
                    j = int(whole[wide.argmax()])
                    at = np.median(v[:, j])
                    at = at if (v[:, j] > at).any() else v[v[:, j] < at, j].max()
                    column[me], limit[me] = j, at
                    left = v[:, j] <= at
        if column[me] < 0:
            cell[me] = cells
            cells += 1
        else:
            todo += [(rows[~left], me, 1), (rows[left], me, 0)]
    return {"column": np.array(column), "limit": np.array(limit, float), "below": np.array(below), "cell": np.array(cell)}


def _cell_of(tree: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    node = np.zeros(len(x), int)
    rows = np.arange(len(x))
    while len(rows := rows[tree["column"][node[rows]] >= 0]):
        at = node[rows]
        v, limit = x[rows, tree["column"][at]], tree["limit"][at]
        left = np.where(np.isnan(limit), ~np.isnan(v), v <= limit)
        node[rows] = tree["below"][at, np.where(left, 0, 1)]
    return tree["cell"][node]


class _Asked:
    """Rows to fill, and for each of their gaps the nearest donors so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        gone = np.isnan(x)
        self.patterns, kind = np.unique(gone, axis=0, return_inverse=True)
        self.kind = kind.ravel()
        self.row, self.col = np.nonzero(gone)
        self.gap = np.full(x.shape, -1)                            # the number of a row's gap in a column
        self.gap[self.row, self.col] = np.arange(len(self.row))
        self.bound = np.full(len(self.row), np.inf)                # no donor further away is among the k nearest
        n = (len(self.row), k)
        self.best = {"distance": np.full(n, np.inf), "other": np.full(n, np.iinfo(np.int64).max), "value": np.full(n, np.nan)}

    def within(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, every: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Those of the rows that a box of donors, or a part of it, may be near enough to."""
        x = self.x[rows]
        held = ~np.isnan(x)
        off = np.maximum(np.maximum(low - x, x - high), 0.0)
        off[~(held & every)] = 0.0                                 # a column that not every donor holds tells nothing
        joint = (held & some).sum(axis=1)
        with np.errstate(all="ignore"):
            least = np.sqrt((off * off).sum(axis=1) * x.shape[1] / joint) * (1 - 1e-9)
        least[joint == 0] = np.inf
        gap = self.gap[rows]
        bound = np.where((gap >= 0) & some, self.bound[gap], -1.0).max(axis=1)
        return rows[(least <= bound) & np.isfinite(least)]

    def take(self, rows: np.ndarray, ids: np.ndarray, d: np.ndarray, only_bounds: bool = False) -> None:
        """Compare rows with donors; with ``only_bounds`` the donors are not kept, as they are met again."""
        held = ~np.isnan(d)
        width = max(1, (1 << 20) // max(1, len(d)))
        for kind in np.unique(self.kind[rows]):
            same = rows[self.kind[rows] == kind]
            gaps = np.flatnonzero(self.patterns[kind] & held.any(axis=0))
            for at in range(0, len(same) if len(gaps) else 0, width):
                own = same[at:at + width]
                far = _distances(self.x[own], d)
                same_id = self.ids[own, None] == ids if only_bounds or not np.isfinite(self.bound[self.gap[own][:, gaps]]).all() else None
                for j in gaps:
                    gap = self.gap[own, j]
                    if same_id is not None and held[:, j].sum() >= self.k:
                        kth = np.partition(np.where(same_id, np.inf, far)[:, held[:, j]], self.k - 1, axis=1)[:, self.k - 1]
                        self.bound[gap] = np.minimum(self.bound[gap], kth)
                    if only_bounds:
                        continue
                    r, c = np.nonzero((far <= self.bound[gap, None]) & held[:, j] & (far < np.inf))
                    other = ids[c] != self.ids[own[r]]
                    r, c = r[other], c[other]
                    if len(r):
                        places = nearest_of(self.k, gap[r], self.best, {"distance": far[r, c], "other": ids[c], "value": d[c, j]})
                        self.bound[places] = np.minimum(self.bound[places], self.best["distance"][places, -1])

    def found(self) -> Iterator[pa.RecordBatch]:
        e, i = np.nonzero(np.isfinite(self.best["distance"]))
        if len(e):
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.ids[self.row[e]]), pa.array(self.col[e].astype("int32")), pa.array(self.best["other"][e, i]),
                 pa.array(self.best["distance"][e, i]), pa.array(self.best["value"][e, i])], ["id", "col", "donor", "distance", "value"])


def _box(d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    held = ~np.isnan(d)
    low, high = np.where(held, d, np.inf).min(axis=0), np.where(held, d, -np.inf).max(axis=0)
    return low, high, held.all(axis=0), held.any(axis=0)


def nearest_fill(df: DataFrame, key: str, cols: Sequence[str], k: int = 5, block: int = BLOCK) -> DataFrame:
    """Fill the gaps of ``cols`` with the mean of the ``k`` nearest rows that hold the column; ``key`` is a unique whole number.

    The distance is over the cells that both rows hold, scaled up to all columns; rows without a common cell are no donors, ties go to
    the smaller key. A tree learnt from some rows cuts all rows into cells of about ``block`` rows, alike in what they miss and near to each other. A bound on the
    distance of the k-th donor comes from rows chosen by hash; rows with gaps then meet all rows, cell by cell, and leave out cells that lie beyond the bound
    found so far. Nothing is copied for a pair of cells (``blocks``). With few columns most cells are left out; with many the
    work grows with the rows to fill times all rows. A gap without donors stays. The columns become double; scale them first if their units differ.
    """
    cols = list(cols)
    width = len(cols)
    points = materialize(df.select(F.col(quoted(key)).cast("long").alias("id"), cells_of(cols).alias("x")).where("id is not null"), "points")
    n = stored_rows(points)
    sample = points.orderBy(F.xxhash64("id"), "id").limit(max(1, min(TREE_ROWS, TREE_NUMBERS // max(1, width)))).collect()      # a bounded number
    some_ids, some = np.array([r["id"] for r in sample], np.int64), np.array([r["x"] for r in sample], float).reshape(-1, width)
    tree = _cells(some, max(4, math.ceil(len(some) * block / max(1, n))))
    some_ids, some = some_ids[:BOUND_ROWS], some[:BOUND_ROWS]

    def celled(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            cell = _cell_of(tree, matrix(batch.column("x"), width))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), pa.array(cell, pa.int64())], ["id", "x", "grp"])

    def ordered(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        group = group.sort_by([("grp", "ascending"), ("id", "ascending")]).combine_chunks()
        return group["id"].to_numpy(), matrix(group["x"].combine_chunks(), width), group["grp"].to_numpy()

    def donors(group: pa.Table) -> dict[str, np.ndarray]:
        ids, x, cell = ordered(group)
        cuts = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1))
        cuts = np.unique(np.concatenate([cuts, np.arange(0, len(ids), 2 * block)]))
        return {"ids": ids, "x": x, "cuts": cuts.astype(np.int64)}

    def gaps(group: pa.Table) -> dict[str, np.ndarray]:
        ids, x, _ = ordered(group)
        asked = _Asked(ids, x, k)
        asked.take(np.arange(len(ids)), some_ids, some, only_bounds=True)
        return {"ids": ids, "x": x, "bound": asked.bound}

    rows = points.mapInArrow(celled, "id long, x array<double>, grp long")
    has_gap = F.exists("x", lambda v: v.isNull())
    counts = rows.groupBy("grp").agg(F.count("*").alias("n"), F.count_if(has_gap).alias("asked")).collect()      # one row a cell
    most = blocks.rows_a_block(16 * block, width)
    size = 8 * (width + 1)
    asked = blocks.packed(rows.where(has_gap), blocks.numbered([(r["grp"], r["asked"]) for r in counts if r["asked"]], most), gaps, ["ids", "x", "bound"],
                          size, sum(r["asked"] for r in counts), spread=True, name="asked")
    given = blocks.packed(rows, blocks.numbered([(r["grp"], r["n"]) for r in counts], most), donors, ["ids", "x", "cuts"], size, n, name="donors")

    def start(b: dict) -> _Asked:
        state = _Asked(np.frombuffer(b["ids"], np.int64), np.frombuffer(b["x"]).reshape(-1, width), k)
        state.bound = np.frombuffer(b["bound"]).copy()
        return state

    def step(asked: _Asked, _: int, b: dict) -> None:
        ids, d, cuts = np.frombuffer(b["ids"], np.int64), np.frombuffer(b["x"]).reshape(-1, width), np.frombuffer(b["cuts"], np.int64)
        rows = asked.within(np.arange(len(asked.ids)), *_box(d))
        if len(rows):
            for at, to in zip(cuts, [*cuts[1:], len(ids)], strict=True):
                near = asked.within(rows, *_box(d[at:to]))
                if len(near):
                    asked.take(near, ids[at:to], d[at:to])

    found = blocks.meet(asked, given, start, step, _Asked.found, "id long, col int, donor long, distance double, value double")
    nearest = Window.partitionBy("id", "col").orderBy("distance", "donor")
    best = found.withColumn("_r", F.row_number().over(nearest)).where(F.col("_r") <= k).groupBy("id", "col").agg(F.avg("value").alias("value"))
    wide = best.groupBy("id").agg(*[F.max(F.when(F.col("col") == j, F.col("value"))).alias(f"_v{j}") for j in range(len(cols))])
    wide = materialize(wide.withColumnRenamed("id", "_id"), "donor-means")
    joined = lookup_join(df.withColumn("_id", F.col(quoted(key)).cast("long")), wide, ["_id"])
    return joined.withColumns({c: F.coalesce(number(c), F.col(f"_v{j}")) for j, c in enumerate(cols)}).drop("_id", *[f"_v{j}" for j in range(len(cols))])
