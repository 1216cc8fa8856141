"""Exact k nearest neighbours (Euclidean) inside one table, without a cross join.

Rows are assigned to the nearest of a few pivot rows, which cuts the table into cells. The triangle
inequality gives every cell a bound on the distance of its rows' k-th neighbour, and a row travels
only to the cells whose bound it can meet. Inside a cell, queries and candidates are split into
blocks of limited size, so a crowded cell becomes many tasks; a task returns k rows per query, never
all pairs.

Where rows would have to travel to many cells or blocks, as in many dimensions, they are not sent at all: stored blocks meet pair by pair
(``blocks``), and a block is left out for the rows that are too far from it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.rules import number
from panelwright.operators import blocks
from panelwright.operators.blocks import nearest_of
from panelwright.runtime import forget, lookup_join, materialize, stored_rows

BLOCK = 4_096
COPIES = 8               # copies of the rows that may be sent; where more would be, stored blocks meet instead
BUCKET_COPIES = 3        # the same for each table of buckets, of rows that are asked and rows that are compared together
FEW = 200_000            # so many rows may be sent in any case
MAX_PIVOTS = 1_024
SAMPLE = 512             # rows that give the scale of distances
MEASURED = 1 << 22       # numbers of one array of vector differences, about


def as_vector(df: DataFrame, features: Sequence[str] | str) -> Column:
    """An array<double> column of the features, or the given array column itself."""
    if isinstance(features, str):
        return F.col(features).cast("array<double>")
    return F.array(*[F.col(c).cast("double") for c in features])


def stored_as(df: DataFrame, features: Sequence[str] | str) -> str:
    """The type that holds the features' vectors: float where the column is one of floats, which halves what is stored."""
    kind = df.schema[features].dataType if isinstance(features, str) and features in df.columns else None
    return "array<float>" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "array<double>"


def vectors(x: pd.Series) -> np.ndarray:
    return np.stack(x.to_numpy()).astype(float, copy=False)


def complete_points(df: DataFrame, key: str, features: Sequence[str] | str) -> DataFrame:
    """(id, x) of the rows whose vector is there and holds numbers only."""
    points = df.select(F.col(key).cast("long").alias("id"), as_vector(df, features).alias("x"))
    whole = points.where(F.coalesce(F.col("id").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda v: number(v).isNotNull()), F.lit(False)))
    return whole.withColumn("x", F.col("x").cast(stored_as(df, features)))


def nearest_neighbors(df: DataFrame, key: str, features: Sequence[str] | str, k: int = 5, pivots: int | None = None,
                      block: int = BLOCK, copies: float = COPIES, few: int = FEW) -> DataFrame:
    """(key, neighbor, distance, rank) with the k nearest other rows of every row; ties by key.

    ``key`` is a unique whole number; rows without a complete vector take no part. Rows are sent to the cells they have to visit while that makes at most
    ``copies`` rows of one, or ``few`` rows in all; otherwise stored blocks meet pair by pair. In many dimensions see ``bucketed_neighbors``.
    """
    points = materialize(complete_points(df, key, features), "points")
    n = stored_rows(points)
    count = pivots or max(1, min(MAX_PIVOTS, int(math.sqrt(n) / 4)))
    sample = points.orderBy(F.xxhash64("id"), "id").limit(count).collect()          # at most MAX_PIVOTS rows
    if not sample:
        return df.sparkSession.createDataFrame([], "id long, neighbor long, distance double, rank int")
    centers = np.array([r["x"] for r in sample], float)
    celled = materialize(_assign(points, centers), "cells")
    forget(points)

    routes, threshold = _routes(celled, centers, k)
    cells = {r["cell"]: r["n"] for r in celled.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one per pivot
    spark = df.sparkSession
    # Which cells a row has to visit: one (from, to) row per cell pair with the nearest distance to
    # the own pivot that the target cell can still need.
    pair_rows = [(int(j), int(i), float(threshold[i, j])) for i, j in routes]
    pairs = spark.createDataFrame(pair_rows, "cell int, target int, at_least double")
    grouped = pairs.groupBy("cell").agg(F.collect_list(F.struct("target", "at_least")).alias("to"))  # <= pivots
    routed = celled.join(F.broadcast(grouped), "cell")                              # at most MAX_PIVOTS rows
    most = max(few, copies * n)
    sent = routed.agg(F.sum(F.size(F.filter("to", lambda t: F.col("to_pivot") >= t["at_least"])))).first()[0]
    received: dict[int, int] = {}
    if sent <= most:
        visits = (routed.select("id", "x", "to_pivot", F.inline("to")).where(F.col("to_pivot") >= F.col("at_least"))
                  .select("id", "x", F.col("target").alias("cell")))
        visits = materialize(visits, "visits")
        received = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one per pivot
        sizes = [(c, math.ceil(m / block), math.ceil(received.get(c, 1) / block)) for c, m in cells.items()]
        sent = sum(cells[c] * nc + received.get(c, 1) * nq for c, nq, nc in sizes)
    if sent <= most:
        dealt = F.broadcast(spark.createDataFrame(sizes, "cell int, nq int, nc int"))
        # Every query block of a cell meets every candidate block of the cell.
        queries = (celled.join(dealt, "cell")
                   .select("cell", "id", "x", F.pmod(F.xxhash64("id"), F.col("nq")).cast("int").alias("qb"),
                           F.explode(F.sequence(F.lit(0), F.col("nc") - 1)).alias("cb")))
        candidates = (visits.join(dealt, "cell")
                      .select("cell", "id", "x", F.pmod(F.xxhash64("id"), F.col("nc")).cast("int").alias("cb"),
                              F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qb")))
        groups = ["cell", "qb", "cb"]
        found = queries.groupBy(*groups).cogroup(candidates.groupBy(*groups)).applyInPandas(
            _search(k), "id long, neighbor long, distance double")
    else:
        packed = _packed(celled.withColumn("grp", F.col("cell").cast("long")), list(cells.items()), centers.shape[1], block)
        forget(celled)
        found = _met(packed, packed, centers.shape[1], k)
    w = Window.partitionBy("id").orderBy("distance", "neighbor")
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.withColumnRenamed("id", key)


def _assign(points: DataFrame, centers: np.ndarray) -> DataFrame:
    shared = points.sparkSession.sparkContext.broadcast(centers)

    def assign(batches):
        c = shared.value
        for pdf in batches:
            if len(pdf):
                x = vectors(pdf["x"])
                d = np.empty((len(x), len(c)))
                for j in range(len(c)):
                    d[:, j] = np.sqrt(((x - c[j]) ** 2).sum(axis=1))
                best = d.argmin(axis=1)
                yield pdf.assign(cell=best.astype("int32"), to_pivot=d[np.arange(len(x)), best])

    return points.mapInPandas(assign, f"id long, x {points.schema['x'].dataType.simpleString()}, cell int, to_pivot double")


def _routes(celled: DataFrame, centers: np.ndarray, k: int):
    """Cell pairs (i, j) where rows of cell j may be neighbours of rows of cell i, and the least
    distance to pivot j such a row must have. Only per-cell figures reach the driver."""
    w = Window.partitionBy("cell").orderBy("to_pivot", "id")
    nearest = (celled.select("cell", "id", "to_pivot").withColumn("_r", F.row_number().over(w))
               .where(F.col("_r") <= k + 1).select("cell", "to_pivot").collect())   # (k + 1) per pivot
    radius = {r["cell"]: r["u"] for r in celled.groupBy("cell").agg(F.max("to_pivot").alias("u")).collect()}
    between = np.sqrt(((centers[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2))
    cell = np.array([r["cell"] for r in nearest])
    dist = np.array([r["to_pivot"] for r in nearest])
    routes, threshold = [], np.zeros_like(between)
    for i, reach in radius.items():
        upper = reach + between[i, cell] + dist             # no pair is further apart than this
        bound = np.sort(upper)[k] if len(upper) > k else np.inf     # k others and the row itself
        for j, other in radius.items():
            least = between[i, j] - reach - bound if i != j else 0.0
            least -= 1e-9 * (1.0 + between[i, j])
            if other >= least:
                routes.append((i, j))
                threshold[i, j] = least
    return routes, threshold


def _search(k: int):
    """Per query of a block its ``k`` nearest candidates by exact distance, ties to the smaller id."""
    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"id": pd.Series(dtype="int64"), "neighbor": pd.Series(dtype="int64"),
                              "distance": pd.Series(dtype="float64")})
        if q.empty or c.empty:
            return empty
        x, y = vectors(q["x"]), vectors(c["x"])
        qid, cid = q["id"].to_numpy(), c["id"].to_numpy()
        yy = (y ** 2).sum(axis=1)
        keep = min(k + 1, len(y))
        ids, others, dists = [], [], []
        for start in range(0, len(x), 256):
            part = x[start:start + 256]
            xx = (part ** 2).sum(axis=1)
            rough = xx[:, None] + yy[None, :] - 2.0 * part @ y.T
            # The product form is off by rounding: everything near the k-th value is measured again.
            kth = np.partition(rough, keep - 1, axis=1)[:, keep - 1]
            near = rough <= (kth + 1e-9 * (1.0 + xx + yy.max()))[:, None]
            most = int(near.sum(axis=1).max())
            step = max(1, MEASURED // (most * x.shape[1] + 1))
            for at in range(0, len(part), step):
                own, mask = part[at:at + step], near[at:at + step]
                pick = np.argpartition(rough[at:at + step], most - 1, axis=1)[:, :most]
                exact = np.sqrt(((y[pick] - own[:, None, :]) ** 2).sum(axis=2))
                other = cid[pick]
                exact[~np.take_along_axis(mask, pick, 1) | (other == qid[start + at:start + at + len(own), None])] = np.inf
                order = np.lexsort((other, exact))[:, :k]
                other, exact = np.take_along_axis(other, order, 1), np.take_along_axis(exact, order, 1)
                r, j = np.nonzero(np.isfinite(exact))
                ids.append(qid[start + at + r])
                others.append(other[r, j])
                dists.append(exact[r, j])
        if not ids:
            return empty
        return pd.DataFrame({"id": np.concatenate(ids), "neighbor": np.concatenate(others),
                             "distance": np.concatenate(dists)})

    return search


# ---- stored blocks that meet pair by pair

def _packed(rows: DataFrame, counts: Sequence[tuple[int, int]], width: int, block: int, tables: int = 0, spread: bool = True) -> DataFrame:
    """(id, x, codes, grp) rows as stored blocks; a block holds rows of one group, if groups are not small."""
    single = rows.schema["x"].dataType.elementType == T.FloatType()
    size = (4 if single else 8) * width + 8 * (tables + 1)
    most = blocks.rows_a_block(block, width + tables)
    n = sum(m for _, m in counts)

    def pack(group: pa.Table) -> dict[str, np.ndarray]:
        group = group.combine_chunks()
        flat = lambda c: group[c].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        made = {"ids": group["id"].to_numpy(), "x": flat("x")}
        return made | ({"codes": flat("codes")} if tables else {})

    columns = ["ids", "x", *["codes"] * bool(tables)]
    kept = rows.select("id", "x", "grp", *["codes"] * bool(tables))
    return blocks.packed(kept, blocks.numbered(counts, most, joined=True), pack, columns, size, n, spread=spread, name="blocks")


class _Near:
    """Rows of a block and the nearest others of each so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, codes: np.ndarray | None, k: int):
        self.ids, self.x, self.codes, self.k = ids, x, codes, k
        self.xx = (x ** 2).sum(axis=1)
        shape = (len(ids), k)
        self.best = {"distance": np.full(shape, np.inf), "other": np.full(shape, np.iinfo(np.int64).max)}

    def take(self, ids: np.ndarray, y: np.ndarray, codes: np.ndarray | None) -> None:
        whole = np.isfinite(y).all(axis=1)                         # no other row is at a finite distance
        if not whole.all():
            ids, y, codes = ids[whole], y[whole], None if codes is None else codes[whole]
        if not len(y):
            return
        bound = self.best["distance"][:, -1]
        middle = y.mean(axis=0)
        off = y - middle
        yy = (off ** 2).sum(axis=1)
        # A row whose bound does not reach the ball around the block's middle has no near rows in it.
        reach = np.sqrt(((self.x - middle) ** 2).sum(axis=1))
        rows = np.flatnonzero((reach - math.sqrt(yy.max())) * (1 - 1e-9) <= bound + 1e-9 * (1.0 + reach))
        d = y.shape[1]
        small = reach.max(initial=0.0) ** 2 + yy.max() < 1e30
        kind, unit = (np.float32, 1.2e-7) if small else (float, 2.3e-16)
        # 2 x.y - y.y by one product; the rounding of it is bounded, and all that may be near is measured again.
        turned = np.concatenate([2.0 * off, -yy[:, None]], axis=1).astype(kind).T.copy()
        keep = min(self.k + 1, len(y))
        for start in range(0, len(rows), 256):
            own = rows[start:start + 256]
            z = self.x[own] - middle
            zz = (z ** 2).sum(axis=1)
            slack = 2.0 * (d + 8) * unit * (zz + yy.max()) + 1e-9 * (1.0 + self.xx[own])
            rough = np.concatenate([z, np.ones((len(z), 1))], axis=1).astype(kind) @ turned     # larger is nearer
            limit = self.best["distance"][own, -1]
            if not np.isfinite(limit).all():
                hungry = np.flatnonzero(~np.isfinite(limit))
                near = rough[hungry]
                if codes is not None:
                    near = np.where(_shared(self.codes[own[hungry]][:, None, :], codes[None, :, :]), near, -np.inf)
                last = np.partition(near, len(y) - keep, axis=1)[:, len(y) - keep].astype(float)
                least = np.full(len(own), -np.inf)
                least[hungry] = last - slack[hungry]
                full = np.isfinite(limit)
                least[full] = (zz - limit * limit)[full] - slack[full]
            else:
                least = zz - limit * limit - slack
            r, c = _places(rough >= np.nextafter(least.astype(kind), kind(-np.inf))[:, None])
            step = max(1, MEASURED // d)
            for at in range(0, len(r), step):
                self._measured(own[r[at:at + step]], c[at:at + step], ids, y, codes)

    def _measured(self, row: np.ndarray, col: np.ndarray, ids: np.ndarray, y: np.ndarray, codes: np.ndarray | None) -> None:
        ok = ids[col] != self.ids[row]
        if codes is not None:
            ok &= _shared(self.codes[row], codes[col])
        row, col = row[ok], col[ok]
        exact = np.sqrt(((y[col] - self.x[row]) ** 2).sum(axis=1))
        ok = (exact <= self.best["distance"][row, -1]) & np.isfinite(exact)
        if ok.any():
            nearest_of(self.k, row[ok], self.best, {"distance": exact[ok], "other": ids[col[ok]]})

    def found(self):
        r, i = np.nonzero(np.isfinite(self.best["distance"]))
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[r]), pa.array(self.best["other"][r, i]), pa.array(self.best["distance"][r, i])],
                                             ["id", "neighbor", "distance"])


def _places(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the flags that are set, which are few: eight flags are looked at together."""
    flat = flags.ravel()
    end = flat.size - flat.size % 8
    some = (np.flatnonzero(flat[:end].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    at = np.concatenate([some[flat[some]], end + np.flatnonzero(flat[end:])])
    return np.divmod(at, flags.shape[1])


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows lie in one bucket of any table."""
    out = a[..., 0] == b[..., 0]
    for t in range(1, a.shape[-1]):
        out = out | (a[..., t] == b[..., t])
    return out


def _met(asked: DataFrame, given: DataFrame, width: int, k: int, tables: int = 0) -> DataFrame:
    """(id, neighbor, distance): the k nearest of each row asked in each partition of stored blocks, of those in one of its buckets if there are any."""

    def parts(b: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        ids = np.frombuffer(b["ids"], np.int64)
        x = np.frombuffer(b["x"], np.float32 if b["x"].size == 4 * width * len(ids) else float).reshape(-1, width).astype(float, copy=False)
        return ids, x, np.frombuffer(b["codes"], np.int64).reshape(-1, tables) if tables else None

    return blocks.meet(asked, given, lambda b: _Near(*parts(b), k), lambda s, _, b: s.take(*parts(b)), _Near.found,
                       "id long, neighbor long, distance double")


# ---- many dimensions: buckets of random projections

def collision(distance: float, width: float) -> float:
    """The chance that two rows at this distance share the cell of one random projection cut into cells of this width."""
    if distance <= 0:
        return 1.0
    c = width / distance
    tail = 0.5 * math.erfc(c / math.sqrt(2.0))
    return 1.0 - 2.0 * tail - math.sqrt(2.0 / math.pi) / c * (1.0 - math.exp(-c * c / 2.0))


def certified_distance(width: float, projections: int, tables: int, miss: float) -> float:
    """The largest distance at which a row is missed by all tables with a chance of at most ``miss``."""
    need = 1.0 - miss ** (1.0 / tables)
    low, high = 0.0, 64.0 * width
    for _ in range(60):
        middle = (low + high) / 2.0
        low, high = (middle, high) if collision(middle, width) ** projections >= need else (low, middle)
    return low


def _keyed(width: float, dimensions: int, projections: int, tables: int, seed: int):
    rng = np.random.default_rng([seed, dimensions, projections, tables])
    turn, shift = rng.normal(size=(dimensions, tables * projections)), rng.random(tables * projections)
    factor = rng.integers(1, 1 << 62, projections, dtype=np.int64) * 2 + 1

    def keyed(batches):
        for pdf in batches:
            if len(pdf):
                x = vectors(pdf["x"])
                place = np.floor(x @ turn / width + shift).astype(np.int64).reshape(len(x), tables, projections)
                with np.errstate(over="ignore"):
                    bucket = (place * factor).sum(axis=2)                  # equal places, equal buckets; others hardly ever
                yield pdf.assign(codes=list(bucket))

    return keyed


def _in_buckets(points: DataFrame, asked: DataFrame, width: float, dimensions: int, k: int, projections: int, tables: int, block: int, seed: int,
                copies: float, few: int) -> tuple[DataFrame, list[DataFrame]]:
    """(id, neighbor, distance) and the tables that it is read from: the nearest of each row asked among those in its buckets.

    Rows are sent to their buckets, crowded ones in blocks of limited size, while that makes at most ``copies`` rows of one and table, or ``few`` rows in
    all. Otherwise stored blocks of all rows meet pair by pair, and a pair of rows counts if it shares a bucket.
    """
    make = _keyed(width, dimensions, projections, tables, seed)
    schema = f"id long, x {points.schema['x'].dataType.simpleString()}, codes array<long>"
    index, queries = (d.select("id", "x").mapInPandas(make, schema) for d in (points, asked))
    counted = [d.select(F.posexplode("codes").alias("table", "bucket")).groupBy("table", "bucket").agg(F.count("*").alias(c)) for d, c in ((index, "c"), (queries, "q"))]
    sizes = materialize(counted[0].join(counted[1], ["table", "bucket"]).withColumns(
        {"nc": F.ceil(F.col("c") / block).cast("int"), "nq": F.ceil(F.col("q") / block).cast("int")}), "bucket-sizes")
    sent = sizes.agg(F.sum(F.col("c") * F.col("nq") + F.col("q") * F.col("nc"))).first()[0] or 0
    if sent > max(few, copies * tables * stored_rows(points)):
        groups = max(1, stored_rows(points) // block)
        made = []
        for d in (index, queries) if asked is not points else (index,):
            near = d.withColumn("grp", F.pmod(F.xxhash64(F.col("codes")[0]), F.lit(groups)))             # rows of a bucket, mostly
            counts = [(r["grp"], r["n"]) for r in near.groupBy("grp").agg(F.count("*").alias("n")).collect()]    # one row a block, about
            made.append(_packed(near, counts, dimensions, block, tables))
        return _met(made[-1], made[0], dimensions, k, tables), [sizes, *made]

    def dealt(df: DataFrame, own: str, parts: str, other: str, times: str) -> DataFrame:
        placed = df.select("id", "x", F.posexplode("codes").alias("table", "bucket"))
        joined = lookup_join(placed, sizes.drop("c", "q"), ["table", "bucket"], "inner")
        return joined.select("table", "bucket", "id", "x", F.pmod(F.xxhash64("id"), F.col(parts)).cast("int").alias(own),
                             F.explode(F.sequence(F.lit(0), F.col(times) - 1)).alias(other))

    groups = ["table", "bucket", "qb", "cb"]
    found = dealt(queries, "qb", "nq", "cb", "nc").groupBy(*groups).cogroup(dealt(index, "cb", "nc", "qb", "nq").groupBy(*groups)).applyInPandas(
        _search(k), "id long, neighbor long, distance double")
    return found, [sizes]


def bucketed_neighbors(df: DataFrame, key: str, features: Sequence[str] | str, k: int = 5, projections: int = 6, tables: int = 8, rounds: int = 6,
                       miss: float = 0.05, block: int = BLOCK, seed: int = 42, copies: float = BUCKET_COPIES, few: int = FEW) -> DataFrame:
    """(key, neighbor, distance, rank, certified) with about the k nearest other rows of every row, for many dimensions.

    Rows meet in buckets of ``projections`` random projections cut into cells, in ``tables`` independent tables, and are measured exactly
    there. A row is certified once its k-th distance is so small that any nearer row would have been missed with a chance of at most ``miss``. Rows that are not
    go on to a round with wider cells, ``rounds`` of them at most; then they keep what was found, uncertified. The first width comes from the distances
    within at most SAMPLE rows chosen by hash; everything else covers all rows. Where buckets hold too many rows to be sent to (``copies``, ``few``), as in data
    without clusters, stored blocks meet pair by pair with the same result. ``key`` is a unique whole number; rows without a complete vector take no part.
    """
    points = materialize(complete_points(df, key, features), "points")
    sample = [r["x"] for r in points.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(SAMPLE).collect()]
    schema = f"`{key}` long, neighbor long, distance double, rank int, certified boolean"
    if len(sample) < 2:
        return df.sparkSession.createDataFrame([], schema)
    x = np.array(sample, float)
    apart = np.stack([np.sqrt(((x - r) ** 2).sum(axis=1)) for r in x])
    near = np.sort(apart, axis=1)[:, min(k, len(x) - 1)]
    scale = float(np.median(near)) or float(near.max()) or 1.0
    reach = certified_distance(1.0, projections, tables, miss)
    width = scale / reach / 2.0
    open_, best, told = points, None, None
    nearest = Window.partitionBy("id").orderBy("distance", "neighbor")
    for _ in range(rounds):
        found, read = _in_buckets(points, open_, width, x.shape[1], k, projections, tables, block, seed, copies, few)
        found = found if best is None else found.unionByName(best.drop("certified"))
        ranked = found.groupBy("id", "neighbor").agg(F.min("distance").alias("distance")).withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
        limit = F.lit(width * reach)
        kth = F.max(F.when(F.col("rank") == k, F.col("distance"))).over(Window.partitionBy("id"))
        last = told
        told = materialize(ranked.withColumn("certified", F.coalesce(kth <= limit, F.lit(False))), "nearest-so-far")
        for stored in (*read, *([last] if last is not None else [])):
            forget(stored)
        best = told.drop("rank")
        done = told.where("certified").select("id").distinct()
        left = materialize(points.join(done, "id", "left_anti"), "open")
        if open_ is not points:
            forget(open_)
        open_ = left
        if stored_rows(open_) == 0:
            break
        width *= 2.0
    return told.select(F.col("id").alias(key), "neighbor", "distance", "rank", "certified")
