"""Vector codes: each part of a vector is replaced by its nearest codebook entry; integer k-means with adaptive distance bounds.

A part keeps its ``b`` closest entries in order, a lower bound of the distance to each but the first, and one outer bound for all
other entries. When the codebook moves, the bounds shrink by the moves, and only entries whose bound no longer proves them farther
than the assigned one are compared again, in whole numbers. ``b`` follows, per part position, how deep the last round had to look.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.llm.common import Scratch, table

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
CHUNK = 4096             # rows whose distances are held at once
FEW = 0.01               # share of a round's parts that may look deeper than the next list is long
BROADCAST_LABELS = 100_000
SLACK = 1e-12            # relative rounding allowance of a bound; distances are below 2^32


@dataclass
class Codes:
    """``rows``: vec_id, the kept columns, codes (binary, one byte a part), error (long). ``books``: (parts, entries, width) whole numbers."""

    rows: DataFrame
    books: np.ndarray


def _apart(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances, as whole numbers, of rows x (n, w) to entries c (n or 1, m, w)."""
    gap = x[:, None, :] - c
    return np.einsum("nmw,nmw->nm", gap, gap)


def assign(x: np.ndarray, c: np.ndarray, ids: np.ndarray | None, low: np.ndarray | None, moved: np.ndarray,
           keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entries of the rows x (n, w) of one part position: (ids, low, squared distance, depth).

    ``ids`` (n, b) lists close entries, the assigned one first. low[:, j] is at most the distance to ids[:, j + 1], the last column at
    most the distance to every entry that is not listed. ``moved`` is how far each entry went since. ``depth`` counts the list places
    that were looked at (1: the bounds decided), and is the number of entries plus one where all were. The result lists ``keep``.
    """
    n, k = len(x), len(c)
    depth = np.full(n, k + 1)
    own = np.zeros(n, np.int64)
    if ids is None:
        ids, low = np.zeros((n, keep), np.intp), np.zeros((n, keep))
        whole = np.arange(n)
    else:
        ids, b = ids.astype(np.intp), ids.shape[1]
        low = low.astype(float)
        low[:, :-1] -= moved[ids[:, 1:]]
        low[:, -1] -= moved.max()
        own = _apart(x, c[ids[:, :1]])[:, 0]
        reach = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1] * (1 - SLACK)       # least bound from this place on
        open_ = (np.sqrt(own)[:, None] * (1 + SLACK) >= reach).sum(axis=1)
        for z in range(1, b):
            rows = np.flatnonzero(open_ == z)
            if len(rows):
                entry = ids[rows, :z + 1]
                d = _apart(x[rows], c[entry])
                order = np.lexsort((entry, d))                                           # ties to the lower index
                d = np.take_along_axis(d, order, 1)
                ids[rows, :z + 1] = np.take_along_axis(entry, order, 1)
                low[rows, :z] = np.sqrt(d[:, 1:])
                own[rows] = d[:, 0]
        depth = np.where(open_ < b, open_ + 1, k + 1)
        whole = np.flatnonzero(open_ == b)
        if b > 2:
            order = np.argsort(low[:, :-1], axis=1, kind="stable")
            ids[:, 1:], low[:, :-1] = np.take_along_axis(ids[:, 1:], order, 1), np.take_along_axis(low[:, :-1], order, 1)
        if keep < b:
            low = np.concatenate([low[:, :keep - 1], low[:, keep - 1:].min(axis=1, keepdims=True)], axis=1)
            ids = ids[:, :keep]
    wide = ids.shape[1]
    for at in range(0, len(whole), CHUNK):
        rows = whole[at:at + CHUNK]
        d = _apart(x[rows], c[None])
        order = np.argsort(d, axis=1, kind="stable")[:, :wide + 1]
        d = np.take_along_axis(d, order, 1)
        ids[rows], own[rows] = order[:, :wide], d[:, 0]
        low[rows, :wide - 1] = np.sqrt(d[:, 1:wide])
        low[rows, -1] = np.sqrt(d[:, wide]) if wide < k else np.inf
    return ids, low, own, depth


def _fixed(column: pa.Array, kind: str, n: int) -> np.ndarray:
    """A binary column of equal-sized values as an array with one row each."""
    raw = np.frombuffer(b"".join(column.to_pylist()), kind)
    return raw.reshape(n, -1)


def _whole(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * component) of a column of lists. Components so large that a sum of squares could pass 64 bits count as the largest that cannot."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
    most = math.isqrt((1 << 62) // max(1, width)) // 2
    return np.clip(np.floor(flat * scale), -most, most).astype(np.int64)


def _step(books: np.ndarray, moved: np.ndarray | None, lists: Sequence[int], keep: Sequence[int], scale: int, carried: Sequence[str], label_types: list):
    """A pass over all rows: their new lists and bounds, then per part position and entry the sums of its parts with their
    number, and as entry -1 how many parts had to look how deep."""
    parts, k, w = books.shape
    first = np.concatenate([[0], np.cumsum(lists)]).astype(int)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, depths = np.zeros((parts, k, w + 1), np.int64), np.zeros((parts, k + 2), np.int64)
        data = [("vec_id", pa.int64()), *zip(carried, label_types, strict=True), ("x", pa.binary()), ("ids", pa.binary()), ("low", pa.binary()), ("error", pa.int64())]
        schema = pa.schema([*data, ("part", pa.int32()), ("entry", pa.int32()), ("totals", pa.list_(pa.int64()))])
        for batch in stream:
            for at in range(0, len(batch), 8 * CHUNK):
                rows = batch.slice(at, 8 * CHUNK)
                n = len(rows)
                if moved is None:
                    x = _whole(rows.column("x"), parts * w, scale)
                else:
                    x = _fixed(rows.column("x"), "<i8" if parts * w < 4 else "<i4", n).astype(np.int64)
                    old, bound = _fixed(rows.column("ids"), "u1", n), _fixed(rows.column("low"), "<f4", n)
                ids, low, error = [], [], np.zeros(n, np.int64)
                for p in range(parts):
                    own = slice(first[p], first[p + 1])
                    known = (None, None) if moved is None else (old[:, own], bound[:, own])
                    piece = x[:, p * w:(p + 1) * w]
                    i, b, d, depth = assign(piece, books[p], *known, np.zeros(k) if moved is None else moved[p], keep[p])
                    for j in range(w):
                        sums[p, :, j] += _sum_by(i[:, 0], piece[:, j], k)
                    sums[p, :, w] += np.bincount(i[:, 0], minlength=k)
                    depths[p] += np.bincount(depth, minlength=k + 2)
                    error += d
                    ids.append(i.astype(np.uint8))
                    low.append(np.nextafter(b.astype("<f4"), np.float32(-np.inf)))
                wide = x.astype("<i8" if parts * w < 4 else "<i4")
                columns = [*[rows.column(c) for c in ("vec_id", *carried)], *[_binary(v) for v in (wide, np.concatenate(ids, 1), np.concatenate(low, 1))],
                           pa.array(error), *[pa.nulls(n, schema.field(c).type) for c in ("part", "entry", "totals")]]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        told = [(p, e, t) for p in range(parts) for e, t in [*enumerate(sums[p]), (-1, depths[p])] if t.any()]
        empty = [pa.nulls(len(told), kind) for _, kind in data]
        yield pa.RecordBatch.from_arrays([*empty, pa.array([t[0] for t in told], pa.int32()), pa.array([t[1] for t in told], pa.int32()),
                                          pa.array([t[2].tolist() for t in told], pa.list_(pa.int64()))], schema=schema)

    return run


def _sum_by(group: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Exact sums by group: the halves of a value add up as whole numbers in floating point."""
    high, rest = values >> 20, values & ((1 << 20) - 1)
    return (np.bincount(group, high, k).astype(np.int64) << 20) + np.bincount(group, rest, k).astype(np.int64)


def _binary(values: np.ndarray) -> pa.Array:
    """One binary value for each row of an array."""
    raw = np.ascontiguousarray(values)
    size = raw.itemsize * raw.shape[1]
    return pa.array([raw[i].tobytes() for i in range(len(raw))] if size == 0 else
                    pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(raw), [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary()))


def finite(vector: str) -> Column:
    """Whether a vector has components and all of them are numbers."""
    x = F.col(vector)
    return F.coalesce((F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


def _new_books(books: np.ndarray, told: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The entries moved to the floored means of their parts, and how many parts looked how deep: parts x entries x (width + 1) numbers."""
    parts, k, w = books.shape
    new, depths = books.copy(), np.zeros((parts, k + 2), np.int64)
    sums = told.where("part is not null").select("part", "entry", F.posexplode("totals")).groupBy("part", "entry", "pos").agg(F.sum("col").alias("total"))
    cells = {(r["part"], r["entry"], r["pos"]): r["total"] for r in sums.collect()}
    for p in range(parts):
        for e in range(k):
            if n := cells.get((p, e, w), 0):
                new[p, e] = [cells[p, e, j] // n for j in range(w)]
        depths[p] = [cells.get((p, -1, j), 0) for j in range(k + 2)]
    return new, depths


def _kept(depths: np.ndarray, lists: Sequence[int]) -> list[int]:
    """Per part position the list length beyond which few parts of the last round looked; at least 2, and never longer than it was."""
    out = []
    for seen, b in zip(depths, lists, strict=True):
        deeper = seen.sum() - np.cumsum(seen)
        enough = int(np.flatnonzero(deeper <= FEW * seen.sum())[0])
        out.append(min(b, max(2, enough)))
    return out


def compress(vectors: DataFrame, s: Scratch, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             carry: Sequence[str] = (), listed: int | None = None) -> Codes:
    """Codes of all vectors of ``vectors`` (vec_id, embedding, the columns to ``carry``, any others).

    Rows with a null or empty vector, a null, NaN or infinite component, or another length than that of the kept row with the smallest
    vec_id take no part. Components become floor(scale * x). Codebooks start as the parts of the ``entries`` smallest vec_ids (null ids
    never; repeated ids in the order of their vectors); fewer rows make fewer entries, no rows an empty result. Each round assigns every part
    to its nearest entry, ties to the lower index, and moves the entries to the floored means; unused ones stay. Rows with null or repeated
    ids are coded like others. The codebooks, their sums and the depths are all that reaches the driver: parts x entries x (width + 1)
    numbers. A round's table replaces the one before it. ``listed`` entries a part are kept at first (a half unless given).
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index is one byte")
    rows = vectors.where(finite("embedding")).select("vec_id", *carry, F.col("embedding").cast("array<double>").alias("x"))
    start = rows.where("vec_id is not null").orderBy("vec_id", "x").limit(entries).select("x").collect()
    size = len(start[0]["x"]) if start else 0
    if size % parts:
        raise ValueError(f"vectors of {size} components have no {parts} equal parts")
    w = size // parts
    same = [r["x"] for r in start if len(r["x"]) == size]
    if len(same) < len(start):                                           # the rare mixed table
        same = [r["x"] for r in rows.where((F.size("x") == size) & F.col("vec_id").isNotNull()).orderBy("vec_id", "x").limit(entries).collect()]
    schema = T.StructType([f for f in rows.schema if f.name != "x"])
    empty = T.StructType([*schema.fields, T.StructField("codes", T.BinaryType()), T.StructField("error", T.LongType())])
    if not same:
        return Codes(vectors.sparkSession.createDataFrame([], empty), np.zeros((parts, 0, 0), np.int64))
    rows = rows.where(F.size("x") == size)
    first = _whole(pa.array(same, pa.list_(pa.float64())), size, scale)
    books = first.reshape(len(first), parts, w).transpose(1, 0, 2).copy()
    k = len(first)
    told_as = T.StructType([*schema.fields, *[T.StructField(c, T.BinaryType()) for c in ("x", "ids", "low")], T.StructField("error", T.LongType()),
                            T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()), T.StructField("totals", T.ArrayType(T.LongType()))])
    types = [pa.field(c, t).type for c, t in zip(carry, _arrow_types(schema, carry), strict=True)]
    lists = keep = [min(k, listed or max(2, -(-k // 2)))] * parts
    moved = None
    for turn in range(rounds + 1):
        before = s.tables
        told = s.store(rows.mapInArrow(_step(books, moved, lists, keep, scale, carry, types), told_as))
        s.drop(before if turn else 0)
        rows, lists = told.where("part is null").drop("part", "entry", "totals"), keep
        if turn == rounds:
            break
        new, depths = _new_books(books, told)
        gap = (new - books).astype(float)
        moved = np.sqrt((gap ** 2).sum(axis=2)) * (1 + SLACK)
        books = new
        if not moved.any():                                              # nothing changes any more
            break
        keep = _kept(depths, lists) if turn else lists
    at = np.concatenate([[0], np.cumsum(lists)])[:-1]
    codes = F.concat(*[F.substring("ids", int(i) + 1, 1) for i in at])
    return Codes(rows.select("vec_id", *carry, codes.alias("codes"), "error"), books)


def _arrow_types(schema: T.StructType, names: Sequence[str]) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(schema[c].dataType) for c in names]


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels' error sums are aggregated before they meet the rows, so a label of a third of all rows costs no more than another."""
    with Scratch(spark, "vector-codes") as s:
        codes = compress(table(spark, sf_dir, "embeddings"), s, carry=["label"])
        rows = s.store(codes.rows)
        sums = s.store(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
        if sums.count() <= BROADCAST_LABELS:
            sums = F.broadcast(sums)
        return s.result(rows.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
            "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(books_digest(codes.books)).alias("codebooks_sha256")))


def codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same rounds as unrolled SQL: one assignment and one table of entries each."""
    steps = [f"""kept AS MATERIALIZED (SELECT vec_id, label, row_number() OVER () AS r, len(embedding) // {parts} AS w,
  list_transform(embedding, lambda v: CAST(floor({scale} * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
pieces AS MATERIALIZED (SELECT r, p, w, x[p * w + 1:(p + 1) * w] AS x FROM kept, range({parts}) AS t(p)),
c0 AS MATERIALIZED (SELECT p, e, x FROM pieces JOIN (SELECT r, row_number() OVER (ORDER BY vec_id, x) - 1 AS e FROM kept
  WHERE vec_id IS NOT NULL) USING (r) WHERE e < {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, p, min({entries} * CAST(list_sum(list_transform(range(1, w + 1),
  lambda j: (b.x[j] - c.x[j]) * (b.x[j] - c.x[j]))) AS BIGINT) + e) AS best, any_value(b.x) AS x, any_value(w) AS w
  FROM pieces b JOIN c{i} c USING (p) GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""m{i} AS MATERIALIZED (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS x FROM (
  SELECT p, best % {entries} AS e, j, CAST(sum(x[j]) AS BIGINT) AS s, count(*) AS n FROM (SELECT *, unnest(range(1, w + 1)) AS j FROM a{i}) GROUP BY ALL) GROUP BY p, e),
c{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (p, e))""")
    steps.append(f"""coded AS (SELECT r, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r)""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM c{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""


OP11_SQL = codes_sql()
