"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.llm.common import Scratch, table
from panelwright.llm.words import mix

TABLES = 10
PROBES = 8               # buckets of a table that a query looks into, its own first
CELL = 4096              # candidates and queries of one cell, about; crowded buckets are dealt over several


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the row length is a power of two."""
    n = x.shape[1]
    h = 1
    while h < n:
        x = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(-1, n)
        h *= 2
    return x / np.sqrt(n)


def rotate(x: np.ndarray, number: int) -> np.ndarray:
    """Pseudo-rotation ``number``: three rounds of fixed random signs and a Hadamard transform."""
    size = 1 << max(0, x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), size))
    y[:, :x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
    for r in range(3):
        sign = mix(np.arange(size, dtype=np.uint64), 1000 + 3 * number + r) & np.uint64(1)
        y = hadamard(y * np.where(sign == 1, 1.0, -1.0))
    return y


def buckets(x: np.ndarray, number: int, probes: int) -> np.ndarray:
    """Per row the ``probes`` signed axes closest to its rotation, nearest first; axis i is bucket 2i or, reversed, 2i + 1."""
    y = rotate(x, number)
    both = np.stack([y, -y], axis=2).reshape(len(y), -1)
    probes = min(probes, both.shape[1])
    near = np.argpartition(-both, probes - 1, axis=1)[:, :probes]
    return np.take_along_axis(near, np.argsort(-np.take_along_axis(both, near, axis=1), axis=1, kind="stable"), axis=1)


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) for each length that occurs in a column of lists."""
    sizes = np.diff(column.offsets.to_numpy())
    flat, first = column.values.to_numpy(zero_copy_only=False).astype(float), column.offsets.to_numpy()
    return [(rows := np.flatnonzero(sizes == k), flat[first[rows][:, None] + np.arange(k)]) for k in np.unique(sizes)]


KEYED = "node long, x array<double>, key long"


def _keyed(tables: int, probes: int):
    """Rows of (node, vector, bucket key) for the first ``probes`` buckets of each table; the key holds length, table and bucket."""

    def run(stream):
        for batch in stream:
            for rows, x in _matrix(batch.column("x")):
                for at in range(0, len(rows), 1024):
                    part, own = rows[at:at + 1024], x[at:at + 1024]
                    for t in range(tables):
                        b = buckets(own, t, probes)
                        many = pa.array(np.repeat(part, b.shape[1]))
                        key = (np.int64(x.shape[1]) << 32) | (np.int64(t) << 24) | b.reshape(-1)
                        yield pa.RecordBatch.from_arrays([batch.column("node").take(many), batch.column("x").take(many), pa.array(key)],
                                                         ["node", "x", "key"])

    return run


def _nearest(k: int):
    """Per query of a cell its ``k`` nearest candidates by exact distance, ties to the smaller node."""

    def of(index: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"q": [], "c": [], "d": []}
        if index.num_rows and queries.num_rows:
            width = len(index["x"][0])
            node = index["node"].to_numpy()
            order = np.argsort(node, kind="stable")
            node = node[order]
            x = index["x"].combine_chunks().flatten().to_numpy().reshape(-1, width)[order]
            y = queries["x"].combine_chunks().flatten().to_numpy().reshape(-1, width)
            q = queries["node"].to_numpy()
            step = max(1, (1 << 22) // max(1, x.size))
            for at in range(0, len(y), step):
                d = np.sqrt(((y[at:at + step, None, :] - x[None]) ** 2).sum(axis=2))
                best = np.argsort(d, axis=1, kind="stable")[:, :k]
                out["q"].append(np.repeat(q[at:at + step], best.shape[1]))
                out["c"].append(node[best].ravel())
                out["d"].append(np.take_along_axis(d, best, axis=1).ravel())
        return pa.table({n: pa.array(np.concatenate(v) if v else [], t) for (n, v), t in zip(
            out.items(), (pa.int64(), pa.int64(), pa.float64()), strict=True)})

    return of


def _search(index: DataFrame, queries: DataFrame, s: Scratch, k: int, tables: int, index_probes: int, probes: int, cell: int) -> DataFrame:
    """(q, c, d): nearest candidates of each query in each cell that they share.

    A bucket's candidates and queries are dealt, by node, over so many parts that a cell of one part each stays near ``cell`` rows;
    every pair of parts is a cell. The sizes of all buckets, tables x axes of them, are all that the driver sees.
    """
    left, right = s.store(index.mapInArrow(_keyed(tables, index_probes), KEYED)), s.store(queries.mapInArrow(_keyed(tables, probes), KEYED))
    n = (left.groupBy("key").agg(F.count("*").alias("n")).join(right.groupBy("key").agg(F.count("*").alias("m")), "key")
         .select("key", F.ceil(F.col("n") / cell).cast("int").alias("a"), F.ceil(F.col("m") / cell).cast("int").alias("b")))
    n = F.broadcast(s.store(n))                                           # lengths x tables x axes rows

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        part = F.pmod(F.xxhash64("node"), F.col(own))
        return df.join(n, "key").withColumn("o", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).select(
            "node", "x", "key", (part if own == "a" else F.col("o")).cast("int").alias("i"), (F.col("o") if own == "a" else part).cast("int").alias("j"))

    keys = ("key", "i", "j")
    return dealt(left, "a", "b").groupBy(*keys).cogroup(dealt(right, "b", "a").groupBy(*keys)).applyInArrow(
        _nearest(k), "q long, c long, d double")


def usable(vector: str) -> Column:
    x = F.col(vector).cast("array<double>")
    return (x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
            & F.exists(x, lambda v: v != 0))


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, tables: int = TABLES, probes: int = PROBES, cell: int = CELL) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found of each row whose vec_id is divisible by ``every``.

    ``vectors`` has vec_id and embedding; rows with a null id, a null or empty vector, all zeros, nulls or non-finite components take no
    part, and vectors of different lengths never meet. Equal vectors are one entry of the index with their k + 1 smallest ids, which
    is all that a result can hold. Every entry is in every table. Queries that find fewer than ``k`` look into all buckets of one table,
    that is at everything. Rows that repeat an id count once each.
    """
    with Scratch(vectors.sparkSession, "neighbours") as s:
        rows = s.store(vectors.where(usable("embedding") & F.col("vec_id").isNotNull()).select("vec_id", F.col("embedding").cast("array<double>").alias("x")))
        few = rows.withColumn("r", F.row_number().over(W.partitionBy("x").orderBy("vec_id"))).where(F.col("r") <= k + 1)
        entries = s.store(few.groupBy("x").agg(F.min("vec_id").alias("node"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
        asked = rows.where(F.col("vec_id") % every == 0)
        query = s.store(asked.join(entries.select("x", "node"), "x").select("vec_id", "node"))
        query_entries = s.store(entries.join(query.select("node").distinct(), "node", "left_semi").select("node", "x"))
        index = entries.select("node", "x")

        def listed(found: DataFrame) -> DataFrame:
            near = (found.groupBy("q", "c").agg(F.min("d").alias("d"))
                    .withColumn("r", F.row_number().over(W.partitionBy("q").orderBy("d", "c"))).where(F.col("r") <= k + 1))
            near = near.join(entries.select(F.col("node").alias("c"), "ids"), "c").select("q", "d", F.explode("ids").alias("vec_id"))
            return near.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy("d", "vec_id"))).where(F.col("r") <= k + 1)

        found = s.store(listed(_search(index, query_entries, s, k + 1, tables, 1, probes, cell)))
        enough = found.groupBy("q").count().where(F.col("count") > k).select(F.col("q").alias("node"))
        rest = s.store(query_entries.join(enough, "node", "left_anti"))
        if not rest.isEmpty():
            found = s.store(found.join(rest.select(F.col("node").alias("q")), "q", "left_anti").unionByName(
                listed(_search(index, rest, s, k + 1, 1, 1, 1 << 30, cell))))
        near = query.withColumnRenamed("vec_id", "query_id").withColumnRenamed("node", "q").join(found.drop("r"), "q").where("query_id <> vec_id")
        rank = F.row_number().over(W.partitionBy("query_id").orderBy("d", "vec_id"))
        return s.result(near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("d").alias("score")))


def op9_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
