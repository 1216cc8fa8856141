"""What the operators of this folder share: reading tables, durable intermediates, batch-wise functions."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.runtime import new_path, quoted
from panelwright.sources.readers import read_parquet

PLACED_ROWS = 200_000        # rows of one range of a global order, about


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written during one run of an operator; all but the result are deleted at its end.

    The files lie in the shared folder, so they survive lost executors, and rewriting a table needs
    no recomputation of what came before it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.kept = spark, new_path(spark, name), new_path(spark, f"{name}-result")
        self.tables = 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        self._delete(self.root)

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self, number: int) -> None:
        """Delete the table that was the ``number``-th to be stored (0: none); nothing may read it any more."""
        if number:
            self._delete(f"{self.root}/{number}")

    def _write(self, df: DataFrame, path: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def store(self, df: DataFrame) -> DataFrame:
        self.tables += 1
        return self._write(df, f"{self.root}/{self.tables}")

    def result(self, df: DataFrame) -> DataFrame:
        return self._write(df, self.kept)


def per_worker(name: str, make: Callable):
    """One object per Python worker, made at first use and kept for the worker's later tasks.

    Functions are sent with their code, so a module global would start afresh with every task.
    """
    state = sys.modules.setdefault("panelwright_worker_state", types.ModuleType("panelwright_worker_state"))
    if not hasattr(state, name):
        setattr(state, name, make())
    return getattr(state, name)


def batches(fn: Callable[[pa.RecordBatch], Iterator[dict] | dict], schema: pa.Schema):
    """A ``mapInArrow`` function from one that turns a batch into column dicts."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out = fn(batch)
            for columns in ([out] if isinstance(out, dict) else out):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], f.type) for f in schema], schema=schema)

    return run


def _places():
    """Rows of a sorted partition with the partition's number and their place in it."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in stream:
            n = len(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))],
                                             [*batch.schema.names, "_part", "_place"])
            at += n

    return run


def numbered(df: DataFrame, s: Scratch, *order: Column, rows: int = PLACED_ROWS) -> DataFrame:
    """``df`` with each row's place in the order, from 0 (_place).

    Ranges of about ``rows`` rows are sorted on their own and stored with the places in them; a range's first place is the number of
    rows in those before. One number a range reaches the driver. Rows that are equal in all of ``order`` share a range.
    """
    ranges = max(1, -(-df.count() // rows))
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_place", T.LongType())])
    told = s.store(df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(_places(), schema))
    sizes = sorted((r["_part"], r["n"]) for r in told.groupBy("_part").agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for part, n in sizes:
        starts.append((part, before))
        before += n
    first = F.broadcast(df.sparkSession.createDataFrame(starts, "_part int, _first long"))                     # one row a range
    return told.join(first, "_part").withColumn("_place", F.col("_place") + F.col("_first")).drop("_part", "_first")


def train_row(doc_id: str = "doc_id") -> Column:
    """Whether labels of this row may be learnt: crc32 of the id's decimal text, modulo 3, is not 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 != 1, F.lit(False))


def whole_rows(docs: DataFrame, value: Column) -> DataFrame:
    """(_row, _value): each row as one struct, whatever its columns are called, and a value of it."""
    return docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row"), value.alias("_value"))


def labelled_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, label, text) of the chosen ids: one row each, the smallest of its texts, so repeated rows neither multiply nor depend on their order."""
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")                    # the sample's documented size
    return found.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text"))


def labelled_sample(labels: DataFrame, label: str, per_class: int, keep: Sequence[int] = (0, 1)) -> DataFrame:
    """At most ``per_class`` training rows of each class, chosen by a hash of the id: (doc_id, label).

    The bound is the fitting sample's documented size; everything that is not a label still covers all rows.
    """
    rows = labels.where(train_row() & F.col(label).isin(*keep)).groupBy("doc_id").agg(F.max(label).alias("label"))
    order = F.xxhash64("doc_id", F.lit(17))
    parts = [rows.where(F.col("label") == v).orderBy(order, "doc_id").limit(per_class) for v in keep]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
