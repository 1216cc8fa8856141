"""Shared building blocks: durable intermediates, checked-size joins, scalars."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup table with at most this many rows and bytes is broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# A key that holds more than one part in so many of the rows is hot; there are at most so many of them.
HOT_SHARE = 256
# Rows below which no key is worth a join of its own.
HOT_LEAST = 10_000

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster in spark.checkpoint.dir."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not re.match(r"local($|\[)", context.master):            # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="panelwright-")
    return _local_dirs[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage and lets several later jobs reuse one evaluation; the files survive the
    loss of any executor.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_rows = None
    out._stored_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing will read again."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_path)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def stored_rows(df: DataFrame) -> int | None:
    """Row count of a materialized table, read from its files once; None for any other frame."""
    if "_stored_rows" not in df.__dict__:
        return None
    if df._stored_rows is None:
        df._stored_rows = df.count()
    return df._stored_rows


def quoted(name: str) -> str:
    """A column name for ``F.col``, also with dots or backticks in it."""
    return "`" + name.replace("`", "``") + "`"


def _row_size(df: DataFrame) -> tuple[int, Column | None]:
    """(bytes of a row's numbers, dates and flags, bytes of its other columns as text or None if there are none)."""
    fixed, parts = 0, []
    for f in df.schema:
        c = F.col(quoted(f.name))
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.octet_length(c))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) or f.dataType.typeName() in ("variant", "udt"):
            parts.append(F.octet_length(F.to_json(F.struct(c))))
        else:
            fixed += 16
    return fixed, sum((F.coalesce(x, F.lit(0)) for x in parts[1:]), F.coalesce(parts[0], F.lit(0))).cast("long") if parts else None


def at_most(df: DataFrame, rows: int, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``rows`` rows that take at most about ``size`` bytes.

    At most ``rows`` + 1 rows are looked at; of a stored table only the files' counts, unless it holds text or nested values.
    """
    known = stored_rows(df)
    if known is not None and known > rows:
        return False
    fixed, text = _row_size(df)
    if known is not None and text is None:
        return known * fixed <= size
    n, total = df.limit(rows + 1).agg(F.count("*"), F.sum(text if text is not None else F.lit(0).cast("long"))).first()
    return n <= rows and n * fixed + (total or 0) <= size


def hot_keys(df: DataFrame, on: Sequence[str], share: int = HOT_SHARE, least: int = HOT_LEAST) -> list[int]:
    """Hashes of the keys that hold more than 1/``share`` of the rows, and more than ``least``: at most ``share`` numbers.

    One pass in which every task keeps a bounded frequent-items sketch; sketches merge, and miss no such key.
    """
    key = F.xxhash64(*[F.col(quoted(c)) for c in on])
    found = df.select(key.alias("_key")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(_key, {share}, {32 * share})").alias("top")).first()
    limit = max(least, found["n"] / share)
    return sorted(r["item"] for r in found["top"] or [] if r["count"] > limit)


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", broadcast_rows: int = BROADCAST_ROWS,
                broadcast_bytes: int = BROADCAST_BYTES, share: int = HOT_SHARE, least: int = HOT_LEAST) -> DataFrame:
    """Equi-join ('left', 'inner', 'left_semi', 'left_anti') ``left`` with a lookup table whose keys are unique.

    The lookup's rows and bytes are checked first. Within the limits it is broadcast and the left side does not move. Beyond them a
    sketch over the left keys names the hot ones: rows that hold one, equal or not, stay where they are and meet the few lookup rows of hot
    keys, which are broadcast; all other rows are shuffled on the key, once. Null keys never match.
    """
    on = list(on)
    if at_most(right, broadcast_rows, broadcast_bytes):
        return left.join(F.broadcast(right), on, how)
    hot = hot_keys(left, on, share, least)
    if not hot:
        return left.join(right, on, how)
    is_hot = F.xxhash64(*[F.col(quoted(c)) for c in on]).isin(hot)         # at most ``share`` numbers
    few, many = right.where(is_hot), right.where(~is_hot)
    return left.where(~is_hot).join(many, on, how).unionByName(left.where(is_hot).join(F.broadcast(few), on, how))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of the same names in which NULL matches NULL; the keys are kept once."""
    renamed = right.select(*[F.col(quoted(c)).alias(f"_right_{c}" if c in on else c) for c in right.columns])
    match = F.lit(True)
    for c in on:
        match = match & F.col(quoted(c)).eqNullSafe(F.col(quoted(f"_right_{c}")))
    return left.join(renamed, match, how).drop(*[f"_right_{c}" for c in on])


def one_row(df: DataFrame) -> dict:
    """The single row of an aggregate as a dict of scalars."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("expected exactly one row")
    return rows[0].asDict()


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL for a zero denominator."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def div0(a: Column, b: Column) -> Column:
    """a / b, 0 for a zero denominator."""
    return F.coalesce(safe_div(a, b), F.lit(0.0))
