"""Fill values for missing cells, found in one aggregation per column kind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.rules import flag, number
from panelwright.operators.quantiles import exact_quantiles
from panelwright.runtime import quoted

NUMERIC = ("median", "mean", "constant")
CATEGORICAL = ("most_frequent", "constant")


def vector_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, VectorUDT)]


def columns_by_kind(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, text) column names; booleans count as neither, cast them first."""
    fields = [f for f in df.schema if f.name not in exclude]
    return ([f.name for f in fields if isinstance(f.dataType, T.NumericType)],
            [f.name for f in fields if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))])


def booleans_to_int(df: DataFrame) -> DataFrame:
    flags = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.col(c).cast("int") for c in flags})


def numeric_fills(df: DataFrame, cols: Sequence[str], strategy: str = "median", constant: float = 0.0,
                  exact: bool = True) -> dict[str, float]:
    """Fill value per column; a column without any value gets none and stays empty."""
    if strategy not in NUMERIC:
        raise ValueError(f"unknown numeric strategy: {strategy}")
    if not cols:
        return {}
    if strategy == "constant":
        return {c: float(constant) for c in cols}
    if strategy == "mean":
        row = df.agg(*[F.avg(number(c)).alias(c) for c in cols]).first().asDict()
    elif exact:
        row = {r["feature"]: r["value"] for r in exact_quantiles(df, cols, [0.5]).collect()}  # one per column
    else:
        row = df.agg(*[F.percentile_approx(number(c), 0.5, 100_000).alias(c) for c in cols]).first().asDict()
    return {c: float(row[c]) for c in cols if row.get(c) is not None}


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """The most frequent value per column, the smallest among equals. Values are counted map-side,
    then only (column, value, count) rows are compared."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = (df.select(F.inline(cells)).where(F.col("value").isNotNull())
              .groupBy("feature", "value").agg(F.count("*").alias("n")))
    best = counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
    return {r["feature"]: r["value"] for r in best.collect()}                      # one per column


def categorical_fills(df: DataFrame, cols: Sequence[str], strategy: str = "most_frequent",
                      constant: str = "missing_value") -> dict[str, str]:
    if strategy not in CATEGORICAL:
        raise ValueError(f"unknown categorical strategy: {strategy}")
    if not cols:
        return {}
    return modes(df, cols) if strategy == "most_frequent" else {c: constant for c in cols}


def columns_with_nulls(df: DataFrame, cols: Sequence[str]) -> list[str]:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[i] > 0]


def sparse_columns(df: DataFrame, cols: Sequence[str], limit: float = 0.5) -> list[str]:
    """The columns whose share of missing cells (NULL or NaN) is above ``limit``; none in an empty table."""
    kinds = {f.name: f.dataType for f in df.schema}
    held = [F.count(number(c) if isinstance(kinds[c], (T.DoubleType, T.FloatType)) else F.col(quoted(c))).alias(f"n{i}") for i, c in enumerate(cols)]
    row = df.agg(F.count("*").alias("n"), *held).first()
    return [c for i, c in enumerate(cols) if row["n"] and 1 - row[f"n{i}"] / row["n"] > limit]


def fill(df: DataFrame, fills: dict, indicators: Sequence[str] = ()) -> DataFrame:
    """Add ``{c}_was_missing`` for the indicator columns, then fill. Numeric columns become double."""
    marks = {f"{c}_was_missing": flag(F.col(c).isNull()) for c in indicators if c in df.columns}
    kinds = {f.name: f.dataType for f in df.schema}
    filled = {}
    for c, v in fills.items():
        if c in kinds:
            x = F.col(c).cast("double") if isinstance(kinds[c], T.NumericType) else F.col(c)
            filled[c] = F.coalesce(x, F.lit(v))
    return df.withColumns({**marks, **filled})
