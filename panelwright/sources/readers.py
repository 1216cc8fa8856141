"""Sources: Parquet, CSV, sampled scans, JSON requests, period coercion.

NaN becomes NULL in all of them but ``scan_parquet``, whose columns are the file's own, so that filters on them reach the file. The
operators count NaN as missing wherever they learn, rank or average.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.rules import nan_to_null


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A file, a directory or a partitioned tree as it is; partition columns come last."""
    return spark.read.parquet(path)


def read_parquet(spark: SparkSession, path: str, where: str | Column | None = None) -> DataFrame:
    """The same with NULL for NaN, and only the rows that ``where`` holds for.

    The condition is asked twice: of the file's own columns, where it can be pushed into the scan, and again of the cleaned ones, as NaN
    is larger than any number to a scan and must not pass as one. It may be false for NULL only, as comparisons are.
    """
    raw = scan_parquet(spark, path)
    if where is None:
        return nan_to_null(raw)
    condition = F.expr(where) if isinstance(where, str) else where
    return nan_to_null(raw.where(condition)).where(condition)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header. The schema is given, not inferred; whole numbers become double because a
    CSV column may hold missing values."""
    wide = T.StructType([
        T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.IntegralType) else f.dataType)
        for f in schema])
    return nan_to_null(spark.read.schema(wide).option("header", True).csv(path))


def load_data(spark: SparkSession, path: str, schema: T.StructType | None = None,
              sample_fraction: float = 1.0, key: Sequence[str] = (), seed: int = 42,
              period: str | None = None, where: str | Column | None = None) -> DataFrame:
    """Read by suffix, filter and sample early, coerce the period to a whole number."""
    if path.endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV source needs a schema")
        df = read_csv(spark, path, schema)
        df = df if where is None else df.where(where)
    else:
        df = read_parquet(spark, path, where)
    if sample_fraction < 1.0:
        df = sample_rows(df, sample_fraction, key, seed)
    return coerce_period(df, period) if period else df


def sample_rows(df: DataFrame, fraction: float, key: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """A random share of the rows; with ``key`` the choice depends on the key and seed only."""
    if not key:
        return df.sample(False, fraction, seed)
    draw = F.xxhash64(*key, F.lit(seed)).bitwiseAND(F.lit(2 ** 53 - 1))       # as fine as a double
    return df.where(draw < int(fraction * 2 ** 53))


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (a small number): the lowest hashes of the key."""
    return df.orderBy(F.xxhash64(*key, F.lit(seed)), *key).limit(n)


def coerce_period(df: DataFrame, period: str = "year") -> DataFrame:
    """The period as int; what is not a number becomes NULL."""
    return df.withColumn(period, F.col(period).try_cast("double").try_cast("int"))


# Field names and types of a scoring request.
REQUEST_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()), T.StructField("year", T.IntegerType()),
    T.StructField("age", T.DoubleType()), T.StructField("gender", T.StringType()),
    T.StructField("bmi", T.DoubleType()), T.StructField("systolic_bp", T.DoubleType()),
    T.StructField("diastolic_bp", T.DoubleType()), T.StructField("cholesterol", T.DoubleType()),
    T.StructField("glucose", T.DoubleType()), T.StructField("smoking_status", T.StringType()),
    T.StructField("num_visits", T.IntegerType()), T.StructField("medications_count", T.IntegerType()),
    T.StructField("lab_abnormal_flag", T.BooleanType()), T.StructField("primary_diagnosis", T.StringType()),
    T.StructField("additional_diagnoses", T.StringType()), T.StructField("age_group", T.StringType()),
    T.StructField("bmi_category", T.StringType()),
])


def read_requests(spark: SparkSession, path: str, schema: T.StructType = REQUEST_SCHEMA) -> DataFrame:
    """JSON files, one request per line."""
    return nan_to_null(spark.read.schema(schema).json(path))


def parse_requests(df: DataFrame, body: str, schema: T.StructType = REQUEST_SCHEMA,
                   batch_field: str | None = None) -> DataFrame:
    """Requests held as JSON text in a column: one object per row, or an array of objects under
    ``batch_field``. Other columns are kept; the request fields are appended."""
    rest = [c for c in df.columns if c != body]
    if batch_field is None:
        return nan_to_null(df.select(*rest, F.from_json(body, schema).alias("_r")).select(*rest, "_r.*"))
    outer = T.StructType([T.StructField(batch_field, T.ArrayType(schema))])
    return nan_to_null(df.select(*rest, F.from_json(body, outer).alias("_r"))
                       .select(*rest, F.inline(F.col(f"_r.{batch_field}"))))
