"""Rules callable from SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from panelwright.functions.rules import BANDS

_FUNCTIONS = (
    f"""CREATE OR REPLACE TEMPORARY FUNCTION confidence_band(p DOUBLE) RETURNS STRING RETURN
       CASE WHEN p IS NULL THEN NULL {" ".join(f"WHEN p < {low}D OR p > {high}D THEN '{name}'" for name, (low, high) in BANDS.items())} ELSE 'Low' END""",
    """CREATE OR REPLACE TEMPORARY FUNCTION pressure_category(high DOUBLE, low DOUBLE) RETURNS STRING RETURN
       CASE WHEN high < 120 AND low < 80 THEN 'Normal' WHEN high < 130 AND low < 80 THEN 'Elevated'
            WHEN high < 140 OR low < 90 THEN 'Stage 1' ELSE 'Stage 2' END""",
)


def register_sql_functions(spark: SparkSession) -> None:
    """Temporary SQL functions; they are expanded into plain expressions by the optimizer."""
    for text in _FUNCTIONS:
        spark.sql(text)
