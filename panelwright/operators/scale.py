"""Column scaling with the parameters found in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.rules import number

METHODS = ("standard", "minmax")


def scaling_parameters(df: DataFrame, cols: Sequence[str], method: str = "standard") -> dict[str, tuple[float, float]]:
    """(center, width) per column: mean and population deviation, or minimum and range. A width of
    zero becomes 1, so constants map to 0."""
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method}")
    if not cols:
        return {}
    low, high = (F.avg, F.stddev_pop) if method == "standard" else (F.min, F.max)
    row = df.agg(*[f(number(c)).alias(f"{n}|{c}") for c in cols for n, f in (("a", low), ("b", high))]).first()
    out = {}
    for c in cols:
        a, b = row[f"a|{c}"], row[f"b|{c}"]
        if a is not None:
            width = b if method == "standard" else b - a
            out[c] = (float(a), float(width) or 1.0)
    return out


def scale(df: DataFrame, parameters: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(a)) / F.lit(w)
                           for c, (a, w) in parameters.items() if c in df.columns})
