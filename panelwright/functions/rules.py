"""Column functions: bins, risk scores, bands, error classes, text helpers.

Missing values are SQL NULL throughout; a comparison with NULL counts as false unless said otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bin edges, labels, weights and code lists of the clinical example panel.
AGE_EDGES = [0, 30, 45, 60, 75, 100]
AGE_LABELS = ["18-30", "31-45", "46-60", "61-75", "75+"]
BMI_EDGES = [0, 18.5, 25, 30, 100]
BMI_LABELS = ["Underweight", "Normal", "Overweight", "Obese"]
SMOKING_WEIGHTS = {"Never": 0.0, "Former": 0.3, "Current": 0.6}
RISK_CODES = ["I10", "E11", "I25", "J44", "I50"]
RISK_WEIGHTS = {"age": 0.15, "bmi": 0.12, "pressure": 0.18, "glucose": 0.20, "cholesterol": 0.08,
                "smoking": 0.10, "visits": 0.05, "lab": 0.07, "code": 0.05}


def holds(condition: Column) -> Column:
    """The condition, with NULL read as false."""
    return F.coalesce(condition, F.lit(False))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0."""
    return holds(condition).cast("int")


def number(column: str | Column) -> Column:
    """A column as double with NULL for NaN: what is learnt, ranked or averaged counts both as missing."""
    x = F.col("`" + column.replace("`", "``") + "`") if isinstance(column, str) else column
    return F.nanvl(x.cast("double"), F.lit(None).cast("double"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in floats}
    return df.withColumns({c: F.when(~F.isnan(x), x) for c, x in quoted.items()}) if floats else df


def right_closed_bin(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (lo, hi] holding ``x``; NULL outside all of them."""
    ladder = F.when(x <= edges[0], F.lit(None).cast("string"))
    for hi, label in zip(edges[1:], labels, strict=True):
        ladder = ladder.when(x <= hi, F.lit(label))
    return ladder


def age_group(age: Column) -> Column:
    return right_closed_bin(age, AGE_EDGES, AGE_LABELS)


def bmi_category(bmi: Column, top: float = 100) -> Column:
    return right_closed_bin(bmi, [*BMI_EDGES[:-1], top], BMI_LABELS)


def pressure_category(high: Column, low: Column, cuts: Sequence[float] = (120, 130, 140),
                      low_cuts: Sequence[float] = (80, 90)) -> Column:
    """Normal / Elevated / Stage 1 / Stage 2 from two readings; missing readings end in Stage 2."""
    return (F.when(holds((high < cuts[0]) & (low < low_cuts[0])), "Normal")
            .when(holds((high < cuts[1]) & (low < low_cuts[0])), "Elevated")
            .when(holds((high < cuts[2]) | (low < low_cuts[1])), "Stage 1")
            .otherwise("Stage 2"))


def count_true(conditions: Sequence[Column]) -> Column:
    """How many of the conditions hold."""
    total = F.lit(0)
    for c in conditions:
        total = total + flag(c)
    return total


def weighted_sum(parts: Sequence[tuple[Column, float]]) -> Column:
    """Sum of weight * part; a missing part contributes 0."""
    total = F.lit(0.0)
    for part, weight in parts:
        total = total + F.lit(float(weight)) * F.coalesce(part.cast("double"), F.lit(0.0))
    return total


def excess(x: Column, floor: float, scale: float) -> Column:
    """(x - floor) / scale, not below 0."""
    return F.greatest(x - F.lit(float(floor)), F.lit(0.0)) / F.lit(float(scale))


def lookup(key: Column, table: dict, default) -> Column:
    """The literal table's value for ``key``, ``default`` for unknown and missing keys."""
    if not table:
        return F.lit(default)
    pairs = [F.lit(v) for kv in table.items() for v in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def clinical_risk() -> Column:
    """The nine-part weighted risk of the example panel."""
    w = RISK_WEIGHTS
    c = F.col
    return weighted_sum([
        (excess(c("age"), 40, 60), w["age"]),
        (excess(c("bmi"), 25, 15), w["bmi"]),
        (0.5 * flag(holds(c("systolic_bp") > 140) | holds(c("diastolic_bp") > 90)), w["pressure"]),
        (0.7 * flag(c("glucose") > 126), w["glucose"]),
        (0.3 * flag(c("cholesterol") > 240), w["cholesterol"]),
        (lookup(c("smoking_status"), SMOKING_WEIGHTS, 0.0), w["smoking"]),
        (0.2 * flag(c("num_visits") > 5), w["visits"]),
        (0.4 * c("lab_abnormal_flag").cast("int"), w["lab"]),
        (0.5 * flag(c("primary_diagnosis").isin(RISK_CODES)), w["code"]),
    ])


def logistic(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def clip(x: Column, lo: float, hi: float) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(hi)), F.lit(lo)))


def threshold_label(score: Column, threshold: float | Column) -> Column:
    """1 or 0; NULL for a row without a score."""
    return F.when(score >= threshold, 1).when(score.isNotNull(), 0)


# A score outside the inner limits is a firm one, outside the outer limits a very firm one.
BANDS = {"High": (0.2, 0.8), "Medium": (0.4, 0.6)}


def confidence_band(p: Column) -> Column:
    """'High', 'Medium' or 'Low'; NULL for a row without a score."""
    ladder = F.when(p.isNull(), F.lit(None).cast("string"))
    for name, (low, high) in BANDS.items():
        ladder = ladder.when((p < low) | (p > high), name)
    return ladder.otherwise("Low")


def error_class(label: Column, pred: Column) -> Column:
    return (F.when((label == 1) & (pred == 1), "TP").when((label == 0) & (pred == 1), "FP")
            .when((label == 1) & (pred == 0), "FN").when((label == 0) & (pred == 0), "TN"))


def entity_id(number: Column, prefix: str = "P", digits: int = 6) -> Column:
    return F.format_string(f"{prefix}%0{digits}d", number.cast("long"))


def join_codes(*codes: Column) -> Column:
    """Comma list of the non-null codes."""
    return F.concat_ws(",", *codes)


def split_codes(codes: Column) -> Column:
    """Array of codes; an empty or missing list has no element."""
    return F.filter(F.split(F.coalesce(codes, F.lit("")), ","), lambda x: x != "")


def strip_prefix_int(text: Column, prefix: str) -> Column:
    """'Year_2015' -> 2015; NULL when the rest is not a whole number."""
    return F.regexp_replace(text, f"^{prefix}", "").try_cast("int")


def as_text(x: Column, missing: str = "nan") -> Column:
    return F.coalesce(x.cast("string"), F.lit(missing))


def inject_nulls(df: DataFrame, key: Sequence[str], rates: dict[tuple[str, ...], float],
                 seed: int = 42) -> DataFrame:
    """Blank cells at a given rate. Columns in one tuple share a mask; the mask depends on the row
    key and the seed only, so it does not change with the partitioning."""
    out = {}
    for group, rate in rates.items():
        draw = F.xxhash64(*[F.col(k) for k in key], F.lit(seed), F.lit("|".join(group))).bitwiseAND(F.lit(2 ** 53 - 1))
        for c in group:
            out[c] = F.when(draw >= int(rate * 2 ** 53), F.col(c))             # as fine as a double
    return df.withColumns(out)


def stamp(df: DataFrame, version: str) -> DataFrame:
    return df.withColumns({"timestamp": F.current_timestamp(), "model_version": F.lit(version)})
