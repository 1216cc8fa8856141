"""Declarative data-quality rules: table reports, row-level violations, routing, key uniqueness."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.rules import holds


@dataclass(frozen=True)
class Range:
    """Values below ``low`` or above ``high`` violate; a missing value does not."""
    feature: str
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Allowed:
    """Values outside the list violate; a missing value does, too."""
    feature: str
    values: tuple


@dataclass(frozen=True)
class MissingRate:
    """Violated when the share of missing values is strictly above ``limit``."""
    feature: str
    limit: float = 0.1


@dataclass(frozen=True)
class Less:
    """``feature`` must be below ``other`` in the same row."""
    feature: str
    other: str


Rule = Range | Allowed | MissingRate | Less


def clinical_rules() -> list[Rule]:
    """The rule set of the clinical example panel."""
    return [
        Range("age", 0, 120), Range("bmi", 10, 60), Range("systolic_bp", 70, 250),
        Range("diastolic_bp", 40, 150), Range("glucose", 50, 500), Range("cholesterol", 100, 500),
        Allowed("gender", ("M", "F")), Allowed("smoking_status", ("Never", "Former", "Current")),
        MissingRate("age", 0.01), MissingRate("gender", 0.01), MissingRate("year", 0.01),
        MissingRate("patient_id", 0.01),
    ]


def request_rules() -> list[Rule]:
    """The limits of one scoring request."""
    return [
        Range("year", 2000, 2030), Range("age", 0, 120), Range("bmi", 10, 60),
        Range("systolic_bp", 70, 250), Range("diastolic_bp", 40, 150), Range("cholesterol", 100, 500),
        Range("glucose", 50, 500), Range("num_visits", 0, 50), Range("medications_count", 0, 20),
        Allowed("gender", ("M", "F")), Allowed("smoking_status", ("Never", "Former", "Current")),
        Less("diastolic_bp", "systolic_bp"),
    ]


@dataclass
class Validator:
    """Rules collected one by one; rules on absent columns are skipped."""

    rules: list[Rule] = field(default_factory=list)

    def add_rule(self, feature: str, kind: str, **params) -> Validator:
        if kind == "range":
            self.rules.append(Range(feature, params.get("min"), params.get("max")))
        elif kind == "categorical":
            self.rules.append(Allowed(feature, tuple(params.get("allowed_values", ()))))
        elif kind == "missing_rate":
            self.rules.append(MissingRate(feature, params.get("max_rate", 0.1)))
        else:
            raise ValueError(f"unknown rule type: {kind}")
        return self

    def report(self, df: DataFrame) -> DataFrame:
        return quality_report(df, self.rules)

    def validate(self, df: DataFrame) -> dict[str, list[str]]:
        """Messages per violated feature (at most one per rule)."""
        out: dict[str, list[str]] = {}
        for r in self.report(df).where("violated").orderBy("ord").collect():
            out.setdefault(r["feature"], []).append(r["message"])
        return out


def _checks(rule: Rule, columns: Sequence[str]) -> list[tuple[str, str, float | None, Column]]:
    """(feature, rule name, bound, row-level violation) entries of one rule."""
    if rule.feature not in columns:
        return []
    c = F.col(rule.feature)
    if isinstance(rule, Range):
        out = []
        if rule.low is not None:
            out.append((rule.feature, "min", float(rule.low), holds(c < rule.low)))
        if rule.high is not None:
            out.append((rule.feature, "max", float(rule.high), holds(c > rule.high)))
        return out
    if isinstance(rule, Allowed):
        return [(rule.feature, "allowed", None, ~holds(c.isin(list(rule.values))))]
    if isinstance(rule, Less):
        return ([(rule.feature, f"below_{rule.other}", None, holds(c >= F.col(rule.other)))]
                if rule.other in columns else [])
    return [(rule.feature, "missing_rate", float(rule.limit), c.isNull())]


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(ord, feature, rule, bound, n_violations, rate, violated, message) for every check.

    All checks are counted in one aggregation, then the single result row is turned to long form.
    """
    checks = [c for r in rules for c in _checks(r, df.columns)]
    if not checks:
        raise ValueError("no rule applies to this table")
    counted = df.agg(F.count("*").alias("n"), *[F.count_if(v).alias(f"v{i}") for i, (*_, v) in enumerate(checks)])
    long = counted.select("n", F.inline(F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(f).alias("feature"), F.lit(r).alias("rule"),
                 F.lit(b).cast("double").alias("bound"), F.col(f"v{i}").alias("n_violations"))
        for i, (f, r, b, _) in enumerate(checks)])))
    rate = F.coalesce(F.try_divide(F.col("n_violations").cast("double"), F.col("n")), F.lit(0.0))
    bound = F.format_string("%s", F.col("bound"))
    return (long.withColumn("rate", rate)
            .withColumn("violated", F.when(F.col("rule") == "missing_rate", F.col("rate") > F.col("bound"))
                        .otherwise(F.col("n_violations") > 0))
            .withColumn("message", F.when(F.col("rule") == "min", F.concat("n_violations", F.lit(" values below minimum "), bound))
                        .when(F.col("rule") == "max", F.concat("n_violations", F.lit(" values above maximum "), bound))
                        .when(F.col("rule") == "allowed", F.concat("n_violations", F.lit(" invalid categorical values")))
                        .when(F.col("rule") == "missing_rate", F.format_string(
                            "Missing rate %.2f%% exceeds %.2f%%", F.col("rate") * 100, F.col("bound") * 100))
                        .otherwise(F.concat("n_violations", F.lit(" rows break "), "rule")))
            .drop("n"))


def row_violations(df: DataFrame, rules: Sequence[Rule], out: str = "violations",
                   required: Sequence[str] = ()) -> DataFrame:
    """Add an array of ``feature:rule`` texts, one per violated row-level rule, in rule order.
    A missing value in a ``required`` column is reported as ``feature:required``."""
    marks = [F.when(F.col(c).isNull(), F.lit(f"{c}:required")) for c in required if c in df.columns]
    for r in rules:
        if not isinstance(r, MissingRate):
            marks += [F.when(v, F.lit(f"{f}:{name}")) for f, name, _, v in _checks(r, df.columns)]
    return df.withColumn(out, F.array_compact(F.array(*marks)))


def route(df: DataFrame, violations: str = "violations") -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows)."""
    bad = F.size(violations) > 0
    return df.where(~bad), df.where(bad)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
