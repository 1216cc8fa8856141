"""Scoring of new rows: check, derive, align, predict, answer. The same plan serves tables and streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import rules as R
from panelwright.ml.models import with_probability
from panelwright.ml.stages import ColumnAligner
from panelwright.operators.quality import Rule, request_rules, route, row_violations
from panelwright.runtime import quoted
from panelwright.sources.artifacts import Artifacts

Scorer = Callable[[DataFrame], DataFrame]

# Columns that a request may leave to derive_request_columns.
DERIVED = {"birth_year", "age_group", "bmi_category"}


def derive_request_columns(df: DataFrame) -> DataFrame:
    """Birth year, and the age and weight groups where the request does not bring them."""
    out = df.withColumn("birth_year", F.col("year") - F.col("age"))
    for name, value in (("age_group", R.age_group(F.col("age"))), ("bmi_category", R.bmi_category(F.col("bmi")))):
        given = F.col(name) if name in df.columns else F.lit(None).cast("string")
        out = out.withColumn(name, R.as_text(F.coalesce(given, value)))
    return out


def model_scorer(artifacts: Artifacts, keep: Sequence[str], probability: str = "probability") -> Scorer:
    """Derive the request columns the model knows, align the rows with its input columns, run the pipeline; keep ``keep`` and the probability."""
    aligner = ColumnAligner(columns=[c for c in artifacts.inputs if c not in keep], keep=list(keep))

    derives = not DERIVED.isdisjoint(artifacts.inputs)

    def score(df: DataFrame) -> DataFrame:
        if derives and {"year", "age", "bmi"} <= set(df.columns):
            df = derive_request_columns(df)
        return with_probability(artifacts.model.transform(aligner.transform(df)), probability).select(*keep, probability)

    return score


def row_wise(scorer: Scorer) -> Scorer:
    """Mark a scorer that looks at one row alone, keeps all columns and takes NULL inputs: valid and rejected rows then share one evaluation of the source."""
    scorer.row_wise = True
    return scorer


def _answer_in_place(df: DataFrame, scorer: Scorer, keep: Sequence[str], threshold: float, version: str, rules: Sequence[Rule],
                     required: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """One pass: the inputs of a rejected row are blanked before it is scored, and its answer is set afterwards."""
    checked = row_violations(df, rules, required=required)
    ok = F.size("violations") == 0
    kept = {*keep, "violations"}
    scored = scorer(checked.withColumns({c: F.when(ok, F.col(quoted(c))).alias(c) for c in checked.columns if c not in kept}))
    p = F.col("probability")
    return scored.select(
        *keep, F.when(ok, p).otherwise(F.lit(0.0)).alias("probability"), F.when(ok, R.threshold_label(p, threshold)).otherwise(F.lit(0)).alias("prediction"),
        F.when(ok, R.confidence_band(p)).otherwise(F.lit("Error")).alias("confidence"),
        F.when(ok, F.lit(version)).otherwise(F.lit("error")).alias("model_version"), *extra)


def answer(df: DataFrame, scorer: Scorer, keep: Sequence[str], threshold: float = 0.5, version: str = "unknown",
           rules: Sequence[Rule] | None = None, required: Sequence[str] = (), with_violations: bool = False) -> DataFrame:
    """(keep, probability, prediction, confidence, timestamp, model_version) for every row.

    A row that breaks a rule is answered, too: probability 0, confidence 'Error', version 'error'.
    """
    rules = request_rules() if rules is None else list(rules)
    extra = ["violations"] if with_violations else []
    if getattr(scorer, "row_wise", False):
        return _answer_in_place(df, scorer, keep, threshold, version, rules, required, extra).withColumn("timestamp", F.current_timestamp())
    valid, rejected = route(row_violations(df, rules, required=required))
    p = F.col("probability")
    good = scorer(valid).select(*keep, p, R.threshold_label(p, threshold).alias("prediction"),
                                R.confidence_band(p).alias("confidence"), F.lit(version).alias("model_version"),
                                *[F.array().cast("array<string>").alias(c) for c in extra])
    bad = rejected.select(*keep, F.lit(0.0).alias("probability"), F.lit(0).alias("prediction"),
                          F.lit("Error").alias("confidence"), F.lit("error").alias("model_version"), *extra)
    return good.unionByName(bad).withColumn("timestamp", F.current_timestamp())
