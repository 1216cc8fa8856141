"""Hand-computed values."""

import math

import pytest
from pyspark.sql import functions as F

from panelwright.functions import rules as R
from panelwright.ml.models import make_classifier
from panelwright.ml.stages import MissingValueHandler
from panelwright.operators import encode, impute, metrics, profile, scale, temporal, thresholds
from panelwright.operators.quality import Validator, clinical_rules, quality_report, request_rules, row_violations
from panelwright.sources.ledger import flatten_rows


def test_missing_values(spark):
    df = spark.createDataFrame([(7.0, "red", 1), (None, "blue", 0), (3.0, None, 1), (9.0, "blue", 0), (4.0, "red", 1), (None, "blue", 1)],
                               "amount double, colour string, y int")
    model = MissingValueHandler().fit(df)
    out = model.transform(df).collect()
    assert [r["amount"] for r in out] == [7.0, 5.5, 3.0, 9.0, 4.0, 5.5]
    assert [r["colour"] for r in out] == ["red", "blue", "blue", "blue", "red", "blue"]
    assert [r["amount_was_missing"] for r in out] == [0, 1, 0, 0, 0, 1]
    assert [r["colour_was_missing"] for r in out] == [0, 0, 1, 0, 0, 0]
    assert "y_was_missing" not in model.transform(df).columns


def test_all_null_column_stays_empty_and_is_reported(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    model = MissingValueHandler().fit(df)
    assert model.fitted["empty"] == ["a"]
    assert model.transform(df).where("a is null").count() == 2


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "x string")
    assert impute.modes(df, ["x"]) == {"x": "a"}


def test_unknown_strategies_fail(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(ValueError):
        impute.numeric_fills(df, ["a"], "knn")
    with pytest.raises(ValueError):
        scale.scaling_parameters(df, ["a"], "robust")
    with pytest.raises(ValueError):
        MissingValueHandler(strategy="median")
    with pytest.raises(ValueError):
        make_classifier("perceptron")
    with pytest.raises(ValueError):
        make_classifier("gbt", {"no_such_setting": 1})


def test_validation(spark):
    df = spark.createDataFrame([(-3, 61.0, "F", 69.0), (88, 44.5, "f", 180.0), (130, 70.5, "M", 90.0), (64, 20.0, "M", None)],
                               "age int, bmi double, gender string, systolic_bp double")
    v = Validator(rules=clinical_rules())
    assert v.validate(df) == {
        "age": ["1 values below minimum 0.0", "1 values above maximum 120.0"], "bmi": ["2 values above maximum 60.0"],
        "gender": ["1 invalid categorical values"], "systolic_bp": ["1 values below minimum 70.0"]}


def test_null_is_invalid_category_but_in_range(spark):
    df = spark.createDataFrame([(None, None), (30, "M")], "age int, gender string")
    rows = {(r["feature"], r["rule"]): r["n_violations"] for r in quality_report(df, clinical_rules()).collect()}
    assert rows[("gender", "allowed")] == 1
    assert rows[("age", "min")] == rows[("age", "max")] == 0
    assert rows[("age", "missing_rate")] == 1


def test_request_rules(spark):
    df = spark.createDataFrame([(150.0, "M", 120.0, 80.0), (40.0, "X", 120.0, 120.0), (40.0, "F", 120.0, 80.0)],
                               "age double, gender string, systolic_bp double, diastolic_bp double")
    out = [r["violations"] for r in row_violations(df, request_rules()).collect()]
    assert out == [["age:max"], ["gender:allowed", "diastolic_bp:below_systolic_bp"], []]


ROLL = [("u", 2001, 4.0), ("u", 2002, 1.0), ("u", 2003, 9.0), ("w", 2002, -2.0), ("w", 2003, 6.0)]


@pytest.mark.parametrize("bounded", [True, False])
def test_rolling_features(spark, bounded):
    df = spark.createDataFrame(ROLL, "e string, year int, value double").repartition(3)
    out = temporal.rolling_features(df, "e", "year", ["value"], 2, 1, temporal.AGGREGATIONS, True, bounded)
    rows = out.orderBy("e", "year").collect()
    got = [[round(r[f"value_rolling_{a}_2y"], 6) for a in temporal.AGGREGATIONS] + [r["value_lag_1y"]] for r in rows]
    assert got == [[4, 0, 4, 4, 0, 0], [2.5, 2.12132, 1, 4, -3, 4], [5, 5.656854, 1, 9, 8, 1],
                   [-2, 0, -2, -2, 0, 0], [2, 5.656854, -2, 6, 8, -2]]


def test_rolling_gap_year_and_null(spark):
    df = spark.createDataFrame([("P", 2018, 1.0), ("P", 2021, 7.0), ("P", 2022, None)], "e string, year int, value double")
    rows = temporal.rolling_features(df, "e", "year", ["value"], 2, 1, ["mean", "trend"]).orderBy("year").collect()
    assert [r["value_rolling_trend_2y"] for r in rows] == [0.0, 2.0, 0.0]
    assert [r["value_rolling_mean_2y"] for r in rows] == [1.0, 4.0, 7.0]


def test_rolling_needs_keys_and_known_aggregations(spark):
    df = spark.createDataFrame(ROLL, "e string, year int, value double")
    with pytest.raises(ValueError):
        temporal.rolling_features(df, "nobody", "year")
    with pytest.raises(ValueError):
        temporal.rolling_features(df, "e", "year", ["value"], aggs=["mode"])


def test_target_encoding(spark):
    df = spark.createDataFrame([("x", 0), ("x", 0), ("x", 1), ("y", 1), ("y", 1), ("z", 0), ("x", 1)], "category string, target int")
    got = {r["category"]: round(r["value"], 7) for r in encode.target_map(df, "category", "target").collect()}
    # Four of seven are 1; weights 1 / (1 + e^0.8), 1 / (1 + e^0.9) and 1 / (1 + e^0.95).
    assert got == {"x": 0.5492839, "y": 0.6953074, "z": 0.4120658}
    new = spark.createDataFrame([("new",), (None,)], "category string")
    out = encode.apply_map(new, encode.target_map(df, "category", "target"), ["category"], 0.6, "x").collect()
    assert [r["x"] for r in out] == [0.6, 0.6]


def test_label_encoding_and_unseen_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "x string")
    table = encode.label_map(df, "x")
    assert {r["x"]: r["value"] for r in table.collect()} == {"a": 0, "b": 1, "c": 2}
    ranged = encode.label_map(df, "x", checked_rows=0, rows_per_range=1)
    assert {r["x"]: r["value"] for r in ranged.collect()} == {"a": 0, "b": 1, "c": 2}
    unseen = spark.createDataFrame([("d",)], "x string")
    assert encode.label_encode(unseen, "x", table, "keep").first()["x_code"] == -1
    with pytest.raises(Exception, match="unseen value"):
        encode.label_encode(unseen, "x", table).collect()


def test_scaling_of_a_constant(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "a double, b double")
    for method, b in (("standard", [-1.0, 1.0]), ("minmax", [0.0, 1.0])):
        out = scale.scale(df, scale.scaling_parameters(df, ["a", "b"], method)).orderBy("b").collect()
        assert [r["a"] for r in out] == [0.0, 0.0]
        assert [r["b"] for r in out] == b


SCORES = list(zip([1, 0, 1, 1, 0, 0, 1, 0, 0], [.95, .85, .75, .55, .5, .35, .25, .15, .05], strict=True))


def test_thresholds(spark):
    df = spark.createDataFrame(SCORES, "label int, score double")
    assert round(thresholds.optimize_threshold(df, "f1_optimal"), 7) == 0.5040404
    assert thresholds.optimize_threshold(df, "precision_recall_curve") == 0.55
    assert thresholds.optimize_threshold(df, "youden_j") == 0.55
    with pytest.raises(ValueError):
        thresholds.optimize_threshold(df, "coin")


def test_threshold_without_positives_is_the_default(spark):
    df = spark.createDataFrame([(0, .2), (0, .9)], "label int, score double")
    assert thresholds.optimize_threshold(df, "f1_optimal") == 0.5


EVAL = list(zip([1, 1, 0, 0, 0, 1, 0], [1, 0, 0, 1, 0, 1, 0], [.8, .3, .2, .6, .1, .9, .4], strict=True))


def test_metrics(spark):
    df = spark.createDataFrame(EVAL, "label int, pred int, score double")
    m = metrics.classification_metrics(df).first().asDict()
    want = {"true_positives": 2, "false_negatives": 1, "true_negatives": 3, "false_positives": 1, "accuracy": 5 / 7,
            "precision": 2 / 3, "recall": 2 / 3, "specificity": .75, "npv": .75, "ppv": 2 / 3, "number_needed_to_screen": 1.5,
            "roc_auc": 10 / 12, "pr_auc": 2.6 / 3, "f1_score": 2 / 3, "sample_size": 7}
    assert {k: round(m[k], 9) for k in want} == {k: round(v, 9) for k, v in want.items()}
    c = metrics.calibration_error(df).first()
    assert round(c["brier_score"], 6) == round(1.11 / 7, 6)
    assert round(c["expected_calibration_error"], 6) == round(2.3 / 7, 6)


def test_metrics_of_ties_and_single_classes(spark):
    tied = spark.createDataFrame([(1, 0, .5), (0, 0, .5)], "label int, pred int, score double")
    m = metrics.classification_metrics(tied).first()
    assert m["roc_auc"] == 0.5 and m["precision"] == 0.0 and math.isinf(m["number_needed_to_screen"])
    single = spark.createDataFrame([(1, 1, .5), (1, 0, .4)], "label int, pred int, score double")
    m = metrics.classification_metrics(single).first()
    assert m["roc_auc"] is None and m["recall"] == 0.5


def test_small_slices_are_left_out(spark):
    rows = [("big", i % 2, i % 2, i / 10) for i in range(10)] + [("small", 1, 1, .9)] * 9 + [(None, 1, 1, .9)] * 20
    df = spark.createDataFrame(rows, "g string, label int, pred int, score double")
    assert [r["slice"] for r in metrics.slice_metrics(df, ["g"]).collect()] == ["big"]


def test_student_t_p_value():
    # Tabulated two-sided critical values of Student's t.
    assert abs(profile.t_two_sided(2.228, 10) - 0.05) < 1e-4
    assert abs(profile.t_two_sided(12.706, 1) - 0.05) < 1e-4
    assert abs(profile.t_two_sided(1.96, 1e6) - 0.05) < 1e-4


def test_flatten():
    tree = {"model": {"learning_rate": .01, "params": {"n_estimators": 100}}}
    assert flatten_rows(tree) == [("model.learning_rate", "0.01"), ("model.params.n_estimators", "100")]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (18.5,), (25.0,), (30.0,), (100.0,), (100.5,), (None,)], "b double")
    got = [r[0] for r in df.select(R.bmi_category(F.col("b"))).collect()]
    assert got == [None, "Underweight", "Normal", "Overweight", "Obese", None, None]


def test_pressure_nulls_end_in_stage_two(spark):
    df = spark.createDataFrame([(110.0, 70.0), (125.0, 70.0), (150.0, 85.0), (150.0, 95.0), (None, None)], "h double, l double")
    got = [r[0] for r in df.select(R.pressure_category(F.col("h"), F.col("l"))).collect()]
    assert got == ["Normal", "Elevated", "Stage 1", "Stage 2", "Stage 2"]
