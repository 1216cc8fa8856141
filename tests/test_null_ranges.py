"""The large-data paths give what the simple ones give, also with NULL, NaN, date and text keys."""

import datetime

import pytest
from pyspark.sql import functions as F

from panelwright.operators import metrics
from panelwright.operators.prefix import running_sums
from panelwright.operators.temporal import rolling_features
from panelwright.runtime import materialize

D = datetime.date(2020, 1, 1)
ORDERS = {
    "double": [None, float("nan"), *[float(i) / 3 for i in range(38)]],
    "date": [None, *[D + datetime.timedelta(days=7 * i) for i in range(39)]],
    "string": [None, "", *[f"k{i:03d}" for i in range(38)]],
    "timestamp": [None, *[datetime.datetime(2020, 1, 1) + datetime.timedelta(hours=i) for i in range(39)]],
}


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("kind", sorted(ORDERS))
@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(spark, kind, descending):
    rows = [(g, o, i + 1) for g in ("x", None) for i, o in enumerate(ORDERS[kind])]
    hist = materialize(spark.createDataFrame(rows, f"g string, o {kind}, n int"))
    small, large = (running_sums(hist, "o", {"cum": "n"}, by=["g"], descending=descending, rows_per_range=k) for k in (1000, 6))
    assert rows_of(small.select("g", "o", "n", "cum")) == rows_of(large.select("g", "o", "n", "cum")) and small.count() == 80


@pytest.mark.parametrize("kind", ["date", "string"])
def test_hot_entity_windows(spark, kind):
    rows = [(e, o, float(i)) for e in ("a", None) for i, o in enumerate(ORDERS[kind][:33])]
    df = spark.createDataFrame(rows, f"entity string, period {kind}, v double")
    small, large = (rolling_features(df, "entity", "period", features=["v"], k=3, aggs=("mean", "max"), hot_rows=h) for h in (1000, 5))
    assert small.count() == large.count() == 66
    assert rows_of(small.select(sorted(small.columns))) == rows_of(large.select(sorted(small.columns)))


def test_calibration_counts_labelled_rows_only(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (None, 0.9), (1, None)], "label int, score double")
    assert metrics.calibration_error(df).first()["brier_score"] == metrics.brier(df).first()["brier_score"] == 0.25


def test_small_fractions_find_rows(spark):
    from panelwright.sources.readers import sample_rows

    n = sample_rows(spark.range(2_000_000), 5e-5, key=["id"]).count()
    assert 60 <= n <= 140
    assert sample_rows(spark.range(1000), 1.0, key=["id"]).agg(F.count("*")).first()[0] == 1000


@pytest.mark.parametrize("rows_per_range", [1000, 4])
def test_metrics_leave_out_incomplete_rows_everywhere(spark, rows_per_range):
    whole = [(g, i % 2, i / 20, int(i > 9)) for g in ("x", None) for i in range(20)]
    odd = [("x", 1, 0.05, None), ("x", 0, float("nan"), 1), (None, None, 0.5, 1), (None, 1, None, 0), ("y", 1, 0.5, 1)]
    schema = "g string, label int, score double, pred int"
    got, want = (metrics.classification_metrics(spark.createDataFrame(r, schema), by=["g"], min_rows=5, rows_per_range=rows_per_range)
                 for r in (whole + odd, whole))
    assert rows_of(got) == rows_of(want) and got.count() == 2
    assert {r["sample_size"] for r in got.collect()} == {20}


def test_rows_without_a_period_play_no_role(spark):
    from panelwright.operators.split import StratifiedTemporalSplitter

    rows = [(e, y, (e + y) % 3 == 0) for e in range(60) for y in range(2000 + e % 6, 2010)]
    tables = [spark.createDataFrame([(e, y, int(t)) for e, y, t in r], "id int, year int, target int")
              for r in (rows, rows + [(e, None, True) for e in range(70)])]
    splitter = StratifiedTemporalSplitter(n_splits=2, period="year", entity="id", label="target")
    assert splitter.cuts(tables[0]) == splitter.cuts(tables[1])


def test_outliers_with_an_empty_column(spark):
    from panelwright.operators.outliers import isolation_outliers

    df = spark.range(200).selectExpr("id", "double(id % 17) a", "cast(null as double) b")
    assert isolation_outliers(df, "id", ["a", "b"], trees=5).count() == 200


def test_a_missing_score_has_no_class(spark):
    from panelwright.functions.rules import confidence_band, threshold_label

    df = spark.createDataFrame([(None,), (0.5,), (0.9,)], "p double")
    assert [tuple(r) for r in df.select(threshold_label(F.col("p"), 0.6), confidence_band(F.col("p"))).collect()] == [
        (None, None), (0, "Low"), (1, "High")]
