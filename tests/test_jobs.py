"""Training, artifacts, scoring, streaming and source round trips."""

import json

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import functions as F

from panelwright.functions import rules as R
from panelwright.ml import models, stages
from panelwright.operators import resample
from panelwright.operators.quality import Range
from panelwright.plans import training
from panelwright.plans.panel import order_panel
from panelwright.plans.scoring import answer, derive_request_columns, model_scorer
from panelwright.runtime import materialize, new_path
from panelwright.sources import artifacts as art
from panelwright.sources import readers, writers
from panelwright.sources.ledger import RunLedger
from panelwright.streaming import scoring as S

CONFIG = {
    "feature_engineering": {"rolling_window_years": 2, "temporal_features": ["mean"], "features": ["bmi", "glucose"]},
    "model": {"algorithm": "lightgbm", "lightgbm": {"n_estimators": 3, "max_depth": 2, "num_leaves": 31, "learning_rate": 0.1}},
    "imbalance": {"method": "smote", "smote": {"sampling_strategy": 0.5, "k_neighbors": 2}},
}


@pytest.fixture(scope="module")
def trained(spark, panel):
    return training.train_model(panel, _numbered(CONFIG), training.Columns())


def _numbered(config):
    return {**config, "cross_validation": {"n_splits": 1, "group_disjoint": False}}


def test_training_leaves_a_complete_record(spark, trained):
    assert 0.0 < trained.threshold < 1.0
    assert {r["metric"] for r in trained.summary.collect()} == set(training.CV_METRICS)
    for r in trained.folds.collect():
        assert all(r[m] is None or 0.0 <= r[m] <= 1.0 for m in training.CV_METRICS)
    assert not {"patient_id", "year", "target"} & set(trained.features)
    assert "lab_abnormal_flag" in trained.features and "bmi_rolling_mean_2y" in trained.features


def test_save_load_score(spark, panel, trained):
    path = new_path(spark, "artifacts-test")
    art.save_artifacts(spark, path, art.Artifacts(trained.model, trained.threshold, trained.features, trained.inputs,
                                                  trained.algorithm, trained.config), trained.summary)
    loaded = art.load_artifacts(spark, path)
    assert (loaded.threshold, loaded.features, loaded.version) == (trained.threshold, trained.features, "lightgbm")
    keys = ["patient_id", "year"]
    a = answer(panel, model_scorer(loaded, keys), keys, loaded.threshold, loaded.version)
    b = models.with_probability(trained.model.transform(panel), "p").select(*keys, "p")
    joined = a.join(b, keys)
    assert joined.count() == 300
    ok = joined.where("confidence <> 'Error'")
    assert ok.count() > 0 and ok.where(F.abs(F.col("probability") - F.col("p")) > 1e-6).count() == 0
    info = {r["item"]: r["value"] for r in art.describe_model(spark, loaded).collect()}
    assert info["algorithm"] == "lightgbm" and info["n_features"] == str(len(trained.features))
    assert spark.read.parquet(f"{path}/category_maps/gender").count() == 2


def test_artifacts_need_only_the_model(spark, trained):
    path = new_path(spark, "bare")
    trained.model.write().save(f"{path}/model")
    assert art.load_artifacts(spark, path).threshold == 0.5
    with pytest.raises(Exception):
        art.load_artifacts(spark, new_path(spark, "nothing"))


def test_bad_rows_are_answered_with_error(spark, panel, trained):
    bad = panel.where("patient_id = 'P0001'").withColumn("age", F.lit(150))
    keys = ["patient_id", "year"]
    scorer = model_scorer(art.Artifacts(trained.model, inputs=trained.inputs), keys)
    for r in answer(bad, scorer, keys).collect():
        assert (r["probability"], r["prediction"], r["confidence"], r["model_version"]) == (0.0, 0, "Error", "error")


def test_alignment_fills_and_drops(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "id int, a double, extra string")
    aligner = stages.ColumnAligner(columns=["b", "a"], keep=["id"])
    assert aligner.report(df) == (["b"], ["extra"])
    assert aligner.transform(df).columns == ["id", "b", "a"]
    assert aligner.transform(df).first()["b"] == 0.0


@pytest.mark.parametrize("method", ["one_hot", "label_encoding", "target_encoding"])
def test_encoder_stage_round_trip(spark, panel, method):
    stage = stages.CategoricalEncoder(method=method)
    model = stage.fit(panel)
    path = new_path(spark, "encoder")
    model.write().save(path)
    again = stages.CategoricalEncoderModel.read().load(path)
    a, b = model.transform(panel), again.transform(panel)
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty()
    assert ("gender_M" in a.columns) == (method == "one_hot")


def test_training_rows_get_out_of_fold_values(spark, panel):
    model, encoded = stages.CategoricalEncoder(cv_folds=5).fit_transform(panel)
    full = model.transform(panel).select("smoking_status").distinct().count()
    assert full == 3 and encoded.select("smoking_status").distinct().count() == 15


@pytest.mark.parametrize("method,k", [("variance_threshold", 3), ("importance_threshold", 2), ("recursive_elimination", 4)])
def test_selector_stage(spark, panel, method, k):
    model = stages.FeatureSelector(method=method, max_features=k).fit(panel)
    assert len(model.get_feature_names_out()) == k
    out = model.transform(panel)
    assert {"patient_id", "year", "target", "gender"} <= set(out.columns)
    with pytest.raises(ValueError):
        stages.FeatureSelector(method="rfe").fit(panel)


def test_search_returns_ranked_trials(spark, panel):
    config = _numbered({**CONFIG, "imbalance": {}, "feature_engineering": {}, "hpo": {
        "n_trials": 2, "algorithms": ["logistic_regression"], "opt_metric": "roc_auc"}})
    trials = training.search(panel, config)
    values = [r["value"] for r in trials.collect()]
    assert len(values) == 2 and values == sorted(values, reverse=True)
    best = training.with_best(config, trials)
    assert best["model"]["algorithm"] == "logistic_regression"
    assert isinstance(best["model"]["logistic_regression"]["maxIter"], int)


def test_attributions_add_up(spark):
    df = spark.createDataFrame([(i, float(i % 10), float(i % 3), int(i % 10 > 4)) for i in range(200)], "id int, a double, b double, label int")
    vec = models.assemble(df, ["a", "b"])
    clf = models.make_classifier("random_forest", {"n_estimators": 10}).fit(vec)
    table = models.shapley_attributions(clf, df, ["a", "b"], ["id"], rows=20, background=10, permutations=4)
    got = {r["feature"]: r["mean_abs_attribution"] for r in table.collect()}
    assert got["a"] > 0.2 > got["b"]


def test_attributions_explain_every_row(spark):
    # One row in 600 is moved by b; the keys repeat.
    df = spark.createDataFrame([(i // 2, float(i % 7), 1.0 if i == 300 else 0.0, i % 2) for i in range(600)],
                               "id int, a double, b double, label int")
    data = models.assemble(df, ["a", "b"])
    clf = models.make_classifier("logistic_regression", {"maxIter": 20}).fit(data)
    table = {r["feature"]: r for r in models.shapley_attributions(clf, df, ["a", "b"], ["id"], permutations=2).collect()}
    assert {f: r["n_rows"] for f, r in table.items()} == {"a": 600, "b": 600}
    assert table["b"]["mean_abs_attribution"] > 0
    part = models.shapley_attributions(clf, df, ["a", "b"], ["id"], permutations=2, fraction=0.5).first()
    assert 200 < part["n_rows"] < 400


def test_one_hot_of_many_values(spark):
    rows = [(f"e{i}", 2018 + i % 3, f"v{i % 1500:04d}" if i % 10 else None, float(i % 7), int(i % 1500 < 700)) for i in range(3000)]
    df = spark.createDataFrame(rows, "patient_id string, year int, kind string, x double, target int")
    with pytest.raises(ValueError, match="vector output"):
        stages.CategoricalEncoder(method="one_hot").fit(df)
    few = stages.CategoricalEncoder(method="one_hot", one_hot_output="vector").fit(df.where("kind < 'v0003'"))
    assert few.transform(df).schema["kind_onehot"].dataType == VectorUDT()      # the caller's choice, whatever the number
    model = stages.CategoricalEncoder(method="one_hot", one_hot_output="vector").fit(df)
    path = new_path(spark, "encoder")
    model.save(path)
    new = df.unionByName(df.limit(1).withColumns({"kind": F.lit("unseen"), "patient_id": F.lit("new")}))
    out = {r["patient_id"]: r["kind_onehot"] for r in stages.CategoricalEncoderModel.load(path).transform(new).collect()}
    names = sorted({r[2] for r in rows} - {None})
    assert len(names) == 1350 and len(out) == 3001
    for e, _, kind, _, _ in rows:
        assert (out[e].size, list(out[e].indices)) == (1351, [1350 if kind is None else names.index(kind)])
    assert not len(out["new"].indices)
    ready = model.transform(df)
    features = models.model_columns(ready, ["patient_id", "year"], "target")
    assert features == ["x", "kind_onehot"]
    clf = models.make_classifier("logistic_regression", {"maxIter": 10}).fit(models.assemble(ready, features).withColumnRenamed("target", "label"))
    table = models.feature_importances(PipelineModel(stages=[model, clf]), features).collect()
    assert table[0]["feature"] == "kind_onehot"
    got = {r["feature"]: (r["mean_abs_attribution"], r["n_rows"]) for r in models.shapley_attributions(
        clf, ready, features, ["patient_id"], permutations=1).collect()}
    assert got["kind_onehot"][0] > got["x"][0] and got["x"][1] == 3000
    keyed = ready.where("x < 3 or target = 0").withColumn("id", F.xxhash64("patient_id"))
    mixed = resample.smote(keyed.select("id", "target", *features), features, "id", "target", 0.9, 3).where("is_synthetic = 1")
    for r in mixed.limit(50).collect():
        assert r["kind_onehot"].size == 1351 and abs(sum(r["kind_onehot"].toArray()) - 1.0) < 1e-9 and 0 <= r["x"] <= 6


def test_derived_request_columns(spark):
    df = spark.createDataFrame([(2023, 65.0, 28.3, None), (2023, 20.0, 17.0, "given")], "year int, age double, bmi double, bmi_category string")
    a, b = derive_request_columns(df).collect()
    assert (a["birth_year"], a["age_group"], a["bmi_category"]) == (1958.0, "61-75", "Overweight")
    assert (b["age_group"], b["bmi_category"]) == ("18-30", "given")


def test_nan_is_null_after_ingest(spark):
    from panelwright.operators import impute

    path = new_path(spark, "nan")
    df = spark.createDataFrame([(2020, 1.0, 0.5), (2020, 3.0, float("nan")), (2021, float("nan"), None)], "year int, `a.b` double, c double")
    df.write.parquet(path)
    want = [(1.0, 0.5), (3.0, None), (None, None)]
    for got in (readers.read_parquet(spark, path), readers.load_data(spark, path, period="year")):
        assert [(r["a.b"], r["c"]) for r in got.orderBy("year", F.col("`a.b`").asc_nulls_last()).collect()] == want
    loaded = readers.load_data(spark, path).withColumnRenamed("a.b", "a")
    assert impute.numeric_fills(loaded, ["a", "c"], "mean") == {"a": 2.0, "c": 0.5}
    body = '{"patient_id": "P1", "age": NaN, "bmi": 20.5}'
    text = spark.createDataFrame([(body,)], "body string")
    text.write.text(path + ".json")
    for got in (readers.read_requests(spark, path + ".json"), readers.parse_requests(text, "body")):
        assert [(r["age"], r["bmi"]) for r in got.collect()] == [(None, 20.5)]


def test_scorer_derives_request_columns(spark):
    class Model:
        def transform(self, df):
            p = F.when(F.col("age_group") == "61-75", F.col("birth_year") / 10000.0).otherwise(0.0)
            return df.withColumn("probability", array_to_vector(F.array(1.0 - p, p)))

    df = spark.createDataFrame([("P1", 2023, 65.0, 28.3)], "patient_id string, year int, age double, bmi double")
    scorer = model_scorer(art.Artifacts(Model(), inputs=["age", "birth_year", "age_group"]), ["patient_id", "year"])
    assert abs(scorer(df).first()["probability"] - 0.1958) < 1e-12


def test_stream_equals_batch_over_several_batches(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    source = new_path(spark, "stream-in")
    events.repartition(5).write.parquet(source)
    keep, rules = ["event_id"], [Range("value", 1, 150)]
    scorer = lambda d: d.withColumn("probability", F.round(R.logistic(F.col("value") / 50 - 1), 4))
    out = new_path(spark, "stream-out")
    S.score_stream(S.read_stream(spark, source, events.schema, files_per_batch=2), scorer, keep, f"{out}/s", f"{out}/r",
                   f"{out}/c", 0.5, "v", rules).awaitTermination()
    stream = spark.read.parquet(f"{out}/s")
    assert stream.select("batch").distinct().count() == 3
    batch = answer(events, scorer, keep, 0.5, "v", rules)
    cols = ["event_id", "probability", "prediction", "confidence", "model_version"]
    assert stream.select(cols).exceptAll(batch.select(cols)).isEmpty() and stream.count() == events.count()
    assert spark.read.parquet(f"{out}/r").count() == events.where("value < 1 or value > 150").count()


def test_json_requests(spark):
    path = new_path(spark, "requests")
    one = {"patient_id": "P1", "year": 2023, "age": 65.5, "gender": "M", "lab_abnormal_flag": True, "num_visits": 3}
    spark.createDataFrame([(json.dumps(one),), (json.dumps({**one, "patient_id": "P2"}),)], "value string").write.text(path)
    assert [r["patient_id"] for r in readers.read_requests(spark, path).orderBy("patient_id").collect()] == ["P1", "P2"]
    body = spark.createDataFrame([(1, json.dumps({"patients": [one, {**one, "patient_id": "P3"}]}))], "n int, body string")
    parsed = readers.parse_requests(body, "body", batch_field="patients")
    assert [(r["n"], r["patient_id"], r["age"]) for r in parsed.collect()] == [(1, "P1", 65.5), (1, "P3", 65.5)]


def test_partitioned_write_and_pruned_read(spark, sf):
    path = new_path(spark, "by-period")
    p = order_panel(spark, sf)
    writers.write_partitioned(p, path, ["period"])
    back = readers.read_parquet(spark, path)
    assert back.columns[-1] == "period" and back.count() == p.count()
    plan = back.where("period = 1998")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan


def test_ledger(spark):
    ledger = RunLedger(spark, new_path(spark, "ledger-test"), "run1")
    ledger.log_params({"model": {"depth": 3}})
    ledger.log_metrics({"auc": 0.9}, step=2)
    ledger.log_artifact("model", "/somewhere")
    got = {(r["kind"], r["key"], r["value"], r["step"]) for r in ledger.read().collect()}
    assert got == {("param", "model.depth", "3", None), ("metric", "auc", "0.9", 2), ("artifact", "model", "/somewhere", None)}


def test_csv_table_and_sampling(spark, sf):
    path = new_path(spark, "csv-table")
    writers.write_csv(spark.createDataFrame([("a", 1.5)], "feature string, v double"), path)
    assert spark.read.option("header", True).csv(path).first()["feature"] == "a"
    c = readers.read_parquet(spark, f"{sf}/customer.parquet")
    a = readers.sample_rows(c, 0.5, ["c_custkey"])
    assert sorted(r[0] for r in a.select("c_custkey").collect()) == sorted(
        r[0] for r in readers.sample_rows(c.repartition(7), 0.5, ["c_custkey"]).select("c_custkey").collect())
    assert readers.sample_n(c, 10, ["c_custkey"]).count() == 10


def test_training_job_leaves_all_tables(spark, sf):
    from panelwright.plans import jobs

    data, out = new_path(spark, "job-data"), new_path(spark, "job-out")
    jobs.prepare_panel(spark, sf, data, 0.3).collect()
    config = {"model": {"algorithm": "logistic_regression", "logistic_regression": {"maxIter": 3}},
              "cross_validation": {"n_splits": 1, "group_disjoint": False}, "explain": {"enabled": True},
              "hpo": {"enabled": True, "n_trials": 1, "algorithms": ["logistic_regression"], "opt_metric": "roc_auc"}}
    result = jobs.training_job(spark, data, out, config, training.Columns("entity", "period", "target"))
    assert spark.read.json(f"{out}/quality").count() > 5
    assert spark.read.option("header", True).csv(f"{out}/importances").count() == len(result.features)
    assert spark.read.option("header", True).csv(f"{out}/attributions").count() == len(result.features)
    assert spark.read.parquet(f"{out}/ledger").where("kind = 'metric'").count() == 13
    assert art.load_artifacts(spark, out).threshold == result.threshold


def test_attributions_along_whole_orders_equal_scored_rows(spark, monkeypatch):
    import random

    from panelwright.ml import paths

    rnd = random.Random(5)
    names = ["a", "b", "c", "e"]
    data = [(i // 2 if i else None, *(round(rnd.gauss(0, 1), 1) for _ in names)) for i in range(400)]
    data = [(*r, int(r[1] + r[2] * r[3] > rnd.gauss(0, 0.5))) for r in data]
    df = spark.createDataFrame(data, "id int, a double, b double, c double, e double, label int")
    ready = models.assemble(df, names)
    for kind, settings in (("random_forest", {"n_estimators": 5, "max_depth": 5}), ("gbt", {"n_estimators": 4, "max_depth": 3}), ("logistic_regression", {"maxIter": 10})):
        clf = models.make_classifier(kind, settings).fit(ready)
        made = []
        with monkeypatch.context() as m:
            m.setattr(models.paths, "attributed", lambda *a, f=paths.attributed: made.append(a) or f(*a))
            got = {r["feature"]: r for r in models.shapley_attributions(clf, df, names, ["id"], permutations=3, background=20).collect()}
            assert made                                                  # no combination goes through the plan
        with monkeypatch.context() as m:
            m.setattr(models.paths, "scorer_of", lambda _: None)
            want = {r["feature"]: r for r in models.shapley_attributions(clf, df, names, ["id"], permutations=3, background=20).collect()}
        assert set(got) == set(want) == set(names)
        for f in names:
            assert got[f]["n_rows"] == want[f]["n_rows"] == 400
            assert abs(got[f]["mean_abs_attribution"] - want[f]["mean_abs_attribution"]) < 1e-9
