"""Source and sink round trips, model training, scoring and streaming queries."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions import rules as R
from panelwright.ml import models, stages
from panelwright.operators import select
from panelwright.operators.quality import Allowed, Range
from panelwright.plans import jobs, training
from panelwright.plans.panel import order_panel, scored_panel
from panelwright.plans.registry import PANEL, query, table
from panelwright.plans.scoring import answer, model_scorer, row_wise
from panelwright.runtime import materialize, new_path
from panelwright.sources import artifacts as art
from panelwright.sources import readers, writers
from panelwright.sources.ledger import RunLedger
from panelwright.streaming import scoring as S

NUM = ["n_orders", "amt", "avg_amt", "max_amt", "acctbal"]
COLUMNS = training.Columns("entity", "period", "label")
# Small settings: these runs check the job end to end, not the quality of a model.
CONFIG = {
    "random_seed": 42,
    "feature_engineering": {"rolling_window_years": 2, "temporal_features": ["mean", "trend"], "features": ["n_orders", "amt"],
                            "bounded_entities": True, "categorical_encoding": {"method": "target_encoding", "cv_folds": 3},
                            "scaling": {"enabled": True, "method": "standard"}},
    "model": {"algorithm": "logistic_regression", "logistic_regression": {"maxIter": 5, "regParam": 0.01}},
    "cross_validation": {"n_splits": 2, "gap": 1, "group_disjoint": False},
    "imbalance": {"method": "class_weight"},
}


# ---- sources and sinks --------------------------------------------------------------------------

@query("partition_read_back", f"""WITH {PANEL} SELECT entity, n_orders, amt, segment, period FROM panel WHERE period = 1998""",
       {"amt": 2})
def partition_read_back(spark, sf):
    path = new_path(spark, "panel-by-period")
    writers.write_partitioned(order_panel(spark, sf).select("entity", "n_orders", "amt", "segment", "period"), path, ["period"])
    return readers.read_parquet(spark, path).where("period = 1998")


@query("csv_round_trip", "SELECT s_suppkey::DOUBLE AS s_suppkey, s_name, s_nationkey::DOUBLE AS s_nationkey, s_acctbal FROM supplier",
       {"s_acctbal": 2})
def csv_round_trip(spark, sf):
    source = table(spark, sf, "supplier")
    path = new_path(spark, "supplier") + ".csv"
    source.write.option("header", True).csv(path)
    return readers.load_data(spark, path, source.schema)


@query("sampled_scan")
def sampled_scan(spark, sf):
    li = readers.load_data(spark, f"{sf}/lineitem.parquet", sample_fraction=0.2, key=["l_orderkey", "l_linenumber"])
    return li.groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("sample_rows_exact")
def sample_rows_exact(spark, sf):
    return readers.sample_n(table(spark, sf, "customer"), 50, ["c_custkey"])


@query("json_requests", """SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS k_sum
FROM events GROUP BY 1""")
def json_requests(spark, sf):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    parsed = readers.parse_requests(table(spark, sf, "events").select("event_type", "props"), "props", schema)
    return parsed.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("k_sum"))


@query("ledger_metrics", f"""WITH {PANEL} SELECT 'metric' AS kind, 'rows.' || segment AS key, CAST(count(*) AS VARCHAR) AS value,
  CAST(1 AS BIGINT) AS step FROM panel GROUP BY segment""")
def ledger_metrics(spark, sf):
    counts = {r[0]: r[1] for r in order_panel(spark, sf).groupBy("segment").count().collect()}     # one row per segment
    ledger = RunLedger(spark, new_path(spark, "ledger"))
    ledger.log_metrics({"rows": counts}, step=1)
    return ledger.read().select("kind", "key", "value", "step")


@query("column_alignment", f"""WITH {PANEL} SELECT entity, period, acctbal, 0.0::DOUBLE AS not_there, amt FROM panel""",
       {"amt": 2, "acctbal": 2, "not_there": 1})
def column_alignment(spark, sf):
    return stages.ColumnAligner(columns=["acctbal", "not_there", "amt"], keep=["entity", "period"]).transform(order_panel(spark, sf))


# ---- scoring ------------------------------------------------------------------------------------

EVENT_RULES = [Range("value", 0.5, 200), Allowed("event_type", ("click", "view", "purchase", "signup")), Range("k", 5, None)]
_EVENTS = "e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"
_EVENT_OK = "(value >= 0.5 AND value <= 200 AND event_type <> 'error' AND k >= 5)"
_ANSWER = f"""WITH {_EVENTS}, s AS (SELECT event_id, {_EVENT_OK} AS ok,
  round(1.0 / (1.0 + exp(-((value - 60.0) / 40.0 + k / 100.0::DOUBLE))), 4) AS p FROM e)
SELECT event_id, CASE WHEN ok THEN p ELSE 0.0 END AS probability, CASE WHEN ok AND p >= 0.6 THEN 1 ELSE 0 END AS prediction,
  CASE WHEN NOT ok THEN 'Error' WHEN p < 0.2 OR p > 0.8 THEN 'High' WHEN p < 0.4 OR p > 0.6 THEN 'Medium' ELSE 'Low' END
  AS confidence, CASE WHEN ok THEN 'v1' ELSE 'error' END AS model_version FROM s"""


def event_requests(df):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return readers.parse_requests(df, "props", schema)


@row_wise
def event_scorer(df):
    """A fixed formula in the place of a trained model, so that the answers can be checked in SQL."""
    x = (F.col("value") - 60.0) / 40.0 + F.col("k") / 100.0
    return df.withColumn("probability", F.round(R.logistic(x), 4))


@query("score_batch", _ANSWER, {"probability": 4})
def score_batch(spark, sf):
    requests = event_requests(table(spark, sf, "events"))
    return answer(requests, event_scorer, ["event_id"], 0.6, "v1", EVENT_RULES).drop("timestamp")


@query("stream_scored", _ANSWER, {"probability": 4})
def stream_scored(spark, sf):
    source = f"{sf}/events.parquet"
    stream = event_requests(S.read_stream(spark, f"{source}*", spark.read.parquet(source).schema))
    out = new_path(spark, "stream-scored")
    S.score_stream(stream, event_scorer, ["event_id"], f"{out}/scored", f"{out}/rejected", f"{out}/checkpoint",
                   0.6, "v1", EVENT_RULES).awaitTermination()
    return spark.read.parquet(f"{out}/scored").drop("timestamp", "batch")


@query("stream_rejected", f"""WITH {_EVENTS} SELECT event_id, concat_ws('|', CASE WHEN value < 0.5 THEN 'value:min' END,
  CASE WHEN value > 200 THEN 'value:max' END, CASE WHEN event_type = 'error' THEN 'event_type:allowed' END,
  CASE WHEN k < 5 THEN 'k:min' END) AS violations FROM e WHERE NOT {_EVENT_OK}""")
def stream_rejected(spark, sf):
    source = f"{sf}/events.parquet"
    stream = event_requests(S.read_stream(spark, f"{source}*", spark.read.parquet(source).schema))
    out = new_path(spark, "stream-rejected")
    S.score_stream(stream, event_scorer, ["event_id"], f"{out}/scored", f"{out}/rejected", f"{out}/checkpoint",
                   0.6, "v1", EVENT_RULES).awaitTermination()
    return spark.read.parquet(f"{out}/rejected").select("event_id", F.concat_ws("|", "violations").alias("violations"))


@query("stream_window_counts", """WITH w AS (SELECT date_trunc('hour', ts) AS h, event_type, count(*) AS processed,
  count(*) FILTER (WHERE value > 200) AS errors FROM events GROUP BY 1, 2)
SELECT CAST(h AS TIMESTAMP) AS window_start, event_type, processed, errors FROM w
WHERE h + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_window_counts(spark, sf):
    source = f"{sf}/events.parquet"
    stream = S.read_stream(spark, f"{source}*", spark.read.parquet(source).schema)
    counters = S.health_counters(stream, "ts", F.col("value") > 200, "1 hour", "10 minutes", ["event_type"])
    out = new_path(spark, "stream-health")
    S.run_to_table(counters, f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_without_replays", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_without_replays(spark, sf):
    source = f"{sf}/events.parquet"
    schema = spark.read.parquet(source).schema
    # The same files read twice stand for a source that delivers every event again.
    twice = S.read_stream(spark, f"{source}*", schema).unionByName(S.read_stream(spark, f"{source}*", schema))
    once = S.drop_replays(twice.select("event_id", "event_type", "ts"), "ts", ["event_id"])
    out = new_path(spark, "stream-once")
    S.run_to_table(once, f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table").groupBy("event_type").agg(F.count("*").alias("n"))


# ---- jobs -------------------------------------------------------------------------------------

@query("prepare_panel", f"""WITH {PANEL}, n AS (SELECT count(*) AS n FROM panel), t AS (SELECT *,
  CASE WHEN n_orders <= 1 THEN 'one' WHEN n_orders <= 3 THEN 'few' ELSE 'many' END AS order_group FROM panel)
SELECT 'records' AS item, CAST(n AS VARCHAR) AS value FROM n
UNION ALL SELECT 'prevalence', format('{{:.6f}}', floor(n * 0.07::DOUBLE) / n) FROM n
UNION ALL SELECT 'columns', 'entity,n_orders,amt,avg_amt,max_amt,acctbal,segment,nation,order_group,target,period'
UNION ALL SELECT 'entities', CAST(count(DISTINCT entity) AS VARCHAR) FROM t
UNION ALL SELECT DISTINCT 'period', CAST(period AS VARCHAR) FROM t
""" + "".join(f"UNION ALL SELECT 'nulls.{c}', CAST(count(*) - count({c}) AS VARCHAR) FROM t " for c in (
    "entity", "n_orders", "amt", "avg_amt", "max_amt", "acctbal", "segment", "nation", "order_group", "period"))
       + "UNION ALL SELECT 'nulls.target', '0'")
def prepare_panel(spark, sf):
    return jobs.prepare_panel(spark, sf, new_path(spark, "prepared-panel"))


@query("analysis_job", f"""WITH {PANEL}, d AS (SELECT DISTINCT segment FROM panel), p AS (SELECT DISTINCT period FROM panel)
SELECT 'metrics' AS section, CAST(1 AS BIGINT) AS n UNION ALL SELECT 'slices', (SELECT count(*) FROM d) + (SELECT count(*) FROM p)
UNION ALL SELECT 'calibration_error', 1 UNION ALL SELECT 'error_contrast', 4""")
def analysis_job(spark, sf):
    scored = materialize(scored_panel(spark, sf), "scored")
    out = jobs.analysis_job(scored, ["segment", "period"], ["amt", "acctbal"], new_path(spark, "analysis"))
    return out.where(~F.col("section").isin("calibration", "error_classes")).groupBy("section").agg(F.count("*").alias("n"))


# ---- models -------------------------------------------------------------------------------------

def stored_panel(spark, sf):
    return materialize(order_panel(spark, sf), "panel")


@query("train_cross_validated")
def train_cross_validated(spark, sf):
    return training.train_model(stored_panel(spark, sf), CONFIG, COLUMNS).summary


@query("train_save_load_score")
def train_save_load_score(spark, sf):
    p = stored_panel(spark, sf)
    model, features = training.fit_model(p, CONFIG, COLUMNS)
    path = new_path(spark, "artifacts")
    inputs = [c for c in p.columns if c != "label"]
    art.save_artifacts(spark, path, art.Artifacts(model, 0.4, features, inputs, "logistic_regression", CONFIG))
    loaded = art.load_artifacts(spark, path)
    scorer = model_scorer(loaded, ["entity", "period"])
    return answer(p.drop("label"), scorer, ["entity", "period"], loaded.threshold, loaded.version,
                  [Range("amt", 2000, None)]).groupBy("confidence", "prediction").agg(F.count("*").alias("n"))


@query("evaluate_model")
def evaluate_model(spark, sf):
    p = stored_panel(spark, sf)
    model, _ = training.fit_model(p, CONFIG, COLUMNS)
    return training.evaluate(model, p, 0.4, "label")


@query("model_info")
def model_info(spark, sf):
    p = stored_panel(spark, sf)
    model, features = training.fit_model(p, CONFIG, COLUMNS)
    return art.describe_model(spark, art.Artifacts(model, 0.4, features, p.columns, "logistic_regression", CONFIG))


def _forest(spark, sf):
    config = {**CONFIG, "imbalance": {}, "model": {"algorithm": "random_forest", "random_forest": {"numTrees": 10, "maxDepth": 4}}}
    p = stored_panel(spark, sf)
    model, features = training.fit_model(p, config, COLUMNS)
    return p, model, features


@query("feature_importances")
def feature_importances(spark, sf):
    _, model, features = _forest(spark, sf)
    return models.feature_importances(model, features)


@query("attributions")
def attributions(spark, sf):
    p, model, features = _forest(spark, sf)
    ready = p
    for stage in model.stages[:-2]:
        ready = stage.transform(ready)
    return models.shapley_attributions(model.stages[-1], ready, features, ["entity", "period"], permutations=4)


@query("select_by_importance")
def select_by_importance(spark, sf):
    p = stored_panel(spark, sf).fillna(0.0, ["avg_amt"])
    names = select.importance_selection(p, NUM, "label", 3, trees=20)
    return spark.createDataFrame([(n,) for n in names], "feature string")


@query("select_by_elimination")
def select_by_elimination(spark, sf):
    p = stored_panel(spark, sf).fillna(0.0, ["avg_amt"])
    names = select.recursive_elimination(p, NUM, "label", 3, trees=10)
    return spark.createDataFrame([(n,) for n in names], "feature string")


@query("parameter_search")
def parameter_search(spark, sf):
    config = {**CONFIG, "imbalance": {}, "hpo": {"n_trials": 3, "algorithms": ["logistic_regression"], "opt_metric": "roc_auc"}}
    return training.search(stored_panel(spark, sf), config, COLUMNS)
