"""Metric, threshold, slice and calibration queries over the scored panel and the scored documents."""

from pyspark.sql import functions as F

from panelwright.functions.rules import error_class
from panelwright.operators import metrics as M
from panelwright.operators import thresholds as T
from panelwright.plans.panel import scored_documents, scored_panel
from panelwright.plans.registry import DOCS, SCORED, query
from panelwright.sources.ledger import flatten_rows
from panelwright.sources.writers import json_records

_COUNTS = """count(*) FILTER (WHERE label = 0 AND pred = 0) AS true_negatives,
  count(*) FILTER (WHERE label = 0 AND pred = 1) AS false_positives,
  count(*) FILTER (WHERE label = 1 AND pred = 0) AS false_negatives,
  count(*) FILTER (WHERE label = 1 AND pred = 1) AS true_positives"""


def _rates(extra: str = "") -> str:
    tp, fp, fn, tn = "true_positives", "false_positives", "false_negatives", "true_negatives"

    def div(a, b):
        return f"coalesce(({a})::DOUBLE / nullif({b}, 0), 0.0)"

    return f"""{extra} {tp}, {fp}, {fn}, {tn}, {div(f'{tp}+{tn}', f'{tp}+{fp}+{fn}+{tn}')} AS accuracy,
  {div(tp, f'{tp}+{fp}')} AS precision, {div(tp, f'{tp}+{fn}')} AS recall, {div(f'2*{tp}', f'2*{tp}+{fp}+{fn}')} AS f1_score,
  {div(tn, f'{tn}+{fp}')} AS specificity, {div(tp, f'{tp}+{fn}')} AS sensitivity, {div(tn, f'{tn}+{fn}')} AS npv,
  {div(tp, f'{tp}+{fp}')} AS ppv"""


RATES = {c: 6 for c in ("accuracy", "precision", "recall", "f1_score", "specificity", "sensitivity", "npv", "ppv")}
_NNS = "CASE WHEN true_positives > 0 THEN (true_positives + false_positives)::DOUBLE / true_positives ELSE 'inf'::DOUBLE END"


def _curve(source: str, by: str = "") -> str:
    """Histogram of scores with inclusive descending class totals."""
    part = f"PARTITION BY {by} " if by else ""
    lead = f"{by}, " if by else ""
    return f"""hist AS (SELECT {lead}score, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg
    FROM {source} GROUP BY {lead}score),
  cum AS (SELECT *, sum(pos) OVER ({part}ORDER BY score DESC) AS tp, sum(neg) OVER ({part}ORDER BY score DESC) AS fp
    FROM hist)"""


_RANK = """sum(neg * (tp - pos / 2)) / nullif(sum(pos) * sum(neg), 0) AS roc_auc,
  sum(pos * tp / (tp + fp)) / nullif(sum(pos), 0) AS pr_auc"""


@query("confusion", f"""WITH {SCORED}, c AS (SELECT {_COUNTS} FROM scored)
SELECT {_rates()}, {_NNS} AS number_needed_to_screen FROM c""", RATES)
def confusion(spark, sf):
    return M.confusion(scored_panel(spark, sf)).withColumn(
        "number_needed_to_screen", F.col("number_needed_to_screen"))


@query("roc_auc", f"WITH {SCORED}, {_curve('scored')} SELECT {_RANK} FROM cum", {"roc_auc": 8, "pr_auc": 8})
def roc_auc(spark, sf):
    return M.ranking_metrics(scored_panel(spark, sf))


@query("avg_precision_documents", f"WITH {DOCS}, {_curve('docs')} SELECT pr_auc FROM (SELECT {_RANK} FROM cum)",
       {"pr_auc": 8})
def avg_precision_documents(spark, sf):
    return M.ranking_metrics(scored_documents(spark, sf)).select("pr_auc")


@query("roc_curve", f"""WITH {SCORED}, {_curve('scored')}
SELECT score AS threshold, fp / (SELECT sum(neg) FROM hist) AS fpr, tp / (SELECT sum(pos) FROM hist) AS tpr FROM cum
UNION ALL SELECT 'inf'::DOUBLE, 0.0, 0.0""", {"fpr": 8, "tpr": 8})
def roc_curve(spark, sf):
    return M.roc_curve(scored_panel(spark, sf))


@query("pr_curve", f"""WITH {SCORED}, {_curve('scored')}
SELECT score AS threshold, tp / (tp + fp) AS precision, tp / (SELECT sum(pos) FROM hist) AS recall FROM cum
UNION ALL SELECT NULL, 1.0, 0.0""", {"precision": 8, "recall": 8})
def pr_curve(spark, sf):
    return M.pr_curve(scored_panel(spark, sf))


_GRID = f"""WITH {SCORED}, hist AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1),
  grid AS (SELECT CAST(i AS INTEGER) AS step, CASE WHEN i = 99 THEN 0.9::DOUBLE
             ELSE 0.1::DOUBLE + i * (0.8::DOUBLE / 99.0::DOUBLE) END AS threshold FROM range(100) t(i)),
  g AS (SELECT step, threshold, CAST(coalesce(sum(pos) FILTER (WHERE score >= threshold), 0) AS BIGINT) AS tp,
               CAST(coalesce(sum(neg) FILTER (WHERE score >= threshold), 0) AS BIGINT) AS fp,
               CAST(coalesce(sum(pos) FILTER (WHERE score < threshold), 0) AS BIGINT) AS fn
        FROM grid, hist GROUP BY 1, 2),
  f AS (SELECT *, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0.0) AS precision,
               coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0.0) AS recall,
               coalesce((2 * tp)::DOUBLE / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM g)"""


@query("f1_curve", _GRID + " SELECT * FROM f", {"threshold": 8, "precision": 8, "recall": 8, "f1": 8})
def f1_curve(spark, sf):
    return T.f1_curve(scored_panel(spark, sf))


@query("threshold_f1", _GRID + """ SELECT coalesce(max(threshold), 0.5) AS threshold, coalesce(max(f1), 0.0) AS objective
FROM (SELECT threshold, f1 FROM f WHERE f1 > 0 ORDER BY f1 DESC, step LIMIT 1)""", {"threshold": 8, "objective": 8})
def threshold_f1(spark, sf):
    return T.f1_grid_threshold(scored_panel(spark, sf))


@query("threshold_pr", f"""WITH {SCORED}, {_curve('scored')}, pr AS (SELECT score, tp / (tp + fp) AS p,
  tp / (SELECT sum(pos) FROM hist) AS r FROM cum)
SELECT score AS threshold, 2 * p * r / (p + r + 1e-8::DOUBLE) AS objective FROM pr ORDER BY objective DESC, score LIMIT 1""",
       {"objective": 8})
def threshold_pr(spark, sf):
    return T.pr_threshold(scored_panel(spark, sf))


@query("threshold_youden", f"""WITH {SCORED}, {_curve('scored')}
SELECT score AS threshold, tp / (SELECT sum(pos) FROM hist) - fp / (SELECT sum(neg) FROM hist) AS objective
FROM cum ORDER BY objective DESC, score DESC LIMIT 1""", {"objective": 8})
def threshold_youden(spark, sf):
    return T.youden_threshold(scored_panel(spark, sf))


def _slices(source: str, dims: list[str], min_rows: int = 10) -> str:
    union = " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS slice, label, pred, score FROM {source} WHERE {d} IS NOT NULL"
        for d in dims)
    return f"""long AS ({union}),
  big AS (SELECT dimension, slice FROM long GROUP BY 1, 2 HAVING count(*) >= {min_rows}),
  kept AS (SELECT long.* FROM long JOIN big USING (dimension, slice)),
  {_curve('kept', 'dimension, slice')},
  r AS (SELECT dimension, slice, {_RANK} FROM cum GROUP BY 1, 2),
  c AS (SELECT dimension, slice, count(*) AS sample_size, avg(label) AS positive_rate, {_COUNTS} FROM kept GROUP BY 1, 2)"""


_SLICE_COLS = _rates("dimension, slice, sample_size, positive_rate, roc_auc, pr_auc,")
_SLICE_DIGITS = {**RATES, "positive_rate": 6, "roc_auc": 6, "pr_auc": 6}


@query("slice_metrics", f"WITH {SCORED}, {_slices('scored', ['segment', 'nation', 'period'])} "
       f"SELECT {_SLICE_COLS} FROM c JOIN r USING (dimension, slice)", _SLICE_DIGITS)
def slice_metrics(spark, sf):
    return M.slice_metrics(scored_panel(spark, sf), ["segment", "nation", "period"]).drop("number_needed_to_screen")


@query("slice_metrics_documents", f"WITH {DOCS}, {_slices('docs', ['lang', 'source'])} "
       f"SELECT {_SLICE_COLS} FROM c JOIN r USING (dimension, slice)", _SLICE_DIGITS)
def slice_metrics_documents(spark, sf):
    return M.slice_metrics(scored_documents(spark, sf), ["lang", "source"]).drop("number_needed_to_screen")


@query("top_slices", f"""WITH {SCORED}, top AS (SELECT nation FROM scored GROUP BY 1 ORDER BY count(*) DESC, nation LIMIT 5),
  t AS (SELECT scored.* FROM scored JOIN top USING (nation)), {_slices('t', ['nation'])}
SELECT {_SLICE_COLS} FROM c JOIN r USING (dimension, slice)""", _SLICE_DIGITS)
def top_slices(spark, sf):
    return M.top_slice_metrics(scored_panel(spark, sf), "nation", 5).drop("number_needed_to_screen")


@query("group_gap", f"""WITH {SCORED}, {_slices('scored', ['segment', 'nation', 'period'])}
SELECT dimension, max(roc_auc) - min(roc_auc) AS gap, count(*) AS n_slices FROM r GROUP BY 1""", {"gap": 6})
def group_gap(spark, sf):
    return M.group_gap(M.slice_metrics(scored_panel(spark, sf), ["segment", "nation", "period"]), "roc_auc")


_REPORT_ROW = """SELECT '{k}' AS class, coalesce({tp}::DOUBLE / nullif({tp} + {fp}, 0), 0.0) AS precision,
  coalesce({tp}::DOUBLE / nullif({tp} + {fn}, 0), 0.0) AS recall,
  coalesce((2 * {tp})::DOUBLE / nullif(2 * {tp} + {fp} + {fn}, 0), 0.0) AS f1, {tp} + {fn} AS support FROM c"""


@query("class_report", f"""WITH {DOCS}, c AS (SELECT {_COUNTS} FROM docs), k AS (
  {_REPORT_ROW.format(k=1, tp='true_positives', fp='false_positives', fn='false_negatives')} UNION ALL
  {_REPORT_ROW.format(k=0, tp='true_negatives', fp='false_negatives', fn='false_positives')})
SELECT * FROM k UNION ALL
SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM k UNION ALL
SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM k UNION ALL
SELECT 'accuracy', a, a, a, n FROM (SELECT (true_positives + true_negatives)::DOUBLE /
  (true_positives + true_negatives + false_positives + false_negatives) AS a,
  true_positives + true_negatives + false_positives + false_negatives AS n FROM c)""",
       {"precision": 6, "recall": 6, "f1": 6})
def class_report(spark, sf):
    return M.classification_report(scored_documents(spark, sf))


@query("brier_ece", f"""WITH {SCORED}, b AS (SELECT CASE WHEN score > 0 THEN ceil(score * 10) END AS bin, count(*) AS n,
  sum(score) AS conf, sum(label) AS pos, sum((score - label) * (score - label)) AS sq FROM scored GROUP BY 1)
SELECT sum(sq) / sum(n) AS brier_score, coalesce(sum(abs(conf - pos)) FILTER (WHERE bin IS NOT NULL) / sum(n), 0.0)
  AS expected_calibration_error FROM b""", {"brier_score": 8, "expected_calibration_error": 8})
def brier_ece(spark, sf):
    return M.calibration_error(scored_panel(spark, sf))


@query("brier_documents", f"WITH {DOCS} SELECT avg((score - label) * (score - label)) AS brier_score FROM docs",
       {"brier_score": 8})
def brier_documents(spark, sf):
    return M.brier(scored_documents(spark, sf))


@query("calibration_curve", f"""WITH {SCORED} SELECT CAST(greatest(ceil(score * 10), 1) AS INTEGER) AS bin, count(*) AS n,
  avg(score) AS mean_predicted, avg(label) AS fraction_positive FROM scored GROUP BY 1""",
       {"mean_predicted": 6, "fraction_positive": 6})
def calibration_curve(spark, sf):
    return M.calibration_curve(scored_panel(spark, sf))


@query("error_classes", f"""WITH {SCORED} SELECT error_class, count(*) AS n,
  count(*)::DOUBLE / (SELECT count(*) FROM scored) AS share FROM (SELECT CASE WHEN label = 1 AND pred = 1 THEN 'TP'
   WHEN label = 0 AND pred = 1 THEN 'FP' WHEN label = 1 THEN 'FN' ELSE 'TN' END AS error_class FROM scored)
GROUP BY 1""", {"share": 6})
def error_classes(spark, sf):
    from panelwright.operators.profile import value_counts
    s = scored_panel(spark, sf).select(error_class(F.col("label"), F.col("pred")).alias("error_class"))
    return value_counts(s, "error_class")


@query("error_contrast", f"""WITH {SCORED}, e AS (SELECT *, CASE WHEN label = 1 AND pred = 1 THEN 'TP'
   WHEN label = 0 AND pred = 1 THEN 'FP' WHEN label = 1 THEN 'FN' ELSE 'TN' END AS k FROM scored),
 l AS (SELECT k, 'n_orders' AS feature, n_orders::DOUBLE AS v FROM e UNION ALL SELECT k, 'avg_amt', avg_amt FROM e
       UNION ALL SELECT k, 'acctbal', acctbal FROM e),
 m AS (SELECT feature, k, avg(v) AS mean FROM l GROUP BY 1, 2)
SELECT x.k || ' vs ' || y.k AS pair, x.feature, x.mean AS mean_error, y.mean AS mean_correct,
       x.mean - y.mean AS difference
FROM m x JOIN m y ON x.feature = y.feature AND ((x.k = 'FP' AND y.k = 'TN') OR (x.k = 'FN' AND y.k = 'TP'))""",
       {"mean_error": 4, "mean_correct": 4, "difference": 4})
def error_contrast(spark, sf):
    s = scored_panel(spark, sf).withColumn("error_class", error_class(F.col("label"), F.col("pred")))
    return M.error_contrast(s, ["n_orders", "avg_amt", "acctbal"])


# Three scores for the same rows stand for three models; the period plays the fold.
_MODELS = SCORED + """, models AS (
  SELECT 'by_amount' AS model, period, label, score, pred FROM scored
  UNION ALL SELECT 'by_count', period, label, s, CAST(s >= 0.5 AS INTEGER) FROM (
    SELECT period, label, round(n_orders / 8.0::DOUBLE, 4) AS s FROM scored)
  UNION ALL SELECT 'by_balance', period, label, s, CAST(s >= 0.5 AS INTEGER) FROM (
    SELECT period, label, round(acctbal / 10000.0::DOUBLE, 4) AS s FROM scored))"""


def scored_models(spark, sf):
    s = scored_panel(spark, sf)
    alternatives = F.array(
        F.struct(F.lit("by_amount").alias("model"), F.col("score").alias("score")),
        F.struct(F.lit("by_count").alias("model"), F.round(F.col("n_orders") / 8.0, 4).alias("score")),
        F.struct(F.lit("by_balance").alias("model"), F.round(F.col("acctbal") / 10000.0, 4).alias("score")))
    return s.select("period", "label", F.inline(alternatives)).withColumn(
        "pred", (F.col("score") >= 0.5).cast("int"))


_COMPARE = f"""WITH {_MODELS}, {_curve('models', 'model')}, r AS (SELECT model, {_RANK} FROM cum GROUP BY 1),
  c AS (SELECT model, count(*) AS sample_size, avg(label) AS positive_rate, {_COUNTS} FROM models GROUP BY 1),
  t AS (SELECT {_rates('model, sample_size, positive_rate, roc_auc, pr_auc,')} FROM c JOIN r USING (model))"""


@query("model_compare", _COMPARE + " SELECT * FROM t ORDER BY roc_auc DESC", _SLICE_DIGITS)
def model_compare(spark, sf):
    return M.compare_models(scored_models(spark, sf)).drop("number_needed_to_screen")


@query("best_model", _COMPARE + " SELECT model, roc_auc FROM t ORDER BY roc_auc DESC, model LIMIT 1", {"roc_auc": 6})
def best_model(spark, sf):
    return M.best_model(M.compare_models(scored_models(spark, sf)))


@query("metric_differences", _COMPARE + """, l AS (SELECT model, 'roc_auc' AS metric, roc_auc AS v FROM t
  UNION ALL SELECT model, 'f1_score', f1_score FROM t)
SELECT a.metric, a.model AS model_a, b.model AS model_b, abs(a.v - b.v) AS difference,
  abs(a.v - b.v) > CASE WHEN a.metric LIKE '%auc%' THEN 0.01 ELSE 0.05 END AS significant, CAST(NULL AS DOUBLE) AS p_value
FROM l a JOIN l b ON a.metric = b.metric AND a.model < b.model""", {"difference": 6})
def metric_differences(spark, sf):
    return M.metric_differences(M.compare_models(scored_models(spark, sf)), ["roc_auc", "f1_score"])


@query("fold_summary", f"""WITH {SCORED}, {_curve('scored', 'period')}, r AS (SELECT period, {_RANK} FROM cum GROUP BY 1),
  c AS (SELECT period, {_COUNTS} FROM scored GROUP BY 1), t AS (SELECT {_rates('period, roc_auc, pr_auc,')} FROM c JOIN r USING (period))
SELECT 'roc_auc' AS metric, avg(roc_auc) AS mean, stddev_pop(roc_auc) AS std FROM t
UNION ALL SELECT 'pr_auc', avg(pr_auc), stddev_pop(pr_auc) FROM t
UNION ALL SELECT 'f1_score', avg(f1_score), stddev_pop(f1_score) FROM t""", {"mean": 6, "std": 6})
def fold_summary(spark, sf):
    folds = M.classification_metrics(scored_panel(spark, sf), by=["period"])
    return M.fold_summary(folds, ["roc_auc", "pr_auc", "f1_score"])


@query("ledger_flatten", f"""WITH {SCORED}, c AS (SELECT segment, {_COUNTS} FROM scored GROUP BY 1)
SELECT 'slices.' || segment || '.' || k AS key, CAST(v AS VARCHAR) AS value FROM c, LATERAL (VALUES
  ('counts.tp', true_positives), ('counts.fp', false_positives), ('counts.fn', false_negatives),
  ('counts.tn', true_negatives)) t(k, v)""")
def ledger_flatten(spark, sf):
    by_segment = M.confusion(scored_panel(spark, sf), by=["segment"]).collect()        # one row per segment
    nested = {"slices": {r["segment"]: {"counts": {
        "tp": r["true_positives"], "fp": r["false_positives"], "fn": r["false_negatives"],
        "tn": r["true_negatives"]}} for r in by_segment}}
    return spark.createDataFrame(flatten_rows(nested), "key string, value string")


@query("json_records", f"""WITH {SCORED}, c AS (SELECT segment, count(*) AS n, {_COUNTS} FROM scored GROUP BY 1)
SELECT '{{"segment":"' || segment || '","n":' || n || ',"tp":' || true_positives || ',"fp":' || false_positives
  || '}}' AS record FROM c""")
def json_records_query(spark, sf):
    c = M.confusion(scored_panel(spark, sf), by=["segment"])
    total = F.col("true_positives") + F.col("false_positives") + F.col("false_negatives") + F.col("true_negatives")
    return json_records(c.select("segment", total.alias("n"), F.col("true_positives").alias("tp"),
                                 F.col("false_positives").alias("fp")), "record")
