"""Profiling, outlier and labelling queries."""

from pyspark.sql import functions as F

from panelwright.operators import labelling
from panelwright.operators import profile as P
from panelwright.plans.panel import order_panel
from panelwright.plans.registry import PANEL, query, table
from panelwright.runtime import materialize

LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _each(template: str, cols=tuple(LI), **values) -> str:
    return " UNION ALL ".join(template.format(c=c, **values) for c in cols)


@query("describe", _each("""SELECT '{c}' AS feature, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
  min({c}) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75,
  max({c}) AS max FROM lineitem"""),
       {c: 4 for c in ("mean", "std", "min", "q25", "q50", "q75", "max")})
def describe(spark, sf):
    return P.describe(table(spark, sf, "lineitem").select(*LI))


@query("describe_by_label", f"WITH {PANEL} " + _each("""SELECT label, '{c}' AS feature, count({c}) AS count,
  avg({c}) AS mean, stddev_samp({c}) AS std, quantile_cont({c}::DOUBLE, 0.5) AS median FROM panel GROUP BY 1""",
  ("n_orders", "avg_amt", "acctbal")), {"mean": 4, "std": 4, "median": 4})
def describe_by_label(spark, sf):
    return P.describe_by(order_panel(spark, sf), "label", ["n_orders", "avg_amt", "acctbal"])


@query("five_number", f"WITH {PANEL} " + _each("""SELECT label, '{c}' AS feature, min({c})::DOUBLE AS min,
  quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.5) AS median,
  quantile_cont({c}::DOUBLE, 0.75) AS q75, max({c})::DOUBLE AS max FROM panel GROUP BY 1""", ("n_orders", "amt")),
       {c: 4 for c in ("min", "q25", "median", "q75", "max")})
def five_number(spark, sf):
    return P.five_number(order_panel(spark, sf), "label", ["n_orders", "amt"])


@query("value_counts", """SELECT p_brand, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM part) AS share
FROM part GROUP BY 1""", {"share": 6})
def value_counts(spark, sf):
    return P.value_counts(table(spark, sf, "part"), "p_brand")


@query("distinct_counts", _each("SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct FROM lineitem",
                                ("l_returnflag", "l_suppkey", "l_partkey", "l_orderkey")))
def distinct_counts(spark, sf):
    return P.distinct_counts(table(spark, sf, "lineitem"), ["l_returnflag", "l_suppkey", "l_partkey", "l_orderkey"])


@query("group_label_stats", f"WITH {PANEL} SELECT nation, count(label) AS count, avg(label) AS mean FROM panel GROUP BY 1",
       {"mean": 6})
def group_label_stats(spark, sf):
    return P.group_label_stats(order_panel(spark, sf), "nation")


@query("label_crosstab", f"""WITH {PANEL}, c AS (SELECT segment, count(*) FILTER (WHERE label = 0) AS negative,
  count(*) FILTER (WHERE label = 1) AS positive, count(*) AS total FROM panel GROUP BY 1)
SELECT *, positive::DOUBLE / total AS positive_rate, negative::DOUBLE / total AS negative_share,
  positive::DOUBLE / total AS positive_share FROM c""",
       {"positive_rate": 6, "negative_share": 6, "positive_share": 6})
def label_crosstab(spark, sf):
    return P.label_crosstab(order_panel(spark, sf), "segment")


@query("crosstab_pivot", """WITH c AS (SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'O') AS "O",
  count(*) FILTER (WHERE l_linestatus = 'F') AS "F" FROM lineitem GROUP BY 1)
SELECT *, "O"::DOUBLE / ("O" + "F") AS "O_share", "F"::DOUBLE / ("O" + "F") AS "F_share" FROM c""",
       {"O_share": 6, "F_share": 6})
def crosstab_pivot(spark, sf):
    return P.crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", ["O", "F"])


@query("period_trend", f"""WITH {PANEL} SELECT period, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives,
  avg(label) AS rate, avg(acctbal) AS mean_acctbal, avg(avg_amt) AS mean_avg_amt FROM panel GROUP BY 1""",
       {"rate": 6, "mean_acctbal": 3, "mean_avg_amt": 3})
def period_trend(spark, sf):
    return P.period_trend(order_panel(spark, sf), "period", "label", ["acctbal", "avg_amt"])


@query("column_summary", """SELECT min(l_extendedprice) AS min, max(l_extendedprice) AS max, avg(l_extendedprice) AS mean,
  stddev_samp(l_extendedprice) AS std, quantile_cont(l_extendedprice, 0.5) AS median FROM lineitem""",
       {c: 3 for c in ("min", "max", "mean", "std", "median")})
def column_summary(spark, sf):
    return P.column_summary(table(spark, sf, "lineitem"), "l_extendedprice")


_PAIRS = [(a, b) for i, a in enumerate(LI) for b in LI[i + 1:]]
_PAIR_SQL = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM lineitem" for a, b in _PAIRS)
_PANEL_COLS = ["n_orders", "amt", "avg_amt", "max_amt", "acctbal"]
_PANEL_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM panel"
    for i, a in enumerate(_PANEL_COLS) for b in _PANEL_COLS[i + 1:])


@query("corr_pairs", _PAIR_SQL, {"r": 6})
def corr_pairs(spark, sf):
    return P.correlation_pairs(table(spark, sf, "lineitem"), LI)


@query("corr_matrix", f"""WITH {PANEL}, p AS ({_PANEL_PAIRS}) SELECT a, b, r FROM p UNION ALL SELECT b, a, r FROM p
UNION ALL SELECT f, f, 1.0 FROM (VALUES {', '.join(f"('{c}')" for c in _PANEL_COLS)}) t(f)""", {"r": 6})
def corr_matrix(spark, sf):
    return P.correlation_matrix(order_panel(spark, sf), _PANEL_COLS)


@query("high_correlations", f"WITH {PANEL}, p AS ({_PANEL_PAIRS}) SELECT * FROM p WHERE abs(r) > 0.7", {"r": 6})
def high_correlations(spark, sf):
    return P.high_correlations(order_panel(spark, sf), _PANEL_COLS, 0.7)


@query("label_corr_rank", f"WITH {PANEL}, c AS (" + _each("SELECT '{c}' AS feature, corr({c}, label) AS r FROM panel",
       _PANEL_COLS) + ") SELECT * FROM c ORDER BY abs(r) DESC, feature LIMIT 3", {"r": 6})
def label_corr_rank(spark, sf):
    return P.label_correlations(order_panel(spark, sf), _PANEL_COLS, top=3)


_MISS = ["period", "avg_amt", "acctbal", "segment"]


@query("missing_profile", f"WITH {PANEL}, c AS (" + _each("""SELECT '{c}' AS feature, count(*) - count({c}) AS n_missing,
  (count(*) - count({c})) * 100.0::DOUBLE / count(*) AS percent FROM panel""", _MISS)
       + ") SELECT * FROM c WHERE n_missing > 0", {"percent": 6})
def missing_profile(spark, sf):
    return P.missing_profile(order_panel(spark, sf), _MISS)


@query("completeness", f"""WITH {PANEL} SELECT (count(period) + count(avg_amt) + count(acctbal) + count(segment)) * 100.0::DOUBLE
  / (4 * count(*)) AS completeness FROM panel""", {"completeness": 6})
def completeness(spark, sf):
    return P.completeness(order_panel(spark, sf).select(*_MISS))


_FENCE = """SELECT '{c}' AS feature, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t}"""


def _fences(t, cols):
    return (f"f AS (SELECT feature, q1, q3, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM ("
            + _each(_FENCE, cols, t=t) + ")), v AS (" + _each("SELECT '{c}' AS feature, {c} AS v FROM {t}", cols, t=t) + ")")


_OUT = """SELECT f.*, count(*) FILTER (WHERE v < low OR v > high) AS n_outliers,
  count(*) FILTER (WHERE v < low OR v > high) * 100.0::DOUBLE / count(*) AS percent FROM f JOIN v USING (feature) GROUP BY ALL"""


@query("iqr_outliers", f"WITH {_fences('lineitem', LI)} {_OUT}",
       {"q1": 4, "q3": 4, "low": 4, "high": 4, "percent": 6})
def iqr_outliers(spark, sf):
    return P.iqr_outliers(table(spark, sf, "lineitem"), LI)


_EV = ["value"]


@query("iqr_outliers_events", f"WITH {_fences('events', _EV)} {_OUT}",
       {"q1": 4, "q3": 4, "low": 4, "high": 4, "percent": 6})
def iqr_outliers_events(spark, sf):
    return P.iqr_outliers(table(spark, sf, "events"), _EV)


@query("outlier_rows", f"WITH {_fences('events', _EV)} SELECT event_id, value FROM events, f WHERE value < low OR value > high",
       {"value": 2})
def outlier_rows(spark, sf):
    return P.outlier_rows(table(spark, sf, "events").select("event_id", "value"), "value")


@query("outlier_label_stats", f"""WITH {PANEL}, {_fences('panel', ['amt'])}
SELECT CAST(amt < low OR amt > high AS INTEGER) AS is_outlier, count(label) AS count, CAST(sum(label) AS BIGINT) AS sum,
  avg(label) AS mean FROM panel, f GROUP BY 1""", {"mean": 6})
def outlier_label_stats(spark, sf):
    p = materialize(order_panel(spark, sf), "panel")
    f = P.iqr_fences(p, ["amt"]).first()
    flagged = p.withColumn("is_outlier", ((F.col("amt") < f["low"]) | (F.col("amt") > f["high"])).cast("int"))
    return P.outlier_label_stats(flagged, "is_outlier")


@query("mean_outlier_rate", f"WITH {_fences('lineitem', LI)}, o AS ({_OUT}) SELECT avg(percent) / 100 AS mean_rate FROM o",
       {"mean_rate": 8})
def mean_outlier_rate(spark, sf):
    return P.mean_outlier_rate(P.iqr_outliers(table(spark, sf, "lineitem"), LI))


@query("zscore_outliers", f"""WITH {PANEL}, s AS (SELECT avg(amt) AS m1, stddev_pop(amt) AS s1, avg(acctbal) AS m2,
  stddev_pop(acctbal) AS s2, avg(n_orders) AS m3, stddev_pop(n_orders) AS s3 FROM panel),
 z AS (SELECT entity, period, greatest(abs(amt - m1) / s1, abs(acctbal - m2) / s2, abs(n_orders - m3) / s3) AS max_z FROM panel, s)
SELECT *, CAST(max_z > 2.5 AS INTEGER) AS is_outlier FROM z""", {"max_z": 5})
def zscore_outliers(spark, sf):
    p = order_panel(spark, sf)
    return P.zscore_outliers(p, ["amt", "acctbal", "n_orders"], 2.5).select("entity", "period", "max_z", "is_outlier")


@query("ttest_effect", f"""WITH {PANEL}, s AS (""" + _each("""SELECT '{c}' AS feature,
  count({c}) FILTER (WHERE label = 0) AS n0, count({c}) FILTER (WHERE label = 1) AS n1,
  avg({c}) FILTER (WHERE label = 0) AS m0, avg({c}) FILTER (WHERE label = 1) AS m1,
  var_samp({c}) FILTER (WHERE label = 0) AS v0, var_samp({c}) FILTER (WHERE label = 1) AS v1 FROM panel""", _PANEL_COLS) + """)
SELECT feature, (m1 - m0) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0 / n0::DOUBLE + 1.0 / n1::DOUBLE)) AS t,
  (m1 - m0) / sqrt((v0 + v1) / 2) AS effect, n0 + n1 - 2 AS dof FROM s""", {"t": 5, "effect": 6})
def ttest_effect(spark, sf):
    return P.two_sample_tests(order_panel(spark, sf), _PANEL_COLS).drop("p_value")


@query("ttest_p_values")
def ttest_p_values(spark, sf):
    return P.two_sample_tests(order_panel(spark, sf), _PANEL_COLS)


@query("percentile_threshold", f"WITH {PANEL} SELECT quantile_cont(amt, 0.93) AS threshold FROM panel", {"threshold": 3})
def percentile_threshold(spark, sf):
    return P.percentile_threshold(order_panel(spark, sf), "amt", 0.93)


@query("histogram", f"""WITH {PANEL}, b AS (SELECT min(acctbal) AS lo0, max(acctbal) AS hi0 FROM panel)
SELECT label, CAST(least(floor((acctbal - lo0) / ((hi0 - lo0) / 30)), 29) AS INTEGER) AS bin, count(*) AS n,
  min(lo0) + CAST(least(floor((acctbal - lo0) / ((hi0 - lo0) / 30)), 29) AS INTEGER) * ((min(hi0) - min(lo0)) / 30) AS lo,
  min(lo0) + (CAST(least(floor((acctbal - lo0) / ((hi0 - lo0) / 30)), 29) AS INTEGER) + 1) * ((min(hi0) - min(lo0)) / 30) AS hi
FROM panel, b GROUP BY 1, 2""", {"lo": 3, "hi": 3})
def histogram(spark, sf):
    return P.histogram(order_panel(spark, sf), "acctbal", 30, "label")


@query("class_balance", f"""WITH {PANEL}, c AS (SELECT count(*) FILTER (WHERE label = 0) AS negatives,
  count(*) FILTER (WHERE label = 1) AS positives FROM panel)
SELECT *, negatives::DOUBLE / nullif(positives, 0) AS ratio, CASE WHEN negatives::DOUBLE / nullif(positives, 0) > 10 THEN 'Severe'
  WHEN negatives::DOUBLE / nullif(positives, 0) > 3 THEN 'Moderate' ELSE 'Mild' END AS severity FROM c""", {"ratio": 6})
def class_balance(spark, sf):
    return P.class_balance(order_panel(spark, sf))


@query("interaction_correlation", f"WITH {PANEL} SELECT corr(n_orders * acctbal, label) AS r FROM panel", {"r": 6})
def interaction_correlation(spark, sf):
    return P.interaction_correlation(order_panel(spark, sf), "n_orders", "acctbal")


@query("dataset_summary", f"""WITH {PANEL}, p AS (SELECT entity, period, avg_amt, segment, label FROM panel)
SELECT 'records' AS item, CAST(count(*) AS VARCHAR) AS value FROM p
UNION ALL SELECT 'prevalence', format('{{:.6f}}', avg(label)) FROM p
UNION ALL SELECT 'columns', 'entity,period,avg_amt,segment,label'
UNION ALL SELECT 'entities', CAST(count(DISTINCT entity) AS VARCHAR) FROM p
UNION ALL SELECT DISTINCT 'period', CAST(period AS VARCHAR) FROM p
UNION ALL SELECT 'nulls.entity', CAST(count(*) - count(entity) AS VARCHAR) FROM p
UNION ALL SELECT 'nulls.period', CAST(count(*) - count(period) AS VARCHAR) FROM p
UNION ALL SELECT 'nulls.avg_amt', CAST(count(*) - count(avg_amt) AS VARCHAR) FROM p
UNION ALL SELECT 'nulls.segment', CAST(count(*) - count(segment) AS VARCHAR) FROM p
UNION ALL SELECT 'nulls.label', CAST(count(*) - count(label) AS VARCHAR) FROM p""")
def dataset_summary(spark, sf):
    p = order_panel(spark, sf).select("entity", "period", "avg_amt", "segment", "label")
    return P.dataset_summary(p, "entity", "period", "label")


@query("top_categories", """SELECT l_shipdate AS day, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, day LIMIT 5""")
def top_categories(spark, sf):
    from panelwright.operators.metrics import top_categories as top
    return top(table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("day")), "day", 5)


@query("label_top_share", f"""WITH {PANEL}, r AS (SELECT entity, period, row_number() OVER
  (ORDER BY n_orders DESC, entity, period) AS rn FROM panel)
SELECT entity, period, CAST(rn <= floor((SELECT count(*) FROM panel) * 0.07::DOUBLE) AS INTEGER) AS target FROM r""")
def label_top_share(spark, sf):
    p = materialize(order_panel(spark, sf), "panel")          # read several times
    return labelling.top_share(p, "n_orders", 0.07, ["entity", "period"]).select("entity", "period", "target")


@query("label_top_share_by_group", f"""WITH {PANEL}, r AS (SELECT entity, period, row_number() OVER
  (PARTITION BY period ORDER BY amt DESC, entity) AS rn, count(*) OVER (PARTITION BY period) AS n FROM panel)
SELECT entity, period, CAST(rn <= floor(n * 0.1::DOUBLE) AS INTEGER) AS target FROM r""")
def label_top_share_by_group(spark, sf):
    p = materialize(order_panel(spark, sf), "panel")
    return labelling.top_share_by_group(p, "amt", 0.1, "entity", "period").select("entity", "period", "target")
