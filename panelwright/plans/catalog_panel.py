"""Panel, temporal, quality and derivation queries."""

from pyspark.sql import functions as F

from panelwright.functions import rules as R
from panelwright.functions.sql import register_sql_functions
from panelwright.operators import quality as Q
from panelwright.operators import temporal
from panelwright.plans.panel import order_panel, scored_panel
from panelwright.plans.registry import PANEL, SCORED, query, table
from panelwright.sources import readers

ROLLED = ["amt", "avg_amt", "n_orders"]


@query("panel_base", f"WITH {PANEL} SELECT * FROM panel", {"amt": 2, "avg_amt": 3, "max_amt": 2, "acctbal": 2})
def panel_base(spark, sf):
    return order_panel(spark, sf)


def _rolled(spark, sf, aggs, lag, features=tuple(ROLLED), k=3, min_periods=1):
    # The panel has one row per entity and year, so an entity is a handful of rows.
    df = order_panel(spark, sf).select("entity", "period", *features)
    out = temporal.rolling_features(df, "entity", "period", features, k, min_periods, aggs, lag,
                                    bounded_entities=True)
    return out.select("entity", "period", *temporal.feature_names(features, k, aggs, lag))


def _window_sql(agg, name, k=3, m=1, features=tuple(ROLLED)):
    cols = ", ".join(
        f"CAST(coalesce(CASE WHEN count({f}) OVER w >= {m} THEN {agg}({f}) OVER w END, 0) AS DOUBLE) "
        f"AS {f}_rolling_{name}_{k}y" for f in features)
    return (f"WITH {PANEL} SELECT entity, period, {cols} FROM panel WINDOW w AS "
            f"(PARTITION BY entity ORDER BY period ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)")


def _digits(name, k=3, features=tuple(ROLLED), d=3):
    return {f"{f}_rolling_{name}_{k}y": d for f in features}


@query("rolling_mean_3", _window_sql("avg", "mean"), _digits("mean"))
def rolling_mean(spark, sf):
    return _rolled(spark, sf, ["mean"], False)


@query("rolling_mean_2_min_periods_2", _window_sql("avg", "mean", 2, 2), _digits("mean", 2))
def rolling_mean_min_periods(spark, sf):
    return _rolled(spark, sf, ["mean"], False, k=2, min_periods=2)


@query("rolling_std_3", _window_sql("stddev_samp", "std"), _digits("std"))
def rolling_std(spark, sf):
    return _rolled(spark, sf, ["std"], False)


@query("rolling_min_3", _window_sql("min", "min"), _digits("min"))
def rolling_min(spark, sf):
    return _rolled(spark, sf, ["min"], False)


@query("rolling_max_3", _window_sql("max", "max"), _digits("max"))
def rolling_max(spark, sf):
    return _rolled(spark, sf, ["max"], False)


_TREND = f"""WITH {PANEL} SELECT entity, period, """ + ", ".join(
    f"coalesce(CASE WHEN count(*) OVER w >= 2 AND count({f}) OVER w = count(*) OVER w "
    f"THEN regr_slope({f}, period) OVER w END, 0.0) AS {f}_rolling_trend_3y" for f in ROLLED) + """
FROM panel WINDOW w AS (PARTITION BY entity ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""


@query("rolling_trend_3", _TREND, _digits("trend", d=2))
def rolling_trend(spark, sf):
    return _rolled(spark, sf, ["trend"], False)


_LAG = f"""WITH {PANEL} SELECT entity, period, """ + ", ".join(
    f"CAST(coalesce(lag({f}) OVER w, 0) AS DOUBLE) AS {f}_lag_1y" for f in ROLLED) + """
FROM panel WINDOW w AS (PARTITION BY entity ORDER BY period)"""


@query("lag_1", _LAG, {f"{f}_lag_1y": 3 for f in ROLLED})
def lag_one(spark, sf):
    return _rolled(spark, sf, [], True)


_ALL = [("avg", "mean"), ("stddev_samp", "std"), ("min", "min"), ("max", "max")]
_ROLL_ALL = f"""WITH {PANEL} SELECT entity, period, """ + ", ".join(
    [f"CAST(coalesce({a}({f}) OVER w, 0) AS DOUBLE) AS {f}_rolling_{n}_3y" for f in ROLLED for a, n in _ALL]
    + [f"coalesce(CASE WHEN count(*) OVER w >= 2 AND count({f}) OVER w = count(*) OVER w "
       f"THEN regr_slope({f}, period) OVER w END, 0.0) AS {f}_rolling_trend_3y" for f in ROLLED]
    + [f"CAST(coalesce(lag({f}) OVER w1, 0) AS DOUBLE) AS {f}_lag_1y" for f in ROLLED]) + """
FROM panel WINDOW w AS (PARTITION BY entity ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
w1 AS (PARTITION BY entity ORDER BY period)"""


@query("rolling_all", _ROLL_ALL, {c: 2 for c in temporal.feature_names(ROLLED, 3, temporal.AGGREGATIONS)})
def rolling_all(spark, sf):
    return _rolled(spark, sf, temporal.AGGREGATIONS, True)


@query("rolling_events", """SELECT user_id, event_id, avg(value) OVER w AS value_rolling_mean_3y,
  max(value) OVER w AS value_rolling_max_3y,
  CAST(coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS DOUBLE) AS value_lag_1y
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
       {"value_rolling_mean_3y": 4, "value_rolling_max_3y": 2, "value_lag_1y": 2})
def rolling_events(spark, sf):
    """Windows over raw rows: a user may have any number of them, so the sizes are checked."""
    e = table(spark, sf, "events").select("user_id", "event_id", "value")
    return temporal.rolling_features(e, "user_id", "event_id", ["value"], 3, 1, ["mean", "max"], True).drop("value")


@query("row_ordinal", f"""WITH {PANEL} SELECT entity, period,
  row_number() OVER (PARTITION BY entity ORDER BY period) - 1 AS ordinal,
  0.1 * (row_number() OVER (PARTITION BY entity ORDER BY period) - 1)::DOUBLE AS temporal_factor FROM panel""",
       {"temporal_factor": 4})
def row_ordinal(spark, sf):
    df = temporal.entity_ordinal(order_panel(spark, sf), "entity", "period", bounded_entities=True)
    return df.select("entity", "period", F.col("ordinal").cast("long").alias("ordinal"),
                     (0.1 * F.col("ordinal")).alias("temporal_factor"))


@query("running_sum", f"""WITH {PANEL} SELECT entity, period, sum(amt) OVER (PARTITION BY entity
  ORDER BY period ROWS UNBOUNDED PRECEDING) AS running FROM panel""", {"running": 2})
def running_sum(spark, sf):
    return temporal.running_total(order_panel(spark, sf), "entity", "period", "amt", "running", True).select(
        "entity", "period", "running")


@query("running_count_events", """SELECT user_id, event_id, count(*) OVER w - 1 AS seen_before,
  sum(value) OVER w AS spent FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""",
       {"spent": 2})
def running_count_events(spark, sf):
    """Ordinals and running sums over raw rows, users of any size."""
    e = table(spark, sf, "events").select("user_id", "event_id", "value")
    summed = temporal.running_total(e, "user_id", "event_id", "value", "spent")
    return temporal.entity_ordinal(summed, "user_id", "event_id", "seen_before").select(
        "user_id", "event_id", F.col("seen_before").cast("long").alias("seen_before"), "spent")


@query("sorted_panel_head", f"""WITH {PANEL} SELECT entity, period, n_orders FROM panel
ORDER BY entity, period LIMIT 100""")
def sorted_panel_head(spark, sf):
    return order_panel(spark, sf).orderBy("entity", "period").select("entity", "period", "n_orders").limit(100)


@query("sorted_panel_tail", f"""WITH {PANEL} SELECT entity, period, n_orders FROM panel
ORDER BY entity DESC, period DESC LIMIT 100""")
def sorted_panel_tail(spark, sf):
    return (order_panel(spark, sf).orderBy(F.desc("entity"), F.desc("period"))
            .select("entity", "period", "n_orders").limit(100))


# ---- quality ---------------------------------------------------------------------------------

PANEL_RULES = [
    Q.Range("n_orders", 1, 5), Q.Range("amt", 1000, 1_500_000), Q.Range("avg_amt", 5000, 400_000),
    Q.Range("acctbal", 0, None), Q.Allowed("segment", ("AUTOMOBILE", "BUILDING", "MACHINERY")),
    Q.MissingRate("avg_amt", 0.05), Q.MissingRate("amt", 0.01), Q.Range("not_there", 0, 1),
]


@query("quality_report", f"""WITH {PANEL}, c AS (SELECT count(*) AS n,
  count(*) FILTER (WHERE n_orders < 1) AS v0, count(*) FILTER (WHERE n_orders > 5) AS v1,
  count(*) FILTER (WHERE amt < 1000) AS v2, count(*) FILTER (WHERE amt > 1500000) AS v3,
  count(*) FILTER (WHERE avg_amt < 5000) AS v4, count(*) FILTER (WHERE avg_amt > 400000) AS v5,
  count(*) FILTER (WHERE acctbal < 0) AS v6,
  count(*) FILTER (WHERE segment IS NULL OR segment NOT IN ('AUTOMOBILE','BUILDING','MACHINERY')) AS v7,
  count(*) FILTER (WHERE avg_amt IS NULL) AS v8, count(*) FILTER (WHERE amt IS NULL) AS v9 FROM panel)
SELECT CAST(ord AS INTEGER) AS ord, feature, rule, CAST(bound AS DOUBLE) AS bound, v AS n_violations,
       v / n::DOUBLE AS rate,
       CASE WHEN rule = 'missing_rate' THEN v / n::DOUBLE > bound ELSE v > 0 END AS violated
FROM c, LATERAL (VALUES (0,'n_orders','min',1,v0),(1,'n_orders','max',5,v1),(2,'amt','min',1000,v2),
  (3,'amt','max',1500000,v3),(4,'avg_amt','min',5000,v4),(5,'avg_amt','max',400000,v5),
  (6,'acctbal','min',0,v6),(7,'segment','allowed',NULL,v7),(8,'avg_amt','missing_rate',0.05,v8),
  (9,'amt','missing_rate',0.01,v9)) AS t(ord, feature, rule, bound, v)""", {"rate": 6})
def quality_report(spark, sf):
    return Q.quality_report(order_panel(spark, sf), PANEL_RULES).drop("message")


@query("quality_messages", f"""WITH {PANEL}, c AS (SELECT
  count(*) FILTER (WHERE n_orders > 3) AS v0, count(*) FILTER (WHERE acctbal < 100) AS v1,
  count(*) FILTER (WHERE segment IS NULL OR segment NOT IN ('AUTOMOBILE','BUILDING')) AS v2 FROM panel)
SELECT feature, message FROM c, LATERAL (VALUES ('n_orders', v0 || ' values above maximum 3.0'),
 ('acctbal', v1 || ' values below minimum 100.0'), ('segment', v2 || ' invalid categorical values'))
 AS t(feature, message)""")
def quality_messages(spark, sf):
    v = (Q.Validator().add_rule("n_orders", "range", min=0, max=3).add_rule("acctbal", "range", min=100)
         .add_rule("segment", "categorical", allowed_values=["AUTOMOBILE", "BUILDING"])
         .add_rule("missing_column", "range", min=0))
    return v.report(order_panel(spark, sf)).where("violated").select("feature", "message")


# Orders read as scoring requests: the value ranges are wide enough to be broken now and then.
_REQUESTS = """requests AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, 'P' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS patient_id,
    CAST(1990 + l_suppkey % 45 AS INTEGER) AS year, l_quantity * 2.5 AS age,
    CASE WHEN l_returnflag = 'A' THEN 'M' WHEN l_returnflag = 'N' THEN 'F' ELSE 'X' END AS gender,
    8.0 + l_quantity AS bmi, 60.0 + l_extendedprice / 400.0 AS systolic_bp,
    50.0 + l_quantity * 2.0 AS diastolic_bp, CAST(l_linenumber * 9 AS INTEGER) AS num_visits,
    CASE WHEN l_linestatus = 'O' THEN 'Never' ELSE 'Former' END AS smoking_status
  FROM lineitem)"""


def requests_from_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    c = F.col
    return li.select(
        c("l_orderkey").alias("order_id"), c("l_linenumber").alias("line"),
        R.entity_id(c("l_partkey")).alias("patient_id"),
        (1990 + c("l_suppkey") % 45).cast("int").alias("year"), (c("l_quantity") * 2.5).alias("age"),
        F.when(c("l_returnflag") == "A", "M").when(c("l_returnflag") == "N", "F").otherwise("X").alias("gender"),
        (8.0 + c("l_quantity")).alias("bmi"), (60.0 + c("l_extendedprice") / 400.0).alias("systolic_bp"),
        (50.0 + c("l_quantity") * 2.0).alias("diastolic_bp"), (c("l_linenumber") * 9).cast("int").alias("num_visits"),
        F.when(c("l_linestatus") == "O", "Never").otherwise("Former").alias("smoking_status"))


_VIOLATIONS = """concat_ws('|',
    CASE WHEN year < 2000 THEN 'year:min' END, CASE WHEN year > 2030 THEN 'year:max' END,
    CASE WHEN age < 0 THEN 'age:min' END, CASE WHEN age > 120 THEN 'age:max' END,
    CASE WHEN bmi < 10 THEN 'bmi:min' END, CASE WHEN bmi > 60 THEN 'bmi:max' END,
    CASE WHEN systolic_bp < 70 THEN 'systolic_bp:min' END, CASE WHEN systolic_bp > 250 THEN 'systolic_bp:max' END,
    CASE WHEN diastolic_bp < 40 THEN 'diastolic_bp:min' END, CASE WHEN diastolic_bp > 150 THEN 'diastolic_bp:max' END,
    CASE WHEN num_visits < 0 THEN 'num_visits:min' END, CASE WHEN num_visits > 50 THEN 'num_visits:max' END,
    CASE WHEN gender NOT IN ('M','F') THEN 'gender:allowed' END,
    CASE WHEN smoking_status NOT IN ('Never','Former','Current') THEN 'smoking_status:allowed' END,
    CASE WHEN diastolic_bp >= systolic_bp THEN 'diastolic_bp:below_systolic_bp' END)"""


@query("request_violations", f"""WITH {_REQUESTS}
SELECT order_id, line, patient_id, {_VIOLATIONS} AS violations FROM requests""")
def request_violations(spark, sf):
    checked = Q.row_violations(requests_from_lineitem(spark, sf), Q.request_rules())
    return checked.select("order_id", "line", "patient_id", F.concat_ws("|", "violations").alias("violations"))


@query("request_routing", f"""WITH {_REQUESTS}, v AS (SELECT *, {_VIOLATIONS} AS violations FROM requests)
SELECT CASE WHEN violations = '' THEN 'valid' ELSE 'rejected' END AS route, count(*) AS n,
       count(DISTINCT patient_id) AS patients FROM v GROUP BY 1""")
def request_routing(spark, sf):
    valid, rejected = Q.route(Q.row_violations(requests_from_lineitem(spark, sf), Q.request_rules()))
    both = valid.withColumn("route", F.lit("valid")).unionByName(rejected.withColumn("route", F.lit("rejected")))
    return both.groupBy("route").agg(F.count("*").alias("n"), F.countDistinct("patient_id").alias("patients"))


@query("duplicate_keys", """SELECT o_custkey AS entity, CAST(year(o_orderdate) AS INTEGER) AS period, count(*) AS n
FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("period"))
    return Q.duplicate_keys(o, ["entity", "period"])


# ---- scans, filters, scalar functions ----------------------------------------------------------

@query("scan_projection", """SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS qty FROM lineitem
WHERE l_quantity >= 10 AND l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1""", {"qty": 2})
def scan_projection(spark, sf):
    li = table(spark, sf, "lineitem")
    return (li.where((F.col("l_quantity") >= 10) & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")))
            .groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty")))


@query("period_coercion", """SELECT try_cast(CASE WHEN o_orderkey % 7 = 0 THEN 'n/a'
  ELSE CAST(year(o_orderdate) AS VARCHAR) END AS INTEGER) AS period, count(*) AS n FROM orders GROUP BY 1""")
def period_coercion(spark, sf):
    o = table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.year("o_orderdate").cast("string")).alias("period"))
    return readers.coerce_period(o, "period").groupBy("period").agg(F.count("*").alias("n"))


@query("filter_between_isin", """SELECT c_mktsegment AS segment, count(*) AS n,
  CAST(sum(CASE WHEN c_nationkey IN (1, 5, 9) THEN 1 ELSE 0 END) AS BIGINT) AS flagged
FROM customer WHERE c_acctbal BETWEEN 1800 AND 9000 GROUP BY 1""")
def filter_between_isin(spark, sf):
    return (table(spark, sf, "customer").where(F.col("c_acctbal").between(1800, 9000))
            .groupBy(F.col("c_mktsegment").alias("segment"))
            .agg(F.count("*").alias("n"), F.sum(R.flag(F.col("c_nationkey").isin(1, 5, 9))).alias("flagged")))


@query("bins_right_closed", """SELECT p_partkey, CASE WHEN p_size <= 0 THEN NULL WHEN p_size <= 10 THEN 'S'
  WHEN p_size <= 25 THEN 'M' WHEN p_size <= 40 THEN 'L' END AS size_group,
  CASE WHEN p_retailprice <= 0 THEN NULL WHEN p_retailprice <= 950.5 THEN 'low' ELSE 'high' END AS price_group
FROM part""")
def bins_right_closed(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", R.right_closed_bin(F.col("p_size"), [0, 10, 25, 40], ["S", "M", "L"]).alias("size_group"),
        R.right_closed_bin(F.col("p_retailprice"), [0, 950.5, float("inf")], ["low", "high"]).alias("price_group"))


_AGE_BMI = """CASE WHEN age <= 0 THEN NULL WHEN age <= 30 THEN '18-30' WHEN age <= 45 THEN '31-45'
   WHEN age <= 60 THEN '46-60' WHEN age <= 75 THEN '61-75' WHEN age <= 100 THEN '75+' END"""


@query("request_derivation", f"""WITH {_REQUESTS} SELECT order_id, line, year - age AS birth_year,
  {_AGE_BMI} AS age_group, CASE WHEN bmi <= 0 THEN NULL WHEN bmi <= 18.5 THEN 'Underweight'
  WHEN bmi <= 25 THEN 'Normal' WHEN bmi <= 30 THEN 'Overweight' WHEN bmi <= 100 THEN 'Obese' END AS bmi_category
FROM requests""", {"birth_year": 3})
def request_derivation(spark, sf):
    c = F.col
    return requests_from_lineitem(spark, sf).select(
        "order_id", "line", (c("year") - c("age")).alias("birth_year"), R.age_group(c("age")).alias("age_group"),
        R.bmi_category(c("bmi")).alias("bmi_category"))


@query("pressure_category", f"""WITH {_REQUESTS}, r AS (SELECT order_id, line,
  CASE WHEN order_id % 11 = 0 THEN NULL ELSE systolic_bp END AS s, diastolic_bp AS d FROM requests)
SELECT CASE WHEN coalesce(s < 120 AND d < 80, false) THEN 'Normal'
  WHEN coalesce(s < 130 AND d < 80, false) THEN 'Elevated'
  WHEN coalesce(s < 140 OR d < 90, false) THEN 'Stage 1' ELSE 'Stage 2' END AS category, count(*) AS n
FROM r GROUP BY 1""")
def pressure_category(spark, sf):
    r = requests_from_lineitem(spark, sf).withColumn(
        "s", F.when(F.col("order_id") % 11 != 0, F.col("systolic_bp")))
    return (r.select(R.pressure_category(F.col("s"), F.col("diastolic_bp")).alias("category"))
            .groupBy("category").agg(F.count("*").alias("n")))


@query("risk_score", f"""WITH {PANEL} SELECT entity, period,
  CAST(coalesce(CAST(avg_amt > 200000 AS INTEGER), 0) + CAST(n_orders > 2 AS INTEGER)
   + CAST(max_amt > 300000 AS INTEGER) + CAST(acctbal > 5000 AS INTEGER)
   + CAST(segment IN ('BUILDING', 'MACHINERY') AS INTEGER) AS INTEGER) AS risk_points,
  0.15 * greatest(n_orders - 1, 0)::DOUBLE / 5.0 + 0.20 * coalesce(greatest(avg_amt - 100000.0, 0.0) / 200000.0, 0.0)
   + 0.18 * 0.5 * CAST(acctbal > 5000 OR max_amt > 300000 AS INTEGER)
   + 0.10 * CASE segment WHEN 'BUILDING' THEN 0.3 WHEN 'MACHINERY' THEN 0.6 ELSE 0.0 END AS risk
FROM panel""", {"risk": 6})
def risk_score(spark, sf):
    c = F.col
    return order_panel(spark, sf).select(
        "entity", "period",
        R.count_true([c("avg_amt") > 200000, c("n_orders") > 2, c("max_amt") > 300000, c("acctbal") > 5000,
                      c("segment").isin("BUILDING", "MACHINERY")]).alias("risk_points"),
        R.weighted_sum([
            (R.excess(c("n_orders").cast("double"), 1, 5), 0.15), (R.excess(c("avg_amt"), 100000, 200000), 0.20),
            (0.5 * R.flag((c("acctbal") > 5000) | (c("max_amt") > 300000)), 0.18),
            (R.lookup(c("segment"), {"BUILDING": 0.3, "MACHINERY": 0.6}, 0.0), 0.10)]).alias("risk"))


@query("clinical_risk", f"""WITH {_REQUESTS} SELECT order_id, line,
  0.15 * (greatest(age - 40.0, 0.0) / 60.0) + 0.12 * (greatest(bmi - 25.0, 0.0) / 15.0)
  + 0.18 * (0.5 * CAST(systolic_bp > 140 OR diastolic_bp > 90 AS INTEGER))
  + 0.20 * coalesce(0.7 * CAST(CASE WHEN order_id % 5 <> 0 THEN bmi * 3 END > 126 AS INTEGER), 0.0)
  + 0.08 * (0.3 * CAST(systolic_bp + 40 > 240 AS INTEGER))
  + 0.10 * CASE smoking_status WHEN 'Former' THEN 0.3 WHEN 'Current' THEN 0.6 ELSE 0.0 END
  + 0.05 * (0.2 * CAST(num_visits > 5 AS INTEGER)) + 0.07 * (0.4 * CAST(gender = 'M' AS INTEGER))
  + 0.05 * (0.5 * CAST(line IN (1, 2) AS INTEGER)) AS risk FROM requests""", {"risk": 6})
def clinical_risk(spark, sf):
    c = F.col
    r = requests_from_lineitem(spark, sf).withColumns({
        "glucose": F.when(c("order_id") % 5 != 0, c("bmi") * 3), "cholesterol": c("systolic_bp") + 40,
        "lab_abnormal_flag": c("gender") == "M",
        "primary_diagnosis": F.when(c("line") == 1, "I10").when(c("line") == 2, "E11").otherwise("Z00")})
    return r.select("order_id", "line", R.clinical_risk().alias("risk"))


@query("scalar_text", """SELECT s_suppkey, 'P' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS id,
  try_cast(regexp_replace(s_name, '^Supplier#', '') AS INTEGER) AS number,
  CASE WHEN s_nationkey % 4 = 0 THEN 'nan' ELSE CAST(s_nationkey AS VARCHAR) END AS nation_text,
  concat_ws(',', CASE WHEN s_nationkey > 5 THEN 'A' END, CASE WHEN s_acctbal > 0 THEN 'B' END) AS codes,
  CAST((s_nationkey > 5)::INTEGER + (s_acctbal > 0)::INTEGER AS INTEGER) AS n_codes,
  greatest(least(s_acctbal, 5000.0), 0.0) AS clipped FROM supplier""", {"clipped": 2})
def scalar_text(spark, sf):
    c = F.col
    s = table(spark, sf, "supplier").withColumn(
        "codes", R.join_codes(F.when(c("s_nationkey") > 5, "A"), F.when(c("s_acctbal") > 0, "B")))
    return s.select("s_suppkey", R.entity_id(c("s_suppkey")).alias("id"),
                    R.strip_prefix_int(c("s_name"), "Supplier#").alias("number"),
                    R.as_text(F.when(c("s_nationkey") % 4 != 0, c("s_nationkey"))).alias("nation_text"), "codes",
                    F.size(R.split_codes(c("codes"))).alias("n_codes"),
                    R.clip(c("s_acctbal"), 0.0, 5000.0).alias("clipped"))


@query("lookup_default", """SELECT l_returnflag, sum(CASE l_returnflag WHEN 'A' THEN 0.3 WHEN 'N' THEN 0.6
  ELSE 0.0 END * l_quantity) AS weighted FROM lineitem GROUP BY 1""", {"weighted": 2})
def lookup_default(spark, sf):
    weight = R.lookup(F.col("l_returnflag"), {"A": 0.3, "N": 0.6}, 0.0)
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.sum(weight * F.col("l_quantity")).alias("weighted"))


@query("scored_bands", f"""WITH {SCORED} SELECT entity, period, score,
  CASE WHEN score >= 0.4 THEN 1 ELSE 0 END AS prediction,
  CASE WHEN score < 0.2 OR score > 0.8 THEN 'High' WHEN score < 0.4 OR score > 0.6 THEN 'Medium' ELSE 'Low' END
  AS confidence FROM scored""", {"score": 4})
def scored_bands(spark, sf):
    c = F.col("score")
    return scored_panel(spark, sf).select("entity", "period", "score",
                                          R.threshold_label(c, 0.4).alias("prediction"),
                                          R.confidence_band(c).alias("confidence"))


@query("sql_functions", f"""WITH {SCORED} SELECT entity, period, CASE WHEN score < 0.2 OR score > 0.8 THEN 'High'
  WHEN score < 0.4 OR score > 0.6 THEN 'Medium' ELSE 'Low' END AS band,
  CASE WHEN n_orders < 120 AND acctbal / 50.0 < 80 THEN 'Normal' WHEN n_orders < 130 AND acctbal / 50.0 < 80 THEN 'Elevated'
  WHEN n_orders < 140 OR acctbal / 50.0 < 90 THEN 'Stage 1' ELSE 'Stage 2' END AS category FROM scored""")
def sql_functions(spark, sf):
    register_sql_functions(spark)
    return scored_panel(spark, sf).selectExpr(
        "entity", "period", "confidence_band(score) AS band",
        "pressure_category(CAST(n_orders AS DOUBLE), acctbal / 50.0D) AS category")


@query("missing_indicator", f"""WITH {PANEL} SELECT entity, period, CAST(avg_amt IS NULL AS INTEGER)
  AS avg_amt_was_missing FROM panel""")
def missing_indicator(spark, sf):
    return order_panel(spark, sf).select("entity", "period",
                                         R.flag(F.col("avg_amt").isNull()).alias("avg_amt_was_missing"))


@query("null_injection")
def null_injection(spark, sf):
    df = R.inject_nulls(order_panel(spark, sf), ["entity", "period"],
                        {("amt",): 0.1, ("avg_amt", "max_amt"): 0.05})
    return df.agg(F.count("*").alias("n"), F.count_if(F.col("amt").isNull()).alias("amt_missing"),
                  F.count_if(F.col("max_amt").isNull()).alias("max_missing"))
