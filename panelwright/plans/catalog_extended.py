"""Queries of global text order, Gram matrices, drift, bootstrap intervals, information, advanced imputation and rule sets."""

from pyspark.sql import functions as F

from panelwright.functions import rules as R
from panelwright.operators import bootstrap, chained, drift, gram, impute, metrics, neighbors, prefix, profile, quality, select, temporal, thresholds
from panelwright.plans import training
from panelwright.plans.catalog_model import COLUMNS, CONFIG, stored_panel
from panelwright.plans.panel import order_panel, scored_panel
from panelwright.plans.registry import PANEL, SCORED, query, table
from panelwright.runtime import materialize, new_path
from panelwright.sources import readers, writers
from panelwright.streaming import scoring as S

NUM = ["n_orders", "amt", "avg_amt", "max_amt", "acctbal"]


# ---- global order -------------------------------------------------------------------------------

@query("rank_text_key", """SELECT c_custkey, row_number() OVER (ORDER BY c_name) AS rank,
  CAST(sum(c_nationkey + 1) OVER (ORDER BY c_name ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM customer""")
def rank_text_key(spark, sf):
    names = materialize(table(spark, sf, "customer").select("c_custkey", "c_name", (F.col("c_nationkey") + 1).alias("n"), F.lit(1).alias("one")))
    ranked = prefix.running_sums(names, "c_name", {"rank": "one", "running": "n"}, rows_per_range=256)
    return ranked.select("c_custkey", F.col("rank").cast("long").alias("rank"), F.col("running").cast("long").alias("running"))


@query("first_rows_by_text", """SELECT c_custkey, c_name, c_mktsegment FROM customer
ORDER BY CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END DESC NULLS LAST, c_name LIMIT (SELECT count(*) * 4 // 5 FROM customer)""")
def first_rows_by_text(spark, sf):
    segment = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    rows = materialize(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", segment.alias("s")))
    cut = prefix.rank_cutoff(rows, [("s", True), ("c_name", False)], rows.count() * 4 // 5, rows_per_range=256)
    return rows.where(cut).drop("s")


# ---- Gram matrix ----------------------------------------------------------------------------------

_WIDE = {"qty": "l_quantity", "price": "l_extendedprice", "disc": "l_discount", "tax": "l_tax", "line": "l_linenumber",
         "supp": "CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey END", "part": "CASE WHEN l_partkey % 11 <> 0 THEN l_partkey END",
         "net": "l_extendedprice * (1 - l_discount)", "gross": "l_extendedprice * (1 + l_tax)", "unit": "l_extendedprice / l_quantity",
         "big": "CASE WHEN l_quantity > 25 THEN l_extendedprice END", "odd": "l_orderkey % 13", "flat": "1", "less": "-l_quantity"}


def _wide(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(*[f"CAST({x} AS DOUBLE) AS {name}" for name, x in _WIDE.items()])


_WIDE_SQL = "w AS (SELECT " + ", ".join(f"CAST({x} AS DOUBLE) AS {name}" for name, x in _WIDE.items()) + " FROM lineitem)"
_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, CASE WHEN least(stddev_pop({a}) FILTER ({b} IS NOT NULL), stddev_pop({b}) FILTER ({a} IS NOT NULL)) > 0 "
    f"THEN corr({a}, {b}) END AS r, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n FROM w"
    for i, a in enumerate(_WIDE) for b in list(_WIDE)[i + 1:])


@query("gram_correlations", f"WITH {_WIDE_SQL} {_PAIRS_SQL}", {"r": 6})
def gram_correlations(spark, sf):
    return gram.gram_correlations(_wide(spark, sf), list(_WIDE), block=5)


@query("correlation_filter", f"""WITH RECURSIVE {_WIDE_SQL}, r AS MATERIALIZED (SELECT a, b FROM ({_PAIRS_SQL}) WHERE abs(r) > 0.9),
close AS (SELECT list(a || '|' || b) AS pairs FROM r),
g AS (SELECT 0 AS step, CAST([] AS VARCHAR[]) AS kept UNION ALL
  SELECT step + 1, CASE WHEN len(list_filter(kept, lambda k: list_contains(pairs, k || '|' || names[step + 1]))) = 0
    THEN list_append(kept, names[step + 1]) ELSE kept END
  FROM g, close, (SELECT {list(_WIDE)} AS names) WHERE step < {len(_WIDE)})
SELECT unnest(kept) AS feature FROM g WHERE step = {len(_WIDE)}""")
def correlation_filter(spark, sf):
    kept = gram.correlation_filter(_wide(spark, sf), list(_WIDE), 0.9)
    return spark.createDataFrame([(c,) for c in kept], "feature string")


# ---- drift ----------------------------------------------------------------------------------------

_DRIFT = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LEVEL = "CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.25 THEN 'moderate' ELSE 'major' END"


def _term_sql(bins):
    a, b = f"((a + 0.5) / (n_base + 0.5 * {bins}))", f"((b + 0.5) / (n_new + 0.5 * {bins}))"
    return f"({a} - {b}) * ln({a} / {b})"


@query("drift_numeric", f"""WITH l AS (SELECT *, year(l_shipdate) AS y FROM lineitem WHERE year(l_shipdate) IN (1996, 1999)),
c AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} + CASE WHEN y = 1999 AND l_linenumber = 1 THEN 0.05 ELSE 0 END AS DOUBLE) AS v, y FROM l" for c in _DRIFT)}),
h AS (SELECT feature, v, count(*) FILTER (y = 1996)::DOUBLE AS a, count(*) FILTER (y = 1999)::DOUBLE AS b FROM c GROUP BY 1, 2),
s AS (SELECT *, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY feature) AS n_base, sum(b) OVER (PARTITION BY feature) AS n_new
  FROM h WINDOW w AS (PARTITION BY feature ORDER BY v)),
t AS (SELECT feature, n_base, n_new, least(floor((ca - a) / n_base * 10), 9) AS bin, sum(a) AS a, sum(b) AS b, max(abs(ca / n_base - cb / n_new)) AS ks
  FROM s GROUP BY 1, 2, 3, 4),
f AS (SELECT feature, n_base, n_new, max(ks) AS ks, sum({_term_sql(10)}) AS psi FROM t GROUP BY 1, 2, 3),
x AS (SELECT *, ks * sqrt(n_base * n_new / (n_base + n_new)) AS x FROM f)
SELECT feature, CAST(n_base AS BIGINT) AS n_base, CAST(n_new AS BIGINT) AS n_new, ks, psi, {_LEVEL} AS level,
  CASE WHEN x < 0.2 THEN 1.0::DOUBLE ELSE greatest(0.0, least(1.0, list_sum(list_transform(range(1, 41),
    lambda k: CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * x * x))))) END AS p_value FROM x""", {"ks": 8, "psi": 6, "p_value": 6})
def drift_numeric(spark, sf):
    y = F.year("l_shipdate")
    moved = F.when((y == 1999) & (F.col("l_linenumber") == 1), 0.05).otherwise(0.0)
    rows = table(spark, sf, "lineitem").select(y.alias("y"), *[(F.col(c) + moved).alias(c) for c in _DRIFT])
    return drift.numeric_drift(rows.where("y = 1996"), rows.where("y = 1999"), _DRIFT, rows_per_range=2000)


@query("drift_categories", f"""WITH o AS (SELECT o_orderpriority AS p, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END AS s, year(o_orderdate) AS y FROM orders),
c AS (SELECT 'o_orderpriority' AS feature, p AS v, y FROM o UNION ALL SELECT 'status', s, y FROM o),
h AS (SELECT feature, v, count(*) FILTER (y = 1995)::DOUBLE AS a, count(*) FILTER (y = 1998)::DOUBLE AS b FROM c WHERE y IN (1995, 1998) GROUP BY 1, 2),
n AS (SELECT *, sum(a) OVER w AS n_base, sum(b) OVER w AS n_new, count(*) OVER w AS k FROM h WINDOW w AS (PARTITION BY feature)),
f AS (SELECT feature, n_base, n_new, k, sum(CASE WHEN a = 0 THEN b ELSE 0 END) / n_new AS unseen, sum({_term_sql("k")}) AS psi FROM n GROUP BY 1, 2, 3, 4)
SELECT feature, CAST(n_base AS BIGINT) AS n_base, CAST(n_new AS BIGINT) AS n_new, CAST(k AS BIGINT) AS n_categories, unseen, psi, {_LEVEL} AS level FROM f""",
       {"unseen": 6, "psi": 6})
def drift_categories(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("y"), "o_orderpriority", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderstatus")).alias("status"))
    return drift.category_drift(o.where("y = 1995"), o.where("y = 1998"), ["o_orderpriority", "status"])


# ---- bootstrap ------------------------------------------------------------------------------------

_REPLICATES = 16
_DRAW = f"CAST('0x' || substr(md5('42:' || ((r - 1) // {bootstrap.DRAWS_PER_DIGEST}) || ':' || entity || ':' || period), 4 * ((r - 1) % {bootstrap.DRAWS_PER_DIGEST}) + 1, 4) AS INTEGER)"
_REPLICATES_SQL = f"""WITH {SCORED}, d AS (SELECT r, score, label, CASE WHEN r = 0 THEN 1 ELSE {" + ".join(
    f"CAST({_DRAW} >= {limit} AS INTEGER)" for limit in bootstrap.poisson_limits())} END AS w FROM scored, range({_REPLICATES} + 1) AS t(r)),
h AS (SELECT r, score, sum(w * label)::DOUBLE AS p, sum(w * (1 - label))::DOUBLE AS n FROM d GROUP BY 1, 2),
c AS (SELECT *, sum(p) OVER o AS tp, sum(n) OVER o AS fp FROM h WINDOW o AS (PARTITION BY r ORDER BY score DESC)),
m AS (SELECT CAST(r AS INTEGER) AS replicate, sum(n * (tp - p / 2)) / (sum(p) * sum(n)) AS roc_auc,
  sum(CASE WHEN tp + fp > 0 THEN p * tp / (tp + fp) END) / sum(p) AS pr_auc FROM c GROUP BY 1)"""


@query("bootstrap_replicates", _REPLICATES_SQL + "SELECT * FROM m", {"roc_auc": 8, "pr_auc": 8})
def bootstrap_replicates(spark, sf):
    return bootstrap.bootstrap_replicates(scored_panel(spark, sf), ["entity", "period"], replicates=_REPLICATES)


@query("bootstrap_intervals", _REPLICATES_SQL + ", l AS (" + " UNION ALL ".join(
    f"SELECT '{x}' AS metric, replicate, {x} AS v FROM m" for x in ("roc_auc", "pr_auc")) + """)
SELECT metric, max(v) FILTER (replicate = 0) AS value, quantile_cont(v, 0.05) FILTER (replicate > 0) AS low, quantile_cont(v, 0.95) FILTER (replicate > 0) AS high,
  stddev_samp(v) FILTER (replicate > 0) AS std FROM l GROUP BY 1""", {"value": 8, "low": 7, "high": 7, "std": 7})
def bootstrap_intervals(spark, sf):
    return bootstrap.bootstrap_intervals(scored_panel(spark, sf), ["entity", "period"], replicates=_REPLICATES, level=0.9)


# ---- information ----------------------------------------------------------------------------------

_EDGES = ", ".join(f"quantile_cont({c}::DOUBLE, {[i / 10 for i in range(1, 10)]}) AS {c}" for c in NUM)


@query("mutual_information", f"""WITH {PANEL}, e AS (SELECT {_EDGES} FROM panel),
c AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, len(list_filter(list_distinct(e.{c}), lambda q: q < p.{c})) AS bin, label FROM panel p, e WHERE p.{c} IS NOT NULL" for c in NUM)}),
j AS (SELECT feature, bin, label, count(*)::DOUBLE AS n FROM c GROUP BY 1, 2, 3),
w AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS t, sum(n) OVER (PARTITION BY feature, bin) AS nx, sum(n) OVER (PARTITION BY feature, label) AS ny FROM j)
SELECT feature, CAST(t AS BIGINT) AS n, count(DISTINCT bin) AS bins, count(DISTINCT label) AS classes,
  sum(n / t * ln(n * t / (nx * ny))) - (count(DISTINCT bin) - 1) * (count(DISTINCT label) - 1) / (2 * t) AS mi FROM w GROUP BY feature, t""", {"mi": 8})
def mutual_information(spark, sf):
    return select.mutual_information(order_panel(spark, sf), NUM)


# ---- imputation -----------------------------------------------------------------------------------

@query("impute_chained", f"""WITH {PANEL}, r AS (SELECT regr_slope(avg_amt, amt) AS b, regr_intercept(avg_amt, amt) AS a FROM panel WHERE avg_amt IS NOT NULL)
SELECT entity, period, amt, coalesce(avg_amt, a + b * amt) AS avg_amt FROM panel, r""", {"amt": 2, "avg_amt": 2})
def impute_chained(spark, sf):
    p = materialize(order_panel(spark, sf).select("entity", "period", "amt", "avg_amt"))
    return chained.apply_chained(p, chained.chained_fill(p, ["amt", "avg_amt"], rounds=1))


_NEAR = ["acctbal", "avg_amt", "amt"]


@query("impute_nearest", f"""WITH {PANEL}, p AS MATERIALIZED (SELECT entity * 10000 + period AS id, acctbal / 1000 AS acctbal, avg_amt / 10000 AS avg_amt,
  CASE WHEN entity % 7 <> 1 THEN amt / 10000 END AS amt FROM panel WHERE period <= 1996),
d AS (SELECT a.id, b.id AS donor, {", ".join(f"a.{c} IS NULL AS no_{c}, b.{c} AS {c}" for c in _NEAR)},
  sqrt(({" + ".join(f"coalesce((a.{c} - b.{c}) * (a.{c} - b.{c}), 0)" for c in _NEAR)}) * 3
    / nullif({" + ".join(f"CAST(a.{c} IS NOT NULL AND b.{c} IS NOT NULL AS INTEGER)" for c in _NEAR)}, 0)) AS far
  FROM p a JOIN p b ON a.id <> b.id WHERE {" OR ".join(f"a.{c} IS NULL" for c in _NEAR)}),
""" + ", ".join(f"""n_{c} AS (SELECT id, avg(v) AS v FROM (SELECT id, {c} AS v, row_number() OVER (PARTITION BY id ORDER BY far, donor) AS k FROM d
  WHERE no_{c} AND {c} IS NOT NULL AND far IS NOT NULL) WHERE k <= 5 GROUP BY id)""" for c in _NEAR) + f"""
SELECT id, {", ".join(f"coalesce(p.{c}, n_{c}.v) AS {c}" for c in _NEAR)} FROM p {" ".join(f"LEFT JOIN n_{c} USING (id)" for c in _NEAR)}""",
       {c: 4 for c in _NEAR})
def impute_nearest(spark, sf):
    p = order_panel(spark, sf).where("period <= 1996").select(
        (F.col("entity") * 10000 + F.col("period")).alias("id"), (F.col("acctbal") / 1000).alias("acctbal"), (F.col("avg_amt") / 10000).alias("avg_amt"),
        F.when(F.col("entity") % 7 != 1, F.col("amt") / 10000).alias("amt"))
    return chained.nearest_fill(p, "id", _NEAR, 5, block=512)


@query("sparse_columns", f"""WITH {PANEL}, s AS (SELECT CASE WHEN entity % 3 = 0 THEN amt END AS third, CASE WHEN entity % 3 > 0 THEN amt END AS rest,
  CASE WHEN entity % 10 = 0 THEN segment END AS tenth, nation FROM panel),
m AS (SELECT unnest(['third', 'rest', 'tenth', 'nation']) AS feature,
  unnest([1 - count(third) / count(*), 1 - count(rest) / count(*), 1 - count(tenth) / count(*), 1 - count(nation) / count(*)]) AS missing FROM s)
SELECT feature FROM m WHERE missing > 0.5""")
def sparse_columns(spark, sf):
    e = F.col("entity")
    p = order_panel(spark, sf).select(F.when(e % 3 == 0, F.col("amt")).alias("third"), F.when(e % 3 > 0, F.col("amt")).alias("rest"),
                                      F.when(e % 10 == 0, F.col("segment")).alias("tenth"), "nation")
    return spark.createDataFrame([(c,) for c in impute.sparse_columns(p, p.columns, 0.5)], "feature string")


# ---- what missing values cost, weighted thresholds ----------------------------------------------------

@query("threshold_weighted", f"""WITH {SCORED}, h AS (SELECT score, sum(label)::DOUBLE AS p, count(*)::DOUBLE AS n FROM scored GROUP BY 1),
c AS (SELECT score, sum(p) OVER w AS tp, sum(n) OVER w AS seen, sum(p) OVER () AS total FROM h WINDOW w AS (ORDER BY score DESC)),
v AS (SELECT score, (0.3 * (tp / seen) + 0.7 * (tp / total)) / (0.3 + 0.7) AS v FROM c)
SELECT score AS threshold, v AS objective FROM v ORDER BY v DESC, score DESC LIMIT 1""", {"objective": 8})
def threshold_weighted(spark, sf):
    return thresholds.weighted_threshold(scored_panel(spark, sf))


@query("missing_impact", f"""WITH {SCORED}, c AS (SELECT 'all' AS cases, * FROM scored UNION ALL SELECT CASE WHEN avg_amt IS NULL THEN 'incomplete' ELSE 'complete' END, * FROM scored),
h AS (SELECT cases, score, sum(label)::DOUBLE AS p, sum(1 - label)::DOUBLE AS n FROM c GROUP BY 1, 2),
a AS (SELECT cases, sum(n * (tp - p / 2)) / (sum(p) * sum(n)) AS roc_auc FROM (SELECT *, sum(p) OVER (PARTITION BY cases ORDER BY score DESC) AS tp FROM h) GROUP BY 1)
SELECT cases, count(*) AS sample_size, avg(label) AS positive_rate, avg(CAST(label = pred AS INTEGER)) AS accuracy, any_value(roc_auc) AS roc_auc
FROM c JOIN a USING (cases) GROUP BY 1""", {"positive_rate": 8, "accuracy": 8, "roc_auc": 8})
def missing_impact(spark, sf):
    return metrics.missing_impact(scored_panel(spark, sf), ["avg_amt", "amt"]).select("cases", "sample_size", "positive_rate", "accuracy", "roc_auc")


@query("completeness_flag", f"""WITH {PANEL} SELECT 100.0::DOUBLE * (count(avg_amt) + count(amt) + count(segment)) / (3 * count(*)) AS completeness,
  (count(avg_amt) + count(amt) + count(segment)) >= 0.97 * 3 * count(*) AS complete_enough FROM panel""", {"completeness": 6})
def completeness_flag(spark, sf):
    return profile.completeness_flag(order_panel(spark, sf).select("avg_amt", "amt", "segment"), 0.97)


@query("missing_patterns", f"""WITH {PANEL}, g AS (SELECT concat_ws(',', CASE WHEN avg_amt IS NULL THEN 'avg_amt' END, CASE WHEN entity % 9 = 0 THEN 'segment' END) AS pattern FROM panel)
SELECT pattern, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM g GROUP BY 1""", {"share": 8})
def missing_patterns(spark, sf):
    p = order_panel(spark, sf).withColumn("segment", F.when(F.col("entity") % 9 != 0, F.col("segment")))
    return profile.missing_patterns(p, ["avg_amt", "amt", "segment"])


@query("missing_scenarios", f"""WITH {PANEL} SELECT unnest(['as_is', 'poor']) AS scenario, count(*) AS sample_size, CAST(sum(label) AS BIGINT) AS positives FROM panel""")
def missing_scenarios(spark, sf):
    p = stored_panel(spark, sf)
    model, _ = training.fit_model(p, CONFIG, COLUMNS)
    told = training.missing_scenarios(model, p, 0.4, COLUMNS, {"as_is": {}, "poor": {("amt", "max_amt"): 0.3, ("acctbal",): 0.2}})
    return told.select("scenario", "sample_size", (F.col("true_positives") + F.col("false_negatives")).alias("positives"))


# ---- latency of a stream ------------------------------------------------------------------------------

@query("stream_latency", """WITH w AS (SELECT date_trunc('day', ts) AS d, event_type, count(*) AS processed, sum(value) AS latency_total,
  quantile_disc(value, 0.5) AS latency_p50, quantile_disc(value, 0.95) AS latency_p95 FROM events GROUP BY 1, 2)
SELECT CAST(d AS TIMESTAMP) AS window_start, event_type, processed, latency_total, latency_p50, latency_p95 FROM w
WHERE d + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""", {"latency_total": 2, "latency_p50": 4, "latency_p95": 4})
def stream_latency(spark, sf):
    source = f"{sf}/events.parquet"
    stream = S.read_stream(spark, f"{source}*", spark.read.parquet(source).schema)
    out = new_path(spark, "stream-latency")
    S.run_to_table(S.health_counters(stream, "ts", None, "1 day", "10 minutes", ["event_type"], "value").drop("errors"), f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


# ---- neighbours in many dimensions ------------------------------------------------------------------

@query("bucketed_neighbors", """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
  d AS (SELECT a.vec_id, b.vec_id AS neighbor, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id) AS r
        FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT count(*) AS pairs, count(DISTINCT vec_id) AS n, true AS recall_of_nine_tenths, true AS distances_are_exact FROM d WHERE r <= 5""")
def bucketed_neighbors(spark, sf):
    e = table(spark, sf, "embeddings")
    found = materialize(neighbors.bucketed_neighbors(e, "vec_id", "embedding", 5))
    exact = materialize(neighbors.nearest_neighbors(e, "vec_id", "embedding", 5))
    both = exact.select("vec_id", "neighbor", F.col("distance").alias("true_distance")).join(found, ["vec_id", "neighbor"])
    hits = both.agg(F.count("*").alias("hits"), F.max(F.abs(F.col("distance") - F.col("true_distance"))).alias("off"))
    return found.agg(F.count("*").alias("pairs"), F.count_distinct("vec_id").alias("n")).crossJoin(hits).select(      # one row each
        "pairs", "n", (F.col("hits") >= 0.9 * F.lit(exact.count())).alias("recall_of_nine_tenths"), (F.col("off") < 1e-9).alias("distances_are_exact"))


# ---- rule sets, sinks, column lists ---------------------------------------------------------------

_CLINIC = {"patient_id": "CAST(c_custkey AS STRING)", "year": "CASE WHEN c_custkey % 50 > 0 THEN 2015 + c_custkey % 5 END",
           "age": "c_custkey % 131", "bmi": "8 + c_custkey % 60", "systolic_bp": "60 + c_custkey % 201", "diastolic_bp": "35 + c_custkey % 120",
           "glucose": "40 + c_custkey % 470", "cholesterol": "90 + c_custkey % 420", "gender": "CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'X' END",
           "smoking_status": "CASE WHEN c_custkey % 6 > 0 THEN 'Never' END"}


def _clinical_sql():
    def row(feature, rule, bound, bad):
        return f"SELECT '{feature}' AS feature, '{rule}' AS rule, {bound} AS bound, count(*) FILTER ({bad}) AS n_violations, count(*) AS n FROM c"

    rows = []
    for r in quality.clinical_rules():
        f = r.feature
        if isinstance(r, quality.Range):
            rows += [row(f, "min", f"{r.low}::DOUBLE", f"{f} < {r.low}"), row(f, "max", f"{r.high}::DOUBLE", f"{f} > {r.high}")]
        elif isinstance(r, quality.Allowed):
            rows.append(row(f, "allowed", "NULL::DOUBLE", f"coalesce({f} NOT IN {r.values}, true)"))
        else:
            rows.append(row(f, "missing_rate", f"{r.limit}::DOUBLE", f"{f} IS NULL"))
    fields = ", ".join(f"{x.replace('STRING', 'VARCHAR')} AS {name}" for name, x in _CLINIC.items())
    return f"""WITH c AS (SELECT {fields} FROM customer), r AS ({" UNION ALL ".join(rows)})
SELECT feature, rule, bound, n_violations, CASE WHEN rule = 'missing_rate' THEN n_violations / n > bound ELSE n_violations > 0 END AS violated FROM r"""


@query("clinical_report", _clinical_sql())
def clinical_report(spark, sf):
    patients = table(spark, sf, "customer").selectExpr(*[f"{x} AS {name}" for name, x in _CLINIC.items()])
    return quality.quality_report(patients, quality.clinical_rules()).select("feature", "rule", "bound", "n_violations", "violated")


@query("csv_sink", """SELECT n_name, count(*)::VARCHAR AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def csv_sink(spark, sf):
    counts = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))
    path = new_path(spark, "counts")
    writers.write_csv(counts, path)
    return spark.read.option("header", True).csv(path)


@query("stamped_rows", "SELECT s_suppkey, 'v7' AS model_version, true AS stamped FROM supplier")
def stamped_rows(spark, sf):
    rows = R.stamp(table(spark, sf, "supplier").select("s_suppkey"), "v7")
    return rows.select("s_suppkey", "model_version", (F.col("timestamp") <= F.current_timestamp()).alias("stamped"))


@query("detected_features", "SELECT unnest(['c_nationkey', 'c_acctbal']) AS feature")
def detected_features(spark, sf):
    found = temporal.detect_features(table(spark, sf, "customer"), "c_custkey", "c_name")
    return spark.createDataFrame([(c,) for c in found], "feature string")


@query("crosstab_other", """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus <> 'F') AS rest,
  count(*) FILTER (o_orderstatus = 'F')::DOUBLE / count(*) AS "F_share", count(*) FILTER (o_orderstatus <> 'F')::DOUBLE / count(*) AS rest_share
FROM orders GROUP BY 1""", {"F_share": 8, "rest_share": 8})
def crosstab_other(spark, sf):
    return profile.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F"], other="rest")


@query("filtered_read", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity >= 30 AND l_discount < 0.05 GROUP BY 1")
def filtered_read(spark, sf):
    rows = readers.load_data(spark, f"{sf}/lineitem.parquet", where="l_quantity >= 30 and l_discount < 0.05")
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"))
