"""Facts that SQL can state about the random and iterative operators: counts, subsets, ranges, equal reruns, known choices."""

from pyspark.sql import functions as F

from panelwright.functions import rules as R
from panelwright.ml import models, stages
from panelwright.operators import outliers, profile, select, split, thresholds
from panelwright.plans import training
from panelwright.plans.catalog_model import COLUMNS, CONFIG, stored_panel
from panelwright.plans.panel import FEATURES, order_panel, scored_panel
from panelwright.plans.registry import PANEL, query, table
from panelwright.plans.scoring import model_scorer
from panelwright.runtime import materialize, new_path
from panelwright.sources import artifacts as art
from panelwright.sources import readers


@query("check_sampled_scan", """SELECT count(*) AS n_rows, true AS near_a_fifth, true AS same_again, 0::BIGINT AS not_in_source FROM lineitem""")
def check_sampled_scan(spark, sf):
    key = ["l_orderkey", "l_linenumber"]
    whole = table(spark, sf, "lineitem").select(*key)
    parts = [materialize(readers.load_data(spark, f"{sf}/lineitem.parquet", sample_fraction=0.2, key=key).select(*key)) for _ in range(2)]
    n, drawn = whole.count(), parts[0].count()
    spread = 5 * (0.16 * n) ** 0.5                                       # five deviations of a binomial count
    again = parts[0].exceptAll(parts[1]).count() + parts[1].exceptAll(parts[0]).count()
    return spark.createDataFrame([(n, abs(drawn - 0.2 * n) <= spread, again == 0, parts[0].exceptAll(whole).count())],
                                 "n_rows long, near_a_fifth boolean, same_again boolean, not_in_source long")


@query("check_exact_sample", "SELECT least(50, count(*)) AS n, least(50, count(*)) AS keys, least(50, count(*)) AS in_source FROM customer")
def check_exact_sample(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    drawn = readers.sample_n(customer, 50, ["c_custkey"])
    return drawn.join(customer.withColumnRenamed("c_name", "name"), "c_custkey").agg(
        F.count("*").alias("n"), F.count_distinct("c_custkey").alias("keys"), F.count_if(F.col("c_name") == F.col("name")).alias("in_source"))


@query("check_null_injection", f"""WITH {PANEL} SELECT count(*) AS n, true AS near_rate, true AS near_joint_rate, true AS one_mask, count(acctbal) AS untouched FROM panel""")
def check_null_injection(spark, sf):
    p = order_panel(spark, sf).withColumn("avg_amt", F.lit(1.0))
    df = R.inject_nulls(p, ["entity", "period"], {("amt",): 0.1, ("avg_amt", "max_amt"): 0.05})

    def near(c, rate):
        n = F.count("*")
        return F.abs(F.count_if(F.col(c).isNull()) - rate * n) <= 5 * F.sqrt(rate * (1 - rate) * n)

    return df.agg(F.count("*").alias("n"), near("amt", 0.1).alias("near_rate"), near("max_amt", 0.05).alias("near_joint_rate"),
                  (F.count_if(F.col("avg_amt").isNull() != F.col("max_amt").isNull()) == 0).alias("one_mask"), F.count("acctbal").alias("untouched"))


@query("check_reloaded_model", f"WITH {PANEL} SELECT count(*) AS n, count(*) AS n_equal, count(*) AS in_range FROM panel")
def check_reloaded_model(spark, sf):
    p = stored_panel(spark, sf)
    model, features = training.fit_model(p, CONFIG, COLUMNS)
    path = new_path(spark, "artifacts")
    inputs = [c for c in p.columns if c != "label"]
    kept = art.Artifacts(model, 0.4, features, inputs, "logistic_regression", CONFIG)
    art.save_artifacts(spark, path, kept)
    one, two = (model_scorer(a, ["entity", "period"])(p.drop("label")) for a in (kept, art.load_artifacts(spark, path)))
    both = one.join(two.withColumnRenamed("probability", "again"), ["entity", "period"])
    return both.agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("probability") - F.col("again")) < 1e-12).alias("n_equal"),
                    F.count_if(F.col("probability").between(0, 1)).alias("in_range"))


@query("check_evaluation", f"""WITH {PANEL} SELECT count(*) AS sample_size, CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives,
  true AS better_than_chance, 0.4::DOUBLE AS optimal_threshold FROM panel""")
def check_evaluation(spark, sf):
    p = stored_panel(spark, sf)
    model, _ = training.fit_model(p, CONFIG, COLUMNS)
    return training.evaluate(model, p, 0.4, "label").select(
        "sample_size", (F.col("true_positives") + F.col("false_negatives")).alias("positives"),
        (F.col("true_negatives") + F.col("false_positives")).alias("negatives"), (F.col("roc_auc") > 0.5).alias("better_than_chance"), "optimal_threshold")


@query("check_folds", """SELECT fold, true AS rows_as_planned, true AS metrics_in_range, true AS apart_in_time FROM (SELECT unnest([1, 2]) AS fold)""")
def check_folds(spark, sf):
    p = stored_panel(spark, sf)
    done = training.train_model(p, CONFIG, COLUMNS)
    planned = spark.createDataFrame([(i, val.count(), train.agg(F.max("period")).first()[0]) for i, (train, val) in enumerate(
        training.make_splits(p, CONFIG, COLUMNS), 1)], "fold int, n long, trained_to int")
    seen = done.scored.groupBy("fold").agg(F.count("*").alias("got"), F.min("period").alias("first"))
    ranges = done.folds.select("fold", (F.col("roc_auc").between(0, 1) & F.col("pr_auc").between(0, 1)).alias("metrics_in_range"))
    return seen.join(planned, "fold").join(ranges, "fold").select(
        "fold", (F.col("n") == F.col("got")).alias("rows_as_planned"), "metrics_in_range", (F.col("first") > F.col("trained_to")).alias("apart_in_time"))


_MODEL_COLUMNS = [*FEATURES, *[f"{c}_{x}" for c in ("n_orders", "amt") for x in ("rolling_mean_2y", "rolling_trend_2y", "lag_1y")], "segment", "nation"]


@query("check_model_columns", f"SELECT unnest({sorted(_MODEL_COLUMNS)}) AS feature, 1.0::DOUBLE AS total, true AS not_negative", {"total": 6})
def check_model_columns(spark, sf):
    """The learner's columns are the panel's, the derived and the encoded ones; a forest's importances are shares."""
    config = {**CONFIG, "imbalance": {}, "model": {"algorithm": "random_forest", "random_forest": {"numTrees": 5, "maxDepth": 3}}}
    model, features = training.fit_model(stored_panel(spark, sf), config, COLUMNS)
    found = models.feature_importances(model, features)
    total = found.agg(F.sum("importance")).first()[0]
    return found.select("feature", F.lit(total).alias("total"), (F.col("importance") >= 0).alias("not_negative"))


def _separable(spark, sf):
    """The label is decided by two of the columns."""
    p = stored_panel(spark, sf).fillna(0.0, ["avg_amt"])
    return p.withColumn("told", ((F.col("acctbal") > 3000) | (F.col("n_orders") > 3)).cast("int")), ["n_orders", "acctbal", "noise_a", "noise_b"]


def _with_noise(df):
    return df.withColumns({f"noise_{x}": F.pmod(F.xxhash64("entity", "period", F.lit(x)), F.lit(1000)).cast("double") for x in "ab"})


@query("check_importance_choice", "SELECT unnest(['acctbal', 'n_orders']) AS feature")
def check_importance_choice(spark, sf):
    df, cols = _separable(spark, sf)
    return spark.createDataFrame([(c,) for c in select.importance_selection(_with_noise(df), cols, "told", 2, trees=20)], "feature string")


@query("check_elimination_choice", "SELECT unnest(['acctbal', 'n_orders']) AS feature")
def check_elimination_choice(spark, sf):
    df, cols = _separable(spark, sf)
    return spark.createDataFrame([(c,) for c in select.recursive_elimination(_with_noise(df), cols, "told", 2, trees=10)], "feature string")


@query("check_search", "SELECT 3::BIGINT AS trials, 3::BIGINT AS in_range, true AS best_first, true AS same_side_by_side")
def check_search(spark, sf):
    config = {**CONFIG, "imbalance": {}, "hpo": {"n_trials": 3, "algorithms": ["logistic_regression"], "opt_metric": "roc_auc"}}
    p = stored_panel(spark, sf)
    one = training.search(p, config, COLUMNS).collect()                  # a row a trial
    two = training.search(p, {**config, "hpo": {**config["hpo"], "parallel": 3}}, COLUMNS).collect()
    values = [r["value"] for r in one]
    same = [(r["trial"], r["settings"], round(r["value"], 9)) for r in one] == [(r["trial"], r["settings"], round(r["value"], 9)) for r in two]
    return spark.createDataFrame([(len(one), sum(0 <= v <= 1 for v in values), values == sorted(values, reverse=True), same)],
                                 "trials long, in_range long, best_first boolean, same_side_by_side boolean")


@query("check_outlier_share", """SELECT count(*) AS n, true AS near_share, true AS planted_found FROM lineitem""")
def check_outlier_share(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    planted = (F.col("l_orderkey") % 997 == 0) & (F.col("l_linenumber") == 1)
    rows = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), planted.alias("planted"),
                                               *[F.when(planted, F.col(c) * 50 + 1000).otherwise(F.col(c)).alias(c) for c in cols])
    out = outliers.isolation_outliers(rows, "id", cols, contamination=0.05, trees=30)
    flagged = F.avg(F.col("is_outlier").cast("double"))
    return out.agg(F.count("*").alias("n"), (F.abs(flagged - 0.05) < 0.01).alias("near_share"),
                   (F.count_if(F.col("planted") & (F.col("is_outlier") == 0)) == 0).alias("planted_found"))


# Simpson's rule over Student's density from 0 to |t|.
_STEPS = 2000


@query("check_ttest_p_values", f"""WITH {PANEL}, m AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg({c}) FILTER (label = 1) AS m1, avg({c}) FILTER (label = 0) AS m0, var_samp({c}) FILTER (label = 1) AS v1, "
    f"var_samp({c}) FILTER (label = 0) AS v0, count({c}) FILTER (label = 1) AS n1, count({c}) FILTER (label = 0) AS n0 FROM panel" for c in FEATURES)}),
t AS (SELECT feature, (n0 + n1 - 2)::DOUBLE AS dof, abs(m1 - m0) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0::DOUBLE / n0 + 1.0::DOUBLE / n1)) AS t FROM m),
s AS (SELECT feature, sum(CASE WHEN i = 0 OR i = {_STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
    * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2) - 0.5 * ln(dof * pi()) - (dof + 1) / 2 * ln(1 + (i * t / {_STEPS}) * (i * t / {_STEPS}) / dof))) * t / {_STEPS} / 3 AS half
  FROM t, range({_STEPS} + 1) AS r(i) GROUP BY feature, t)
SELECT feature, greatest(1 - 2 * half, 0.0) AS p_value FROM s""", {"p_value": 5})
def check_ttest_p_values(spark, sf):
    return profile.two_sample_tests(order_panel(spark, sf), FEATURES).select("feature", "p_value")


@query("column_difference", "SELECT unnest(['absent', 'other']) AS feature, unnest(['missing', 'missing']) AS side UNION ALL SELECT unnest(['c_name', 'c_phone']), 'extra'")
def column_difference(spark, sf):
    customer = table(spark, sf, "customer").selectExpr("c_custkey", "c_name", "c_acctbal", "c_nationkey", "c_name AS c_phone")
    missing, extra = stages.ColumnAligner(columns=["c_acctbal", "absent", "c_nationkey", "other"], keep=["c_custkey"]).report(customer)
    return spark.createDataFrame([(c, "missing") for c in missing] + [(c, "extra") for c in extra], "feature string, side string")


@query("selector_columns", f"""WITH {PANEL}, v AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, var_pop({c}) AS p, var_samp({c}) AS s FROM panel" for c in FEATURES)})
SELECT unnest(['entity', 'period', 'label', 'segment', 'nation']) AS feature UNION ALL
SELECT feature FROM (SELECT feature FROM v WHERE p > 0.01 ORDER BY s DESC, feature LIMIT 2)""")
def selector_columns(spark, sf):
    p = stored_panel(spark, sf)
    stage = stages.FeatureSelector(method="variance_threshold", max_features=2, label="label", keys=["entity", "period"])
    return spark.createDataFrame([(c,) for c in stage.fit(p).transform(p).columns], "feature string")


@query("threshold_methods", "SELECT unnest(['f1_optimal', 'precision_recall_curve', 'weighted', 'youden_j']) AS method, true AS same")
def threshold_methods(spark, sf):
    scored = materialize(scored_panel(spark, sf).select("label", "score"), "scored")
    rows = [(name, thresholds.optimize_threshold(scored, name) == fn(scored).first()["threshold"]) for name, fn in thresholds.METHODS.items()]
    return spark.createDataFrame(rows, "method string, same boolean")


@query("distinct_splits", "SELECT true AS all_different, true AS at_most_asked, true AS both_sides")
def distinct_splits(spark, sf):
    """Cuts that give the same rows count once."""
    splitter = split.StratifiedTemporalSplitter(n_splits=9, period="period", entity="entity", label="label", group_disjoint=False)
    found = splitter.cuts(stored_panel(spark, sf))
    sizes = [(s.n_train, s.n_val) for s in found]
    return spark.createDataFrame([(len(set(sizes)) == len(sizes), len(found) <= 9, bool(found) and all(a and b for a, b in sizes))],
                                 "all_different boolean, at_most_asked boolean, both_sides boolean")
