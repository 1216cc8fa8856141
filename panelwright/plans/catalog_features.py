"""Imputation, scaling, encoding, selection, splitting, resampling and neighbour queries."""

from pyspark.sql import functions as F

from panelwright.operators import encode, impute, neighbors, outliers, resample, scale, select, split
from panelwright.plans.panel import order_panel
from panelwright.plans.registry import PANEL, query, table
from panelwright.runtime import materialize

NUM = ["n_orders", "amt", "avg_amt", "max_amt", "acctbal"]


@query("impute_median", f"""WITH {PANEL} SELECT entity, period,
  coalesce(avg_amt, (SELECT quantile_cont(avg_amt, 0.5) FROM panel)) AS avg_amt,
  CAST(avg_amt IS NULL AS INTEGER) AS avg_amt_was_missing FROM panel""", {"avg_amt": 3})
def impute_median(spark, sf):
    p = order_panel(spark, sf).select("entity", "period", "avg_amt")
    return impute.fill(p, impute.numeric_fills(p, ["avg_amt"], "median"), impute.columns_with_nulls(p, ["avg_amt"]))


@query("impute_mean", f"""WITH {PANEL} SELECT entity, period,
  coalesce(avg_amt, (SELECT avg(avg_amt) FROM panel)) AS avg_amt FROM panel""", {"avg_amt": 2})
def impute_mean(spark, sf):
    p = order_panel(spark, sf).select("entity", "period", "avg_amt")
    return impute.fill(p, impute.numeric_fills(p, ["avg_amt"], "mean"))


@query("impute_mode", """WITH s AS (SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_brand END AS brand,
  CASE WHEN p_size % 3 <> 0 THEN p_type END AS kind FROM part)
SELECT p_partkey,
  coalesce(brand, (SELECT brand FROM s WHERE brand IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS brand,
  coalesce(kind, (SELECT kind FROM s WHERE kind IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS kind FROM s""")
def impute_mode(spark, sf):
    c = F.col
    p = table(spark, sf, "part").select("p_partkey", F.when(c("p_size") % 5 != 0, c("p_brand")).alias("brand"),
                                        F.when(c("p_size") % 3 != 0, c("p_type")).alias("kind"))
    return impute.fill(p, impute.categorical_fills(p, ["brand", "kind"]))


@query("impute_constant", f"""WITH {PANEL} SELECT entity, period, coalesce(avg_amt, 0.0) AS avg_amt,
  coalesce(CASE WHEN entity % 4 <> 0 THEN segment END, 'missing_value') AS segment FROM panel""", {"avg_amt": 3})
def impute_constant(spark, sf):
    p = order_panel(spark, sf).select("entity", "period", "avg_amt",
                                      F.when(F.col("entity") % 4 != 0, F.col("segment")).alias("segment"))
    return impute.fill(p, {**impute.numeric_fills(p, ["avg_amt"], "constant"),
                           **impute.categorical_fills(p, ["segment"], "constant")})


def _scaled_sql(a, w):
    cols = ", ".join(f"({c}::DOUBLE - (SELECT {a.format(c=c)} FROM panel)) / (SELECT {w.format(c=c)} FROM panel) AS {c}" for c in NUM)
    return f"WITH {PANEL} SELECT entity, period, {cols} FROM panel"


@query("scale_standard", _scaled_sql("avg({c})", "stddev_pop({c})"), {c: 5 for c in NUM})
def scale_standard(spark, sf):
    p = order_panel(spark, sf).select("entity", "period", *NUM)
    return scale.scale(p, scale.scaling_parameters(p, NUM, "standard"))


@query("scale_minmax", _scaled_sql("min({c})::DOUBLE", "(max({c}) - min({c}))::DOUBLE"), {c: 6 for c in NUM})
def scale_minmax(spark, sf):
    p = order_panel(spark, sf).select("entity", "period", *NUM)
    return scale.scale(p, scale.scaling_parameters(p, NUM, "minmax"))


_SMOOTH = "(1.0 / (1.0 + exp(-(n - 20.0) / 20.0)))"


@query("target_encode", f"""WITH {PANEL}, g AS (SELECT avg(label) AS g FROM panel),
  s AS (SELECT nation, count(*)::DOUBLE AS n, avg(label) AS m FROM panel GROUP BY 1)
SELECT entity, period, coalesce({_SMOOTH} * m + (1.0 - {_SMOOTH}) * g, g) AS nation_encoded
FROM panel LEFT JOIN s USING (nation), g""", {"nation_encoded": 7})
def target_encode(spark, sf):
    p = order_panel(spark, sf).select("entity", "period", "nation", "label")
    return encode.target_encode(p, "nation").select("entity", "period", "nation_encoded")


@query("target_encode_high_cardinality", f"""WITH {PANEL}, g AS (SELECT avg(label) AS g FROM panel),
  s AS (SELECT entity, count(*)::DOUBLE AS n, avg(label) AS m FROM panel GROUP BY 1)
SELECT entity, {_SMOOTH} * m + (1.0 - {_SMOOTH}) * g AS value FROM s, g""", {"value": 7})
def target_encode_high_cardinality(spark, sf):
    return encode.target_map(order_panel(spark, sf).select("entity", "label"), "entity")


@query("target_encode_oof", f"""WITH {PANEL}, g AS (SELECT avg(label) AS g FROM panel),
  p AS (SELECT *, CAST(entity % 5 AS INTEGER) AS fold FROM panel),
  own AS (SELECT nation, fold, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS s FROM p GROUP BY 1, 2),
  oth AS (SELECT nation, fold, sum(n) OVER (PARTITION BY nation) - n AS n, sum(s) OVER (PARTITION BY nation) - s AS s FROM own)
SELECT entity, period, CASE WHEN n > 0 THEN {_SMOOTH} * (s / n) + (1.0 - {_SMOOTH}) * g ELSE g END AS nation_encoded
FROM p JOIN oth USING (nation, fold), g""", {"nation_encoded": 7})
def target_encode_oof(spark, sf):
    p = order_panel(spark, sf).select("entity", "period", "nation", "label",
                                      (F.col("entity") % 5).cast("int").alias("fold"))
    return encode.target_encode_oof(p, "nation", "fold").select("entity", "period", "nation_encoded")


@query("label_encode", """WITH m AS (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS p_name_code
  FROM (SELECT DISTINCT p_name FROM part)) SELECT p_partkey, p_name_code FROM part JOIN m USING (p_name)""")
def label_encode(spark, sf):
    return encode.label_encode(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name").select(
        "p_partkey", "p_name_code")


@query("one_hot", """SELECT p_partkey, CAST(coalesce(k = 'ECONOMY', false) AS INTEGER) AS "kind_ECONOMY",
  CAST(coalesce(k = 'LARGE', false) AS INTEGER) AS "kind_LARGE", CAST(k IS NULL AS INTEGER) AS kind_nan
FROM (SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'LARGE') THEN p_type END AS k FROM part)""")
def one_hot(spark, sf):
    c = F.col("p_type")
    p = table(spark, sf, "part").select("p_partkey", F.when(c.isin("ECONOMY", "LARGE"), c).alias("kind"))
    return encode.one_hot(p, "kind", encode.categories(p, "kind"))


@query("variance_select", f"WITH {PANEL}, v AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, var_pop({c}::DOUBLE) AS var_pop, var_samp({c}::DOUBLE) AS var_samp FROM panel"
    for c in [*NUM, "label"]) + ") SELECT feature, var_pop / 1e6 AS var_pop, var_samp / 1e6 AS var_samp FROM v "
    "WHERE var_pop > 0.3 ORDER BY v.var_samp DESC, feature LIMIT 4", {"var_pop": 4, "var_samp": 4})
def variance_select(spark, sf):
    v = select.variance_selection(order_panel(spark, sf), [*NUM, "label"], 4, 0.3)
    return v.withColumns({c: F.col(c) / 1e6 for c in ("var_pop", "var_samp")})


# ---- splits ------------------------------------------------------------------------------------

_CUTS = f"""WITH {PANEL}, f AS (SELECT *, min(period) OVER (PARTITION BY entity) AS first FROM panel),
  cuts AS (SELECT DISTINCT period AS cut FROM panel)"""


@query("split_candidates", _CUTS + """ SELECT cut, count(*) FILTER (WHERE period <= cut - 1) AS n_train,
  count(*) FILTER (WHERE period > cut AND first > cut - 1) AS n_val,
  avg(label) FILTER (WHERE period > cut AND first > cut - 1) AS val_rate,
  abs(avg(label) FILTER (WHERE period > cut AND first > cut - 1) - (SELECT avg(label) FROM panel)) AS prevalence_gap
FROM f, cuts GROUP BY 1""", {"val_rate": 6, "prevalence_gap": 6})
def split_candidates(spark, sf):
    return split.candidate_table(order_panel(spark, sf), "entity", "period", "label")


@query("split_roles", _CUTS + """, c AS (SELECT cut, count(*) FILTER (WHERE period <= cut - 1) AS n_train,
   count(*) FILTER (WHERE period > cut AND first > cut - 1) AS n_val,
   abs(avg(label) FILTER (WHERE period > cut AND first > cut - 1) - (SELECT avg(label) FROM panel)) AS gap
  FROM f, cuts GROUP BY 1),
 wanted AS (SELECT DISTINCT CAST(floor(quantile_cont(cut, 0.2)) AS INTEGER) AS cut FROM
   (SELECT cut FROM cuts WHERE cut > (SELECT min(cut) FROM cuts) AND cut < (SELECT max(cut) FROM cuts))),
 near AS (SELECT w.cut AS wanted, c.cut, c.gap, CASE c.cut - w.cut WHEN 0 THEN 0 WHEN -1 THEN 1 WHEN 1 THEN 2 WHEN -2 THEN 3
   ELSE 4 END AS pref FROM wanted w JOIN c ON abs(c.cut - w.cut) <= 2 AND n_train > 0 AND n_val > 0),
 best AS (SELECT cut FROM near ORDER BY gap, pref LIMIT 1)
SELECT entity, period, CASE WHEN period <= cut - 1 THEN 'train' WHEN period > cut AND first > cut - 1 THEN 'val' END AS role
FROM f, best""")
def split_roles(spark, sf):
    p = order_panel(spark, sf).select("entity", "period", "label")
    chosen = split.StratifiedTemporalSplitter(1, period="period", entity="entity", label="label").cuts(p)[0]
    tagged = split.with_first_period(p, "entity", "period")
    role = split.roles(F.col("period"), F.col("_first"), chosen.cut, chosen.gap)
    return tagged.select("entity", "period", role.alias("role"))


@query("split_last_periods", _CUTS + """, k AS (SELECT cut FROM (SELECT cut, row_number() OVER (ORDER BY cut) - 1 AS i,
  count(*) OVER () AS n FROM cuts) WHERE i = floor(n * 0.8::DOUBLE))
SELECT entity, period, CASE WHEN period <= cut - 1 THEN 'train' WHEN period > cut THEN 'val' END AS role FROM panel, k""")
def split_last_periods(spark, sf):
    return split.last_periods_role(order_panel(spark, sf).select("entity", "period"), "period", 1)


@query("split_chronological", f"""WITH {PANEL}, r AS (SELECT entity, period, row_number() OVER (ORDER BY period, entity) AS i,
  count(*) OVER () AS n FROM panel)
SELECT entity, period, CASE WHEN i <= floor(n * 0.8::DOUBLE) - 1 THEN 'train' WHEN i > floor(n * 0.8::DOUBLE) THEN 'val' END AS role FROM r""")
def split_chronological(spark, sf):
    return split.chronological_role(materialize(order_panel(spark, sf).select("entity", "period"), "panel"), ["period", "entity"])


@query("split_anti_join", f"""WITH {PANEL} SELECT entity, period FROM panel WHERE period > 1998
  AND entity NOT IN (SELECT entity FROM panel WHERE period <= 1997)""")
def split_anti_join(spark, sf):
    p = order_panel(spark, sf).select("entity", "period")
    return split.without_entities(p.where("period > 1998"), p.where("period <= 1997"), "entity")


@query("split_overlap", f"""WITH {PANEL} SELECT DISTINCT entity FROM panel WHERE period <= 1996
  INTERSECT SELECT entity FROM panel WHERE period >= 2000""")
def split_overlap(spark, sf):
    p = order_panel(spark, sf).select("entity", "period")
    return split.entity_overlap(p.where("period <= 1996"), p.where("period >= 2000"), "entity")


@query("fold_union", f"""WITH {PANEL} SELECT CAST(entity % 3 AS INTEGER) AS fold, count(*) AS n,
  CAST(sum(label) AS BIGINT) AS positives FROM panel GROUP BY 1""")
def fold_union(spark, sf):
    p = materialize(order_panel(spark, sf).select("entity", "label"))          # one evaluation, three filters
    parts = [p.where(F.col("entity") % 3 == i).withColumn("fold", F.lit(i)) for i in range(3)]
    pooled = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return pooled.groupBy("fold").agg(F.count("*").alias("n"), F.sum("label").alias("positives"))


# ---- resampling, neighbours, outlier forest -----------------------------------------------------

@query("class_weights", f"""WITH {PANEL}, c AS (SELECT count(*)::DOUBLE AS n, sum(label)::DOUBLE AS p FROM panel)
SELECT label, count(*) AS rows_n, min(CASE WHEN label = 1 THEN n / (2 * p) ELSE n / (2 * (n - p)) END) AS weight
FROM panel, c GROUP BY 1""", {"weight": 6})
def class_weights(spark, sf):
    return resample.class_weights(order_panel(spark, sf).select("label")).groupBy("label").agg(
        F.count("*").alias("rows_n"), F.min("weight").alias("weight"))


@query("nearest_neighbors", """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
  d AS (SELECT a.vec_id, b.vec_id AS neighbor, list_distance(a.x, b.x) AS distance
        FROM e a JOIN e b ON a.vec_id <> b.vec_id),
  r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor) AS rank FROM d)
SELECT vec_id, neighbor, distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""", {"distance": 6})
def nearest_neighbors(spark, sf):
    return neighbors.nearest_neighbors(table(spark, sf, "embeddings"), "vec_id", "embedding", 5)


@query("smote_counts", """SELECT CAST(is_new AS INTEGER) AS is_synthetic, CAST(label AS INTEGER) AS label, n FROM (
  SELECT 0 AS is_new, CAST(label < 2 AS INTEGER) AS label, count(*) AS n FROM embeddings GROUP BY 2
  UNION ALL SELECT 1, 1, CAST(floor(0.5::DOUBLE * count(*) FILTER (WHERE label >= 2) - count(*) FILTER (WHERE label < 2)) AS BIGINT)
  FROM embeddings)""")
def smote_counts(spark, sf):
    return smote_rows(spark, sf).groupBy("is_synthetic", "label").agg(F.count("*").alias("n"))


def smote_rows(spark, sf):
    e = table(spark, sf, "embeddings")
    size = e.agg(F.max(F.size("embedding"))).first()[0] or 0
    names = [f"x{i}" for i in range(size)]
    e = e.select("vec_id", (F.col("label") < 2).cast("int").alias("label"), *[F.col("embedding")[i].alias(c) for i, c in enumerate(names)])
    return resample.smote(e, names, "vec_id", ratio=0.5)


@query("isolation_outliers")
def isolation_outliers(spark, sf):
    p = table(spark, sf, "lineitem").withColumn("id", F.col("l_orderkey") * 8 + F.col("l_linenumber")).select(
        "id", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    out = outliers.isolation_outliers(p, "id", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return out.groupBy("is_outlier").agg(F.count("*").alias("n"), F.avg("anomaly").alias("mean_anomaly"),
                                         F.avg("l_extendedprice").alias("mean_price"))
