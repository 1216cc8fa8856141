"""Global order in any type, hot keys, Gram matrices, drift, bootstrap, information and advanced imputation against plain Python."""

import datetime
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelwright.functions import rules
from panelwright.functions.sql import register_sql_functions
from panelwright.operators import bootstrap, chained, drift, gram, impute, metrics, neighbors, prefix, profile, quantiles, select, split
from panelwright.plans.panel import order_panel
from panelwright.runtime import at_most, hot_keys, lookup_join, materialize, new_path
from panelwright.sources import readers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, digits=9):
    return sorted((tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


# ---- global order

LONG = "customer-of-the-north-"                                       # 22 bytes that all keys share


@pytest.mark.parametrize("kind", ["text", "date", "decimal", "pair"])
def test_ranges_are_even_in_any_type(spark, kind):
    types = {"text": "string", "date": "date", "decimal": "double", "pair": "string"}
    make = {"text": lambda i: f"{LONG}{i:07d}", "date": lambda i: datetime.date(1000, 1, 1) + datetime.timedelta(days=i),
            "decimal": lambda i: None if i % 500 == 0 else i / 4.0, "pair": lambda i: f"{LONG}{i % 3}"}[kind]
    data = [(make(i), i) for i in random.Random(3).sample(range(20_000), 20_000)]
    df = spark.createDataFrame(data, f"k {types[kind]}, n long")
    df = materialize(df.withColumn("k", F.col("k").cast("decimal(20,2)")) if kind == "decimal" else df)
    order = ["k", "n"] if kind == "pair" else ["k"]
    ranged = prefix.in_ranges(df, order, 20_000, 500)
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert len(sizes) >= 30 and max(sizes) <= 2 * 500
    edges = ranged.groupBy("_range").agg(F.min(F.struct(*order)).alias("lo"), F.max(F.struct(*order)).alias("hi"))
    before = F.lag("hi").over(Window.orderBy("_range"))
    assert edges.withColumn("before", before).where("before > lo").count() == 0


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_over_several_levels(spark, descending):
    data = [(g, f"{LONG}{i:05d}" if i else None, i % 5 if i % 7 else None) for g in ("x", None) for i in range(700)]
    hist = materialize(spark.createDataFrame(data, "g string, `k.k` string, n int"))
    one, many = (prefix.running_sums(hist, "k.k", {"cum": "n"}, by=["g"], descending=descending, rows_per_range=r) for r in (10_000, 9))
    assert rows(one) == rows(many.select([f"`{c}`" for c in one.columns])) and many.count() == 1400


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("n", [0, 1, 2, 3, 6, 7, 8, 20])
def test_cutoff_places_null_last(spark, descending, n):
    data = [(None, i) for i in range(5)] + [(f"{LONG}{v}", 10 + i) for i, v in enumerate("bab")]
    df = spark.createDataFrame(data, "k string, id int")
    cut = prefix.rank_cutoff(df, [("k", descending), ("id", False)], n, rows_per_range=2)
    k = F.col("k").desc_nulls_last() if descending else F.col("k").asc_nulls_last()
    want = {r["id"] for r in df.orderBy(k, "id").limit(n).collect()}
    assert (set() if cut is None else {r["id"] for r in df.where(cut).collect()}) == want


def test_chronological_split_counts_dated_rows(spark):
    known = [(y, e) for y in range(10) for e in range(7)]
    for empty in (0, 30, 300):
        df = spark.createDataFrame([*known, *[(None, 100 + i) for i in range(empty)]], "year int, id int")
        got = Counter(r["role"] for r in split.chronological_role(df, ["year", "id"], 0.2, 1).collect())
        assert (got["train"], got["val"], got[None]) == (55, 14, 1 + empty)


# ---- joins with hot keys

def test_hot_keys_are_found_and_spread(spark):
    left = spark.range(0, 60_000, 1, 12).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("k"), F.lit("same").alias("v"))
    right = spark.range(70_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    hot = hot_keys(left, ["k"], share=50, least=100)
    want = {r[0] for r in spark.createDataFrame([(7,), (None,)], "k long").select(F.xxhash64("k")).collect()}
    assert set(hot) == want                                           # the key of a third, and NULL
    for how in ("left", "inner", "left_semi", "left_anti"):
        a = lookup_join(left, right, ["k"], how)
        b = lookup_join(left, right, ["k"], how, broadcast_rows=10, share=50, least=100)
        assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    joined = lookup_join(left, right, ["k"], "inner", broadcast_rows=10, share=50, least=100)
    tasks = joined.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 4                                                 # equal rows of one key, in many tasks
    assert plan(joined).count("Exchange hashpartitioning(k") <= 2


def test_bytes_decide_a_broadcast(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert at_most(df, 100) and not at_most(df, 99) and not at_most(df, 100, size=50_000)
    stored = materialize(df)
    assert at_most(stored, 100) and not at_most(stored, 99)


# ---- quantiles

@pytest.mark.parametrize("small,literals", [(10 ** 9, 600), (0, 600), (0, 0)])
def test_quantiles_with_null_groups_and_any_names(spark, small, literals):
    names = ["a", "b", "n", "v", "lo", "hi", "cum", "cnt"]
    rnd = random.Random(1)
    data = [(rnd.choice(["x", None]), rnd.choice([1, 2, None]), *[rnd.choice([None, float("nan"), rnd.randint(0, 9) / 2]) for _ in names], None) for _ in range(400)]
    df = spark.createDataFrame(data, "k string, j int, " + ", ".join(f"{c} double" for c in names) + ", prob double")
    options = {"small_cells": small, "accuracy": 20, "literals": literals, "rows_per_range": 5}
    for by, cols in ((["k", "j"], [*names, "prob"]), (["a", "n"], ["b", "v", "lo", "prob"]), ([], [*names, "prob"])):
        clean = df.select(*[rules.number(c).alias(c) if c not in ("k", "j") else c for c in df.columns]) if by == ["a", "n"] else df
        got = quantiles.exact_quantiles(clean, cols, [0.0, 0.3, 0.5, 1.0], by, **options)
        frame = pd.DataFrame([tuple(r) for r in clean.collect()], columns=clean.columns)
        want = []
        for key, part in (frame.groupby(by, dropna=False) if by else [((), frame)]):
            key = tuple(None if isinstance(k, float) and math.isnan(k) else int(k) if b == "j" else k if isinstance(k, str) else float(k) for b, k in zip(by, key, strict=True))
            for c in cols:
                x = part[c].astype(float).dropna()
                want += [(*key, c, p, float(x.quantile(p)) if len(x) else None) for p in (0.0, 0.3, 0.5, 1.0)]
        assert rows(got) == sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in want), key=repr)
    with pytest.raises(ValueError):
        quantiles.exact_quantiles(df.withColumnRenamed("k", "feature"), ["a"], [0.5], ["feature"])


def test_statistics_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a double, g string")
    assert rows(profile.describe(df, ["a"])) == [("a", 0, None, None, None, None, None, None, None)]
    assert profile.describe_by(df, "g", ["a"]).count() == 0


# ---- missing scores and values

def test_nan_scores_count_in_no_metric(spark):
    whole = [(1, 0.9), (0, 0.2), (1, 0.0), (0, 0.45)]
    odd = [(1, float("nan")), (0, None), (None, 0.05), (None, float("nan"))]
    a, b = (spark.createDataFrame(d, "label int, score double") for d in (whole, whole + odd))
    for f in (metrics.brier, metrics.calibration_error, metrics.calibration_curve):
        assert rows(f(a)) == rows(f(b))


def test_sql_bands_equal_the_column_rule(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([(None,), *[(i / 20,) for i in range(21)]], "p double")
    assert df.select(F.expr("confidence_band(p)").alias("s"), rules.confidence_band(F.col("p")).alias("c")).where("not (s <=> c)").count() == 0
    assert df.where("confidence_band(p) is null").count() == 1


def test_crosstab_loses_no_value(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "z"), ("b", "x"), ("b", None)], "k string, v string")
    got = profile.crosstab(df, "k", "v", ["x", "y"], other="rest").orderBy("k").collect()
    assert [(r["x"], r["y"], r["rest"], round(r["x_share"], 3), round(r["rest_share"], 3)) for r in got] == [(1, 1, 1, 0.333, 0.333), (1, 0, 0, 1.0, 0.0)]
    with pytest.raises(Exception, match="outside the list"):
        profile.crosstab(df, "k", "v", ["x", "y"]).collect()
    assert profile.crosstab(df, "k", "v", ["x", "y", "z"]).count() == 2


def test_small_null_rates_hit_some_rows(spark):
    df = rules.inject_nulls(spark.range(2_000_000).withColumn("v", F.lit(1.0)), ["id"], {("v",): 5e-5})
    assert 60 <= df.where("v is null").count() <= 140


def test_filters_reach_the_scan_and_drop_nan(spark, sf):
    li = readers.load_data(spark, f"{sf}/lineitem.parquet", where="l_quantity >= 10")
    assert "GreaterThanOrEqual(l_quantity,10.0)" in plan(li)
    assert "PushedFilters" in plan(order_panel(spark, sf).where("acctbal > 100")) and "GreaterThan(c_acctbal,100.0)" in plan(order_panel(spark, sf).where("acctbal > 100"))
    path = new_path(spark, "nan-filter")
    spark.createDataFrame([(1, 5.0), (2, float("nan")), (3, None), (4, 20.0)], "id int, x double").write.parquet(path)
    assert [r["id"] for r in readers.read_parquet(spark, path, "x >= 10").collect()] == [4]
    assert [r["id"] for r in readers.load_data(spark, path, where=F.col("x") < 10).collect()] == [1]


# ---- Gram matrix

def test_gram_equals_pairwise_complete_correlations(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 11)) * 10.0 ** np.arange(11) + 1e6
    x[:, 3] = x[:, 2] * 0.5 + rng.normal(size=300)
    x[:, 7] = 4.25
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 10] = np.nan
    cols = [f"c{i}" for i in range(11)]
    frame = pd.DataFrame(x, columns=cols)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in cols)).repartition(7)
    want = frame.corr()
    for block, fan_in in ((256, 32), (4, 2)):
        got = {(r["a"], r["b"]): r for r in gram.gram_correlations(df, cols, block, fan_in).collect()}
        assert len(got) == 55
        for (a, b), r in got.items():
            both = frame[[a, b]].dropna()
            w = want.loc[a, b]
            assert r["n"] == len(both)
            assert (r["r"] is None) if math.isnan(w) or both[a].std() == 0 or both[b].std() == 0 else abs(r["r"] - w) < 1e-8
    assert gram.correlation_filter(df, cols, 0.9, block=4) == [c for c in cols if c != ("c3" if abs(want.loc["c2", "c3"]) > 0.9 else None)]
    assert gram.gram_correlations(df.limit(0), cols).count() == 0


def test_gram_plan_does_not_grow_with_the_columns(spark):
    rng = np.random.default_rng(5)
    wide = spark.createDataFrame([(rng.normal(size=500).tolist(),) for _ in range(40)], "x array<double>")
    wide = wide.select(*[F.col("x")[i].alias(f"c{i}") for i in range(500)])
    pairs = profile.correlation_pairs(wide, wide.columns)
    few = gram.gram_correlations(wide, wide.columns[:3])
    nodes = [sum("- " in line for line in plan(d).splitlines()) for d in (pairs, few)]
    assert abs(nodes[0] - nodes[1]) <= 1
    assert pairs.count() == 500 * 499 // 2


# ---- drift, bootstrap, information

@pytest.mark.parametrize("per", [250_000, 7])
def test_drift_equals_plain_figures(spark, per):
    rnd = random.Random(2)
    a = [(rnd.choice([None, float("nan"), rnd.randint(0, 30) / 2]), rnd.gauss(0, 1), None) for _ in range(300)]
    b = [(rnd.choice([None, rnd.randint(5, 40) / 2]), rnd.gauss(0.5, 1), None) for _ in range(170)]
    one, two = (spark.createDataFrame(d, "x double, y double, z double") for d in (a, b))
    got = {r["feature"]: r for r in drift.numeric_drift(one, two, ["x", "y", "z"], rows_per_range=per).collect()}
    assert set(got) == {"x", "y"}
    for i, c in enumerate("xy"):
        p, q = (sorted(r[i] for r in d if r[i] is not None and not math.isnan(r[i])) for d in (a, b))
        points = sorted({*p, *q})
        ks = max(abs(np.searchsorted(p, v, "right") / len(p) - np.searchsorted(q, v, "right") / len(q)) for v in points)
        bins = [min(9, int(np.searchsorted(p, v) / len(p) * 10 + 1e-12)) for v in (*p, *q)]
        ca, cb = Counter(bins[:len(p)]), Counter(bins[len(p):])
        psi = 0.0
        for k in {*ca, *cb}:
            u, w = (ca[k] + 0.5) / (len(p) + 5), (cb[k] + 0.5) / (len(q) + 5)
            psi += (u - w) * math.log(u / w)
        assert abs(got[c]["ks"] - ks) < 1e-12 and abs(got[c]["psi"] - psi) < 1e-9
        assert 0 <= got[c]["p_value"] < 1e-3 and got[c]["level"] == "major"
    same = drift.numeric_drift(one, one, ["x"]).first()
    assert same["ks"] == 0.0 and same["p_value"] == 1.0 and same["level"] == "none"
    cats = drift.category_drift(one.selectExpr("'a' c"), two.selectExpr("if(y > 0, 'a', null) c"), ["c"]).first()
    assert cats["n_categories"] == 2 and 0 < cats["unseen"] < 1 and cats["level"] == "major"


def poisson_by_hand(key, replicate, seed):
    digest = hashlib.md5(f"{seed}:{(replicate - 1) // 8}:{key}".encode()).hexdigest()
    draw = int(digest[4 * ((replicate - 1) % 8):][:4], 16)
    total, term, k = 0.0, math.exp(-1), 0
    while True:
        total += term
        if draw < math.floor(total * 65536) or k >= 10:
            return k
        k += 1
        term /= k


@pytest.mark.parametrize("per", [250_000, 6])
def test_replicates_one_by_one(spark, per):
    rnd = random.Random(8)
    data = [(i, int(rnd.random() < 0.4), round(rnd.random(), 1)) for i in range(120)] + [(900, None, 0.5), (901, 1, None), (902, 0, float("nan"))]
    df = spark.createDataFrame(data, "id int, label int, score double")
    got = {r["replicate"]: r for r in bootstrap.bootstrap_replicates(df, ["id"], replicates=11, seed=5, rows_per_range=per).collect()}
    assert set(got) == set(range(12))
    for r, row in got.items():
        drawn = [(y, s) for i, y, s in data[:120] for _ in range(poisson_by_hand(i, r, 5) if r else 1)]
        again = metrics.ranking_metrics(spark.createDataFrame(drawn, "label int, score double")).first()
        assert abs(row["roc_auc"] - again["roc_auc"]) < 1e-9 and abs(row["pr_auc"] - again["pr_auc"]) < 1e-9
    told = {r["metric"]: r for r in bootstrap.bootstrap_intervals(df, ["id"], replicates=40).collect()}
    assert all(t["low"] < t["high"] and t["std"] > 0 for t in told.values())
    weights = spark.range(20_000).select(bootstrap.poisson_weights(["id"], 3, 1)[2].alias("w")).agg(F.avg("w"), F.var_pop("w")).first()
    assert abs(weights[0] - 1) < 0.03 and abs(weights[1] - 1) < 0.05


def test_information_finds_the_telling_column(spark):
    rnd = random.Random(6)
    data = [(rnd.random(), rnd.choice([None, float("nan"), 1.0, 2.0]), 3.0, None) for _ in range(2000)]
    df = spark.createDataFrame([(*r, int(r[0] > 0.5)) for r in data], "told double, noise double, flat double, empty double, label int")
    got = {r["feature"]: r for r in select.mutual_information(df, ["told", "noise", "flat", "empty"]).collect()}
    assert set(got) == {"told", "noise", "flat"} and got["told"]["mi"] > 0.6 and abs(got["noise"]["mi"]) < 0.01 and got["flat"]["mi"] == 0
    assert got["noise"]["n"] == sum(r[1] in (1.0, 2.0) for r in data)
    assert select.select_features(df, ["noise", "told", "flat"], "mutual_information", max_features=1) == ["told"]


# ---- imputation

def test_chained_regressions_recover_a_plane(spark):
    rng = np.random.default_rng(7)
    a, b = rng.normal(size=400), rng.normal(size=400)
    x = np.stack([a, b, 2 * a - 3 * b + 5, a + b, np.full(400, np.nan), np.full(400, 2.0)], axis=1)
    full = x.copy()
    x[rng.random(400) < 0.2, 2] = np.nan
    x[(rng.random(400) < 0.2) & ~np.isnan(x[:, 2]), 3] = np.nan
    cols = list("abcdef")
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, " + ", ".join(f"{c} double" for c in cols)).repartition(5)
    fill = chained.chained_fill(df, cols, rounds=30, tolerance=1e-9)
    again = chained.ChainedFill.of(fill.state())
    assert again == fill and fill.columns == list("abcdf")
    got = chained.apply_chained(df, again).orderBy("id").collect()
    assert max(abs(r["c"] - full[r["id"], 2]) for r in got) < 1e-4 and max(abs(r["d"] - full[r["id"], 3]) for r in got) < 1e-4
    assert all(r["a"] == x[r["id"], 0] for r in got)
    new = chained.apply_chained(spark.createDataFrame([(None, 1.0)], "a double, b double"), fill).first()
    assert new["b"] == 1.0 and abs(new["a"] - a.mean()) < 1e-9


def test_nearest_fill_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(90, 4)), 1)
    x[rng.random(x.shape) < 0.25] = np.nan
    x[5] = np.nan
    cols = list("abcd")
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"{c} double" for c in cols))
    for block in (4096, 16):
        got = {r["id"]: r for r in chained.nearest_fill(df, "id", cols, 3, block).collect()}
        assert len(got) == 90
        for i in range(90):
            for j, c in enumerate(cols):
                if not math.isnan(x[i, j]):
                    assert got[i][c] == x[i, j]
                    continue
                near = []
                for o in range(90):
                    both = ~np.isnan(x[i]) & ~np.isnan(x[o])
                    if o != i and both.any() and not math.isnan(x[o, j]):
                        near.append((math.sqrt(sum((x[i, t] - x[o, t]) ** 2 for t in range(4) if both[t]) * 4 / both.sum()), o))
                want = [x[o, j] for _, o in sorted(near)[:3]]
                assert (got[i][c] is None or math.isnan(got[i][c])) if not want else abs(got[i][c] - sum(want) / len(want)) < 1e-9


def test_sparse_columns_and_stage(spark):
    from panelwright.ml.stages import MissingValueHandler

    data = [(i, float(i) if i % 4 == 0 else None, 2.0 * i if i % 5 else None, float(i), "t" if i % 3 == 0 else None) for i in range(200)]
    df = spark.createDataFrame(data, "id int, rare double, y double, x double, text string")
    assert impute.sparse_columns(df, ["rare", "y", "x", "text"], 0.5) == ["rare", "text"]
    model = MissingValueHandler(exclude=["id"], advanced="iterative", drop_threshold=0.5).fit(df)
    out = model.transform(df)
    assert set(out.columns) == {"id", "y", "x", "y_was_missing"}
    assert max(abs(r["y"] - 2 * r["x"]) for r in out.collect()) < 1e-6 and out.agg(F.sum("y_was_missing")).first()[0] == 40


# ---- scoring

def test_one_pass_answers_equal_two(spark, sf):
    from panelwright.plans import catalog_model as M
    from panelwright.plans.scoring import answer

    events = M.event_requests(spark.read.parquet(f"{sf}/events.parquet")).withColumn("k", F.when(F.col("event_id") % 7 != 0, F.col("k")))
    plain = lambda df: M.event_scorer(df)
    for rules in (M.EVENT_RULES, []):
        one, two = (answer(events, s, ["event_id"], 0.6, "v1", rules, required=["k"], with_violations=True).drop("timestamp") for s in (M.event_scorer, plain))
        assert one.columns == two.columns and one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0
    assert plan(one).count("FileScan") == 1 and plan(two).count("FileScan") == 2


# ---- neighbours

def test_incomplete_vectors_take_no_part(spark):
    rng = np.random.default_rng(2)
    data = [(i, rng.normal(size=3).tolist()) for i in range(40)] + [(50, None), (51, [1.0, None, 2.0]), (52, [float("nan"), 0.0, 0.0]), (53, []), (None, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(data, "id long, x array<double>")
    for f in (neighbors.nearest_neighbors, neighbors.bucketed_neighbors):
        got = f(df, "id", "x", 3)
        assert {r["id"] for r in got.collect()} | {r["neighbor"] for r in got.collect()} == set(range(40))
        assert f(df.limit(0), "id", "x").count() == 0


def test_buckets_find_the_neighbours_of_clusters(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 32)) * 5
    x = np.concatenate([c + rng.normal(size=(30, 32)) * 0.2 for c in centres] + [np.repeat(centres[:1], 25, axis=0), rng.normal(size=(20, 32)) * 5])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    got = neighbors.bucketed_neighbors(df, "id", "x", 4, block=64)
    found = {}
    for r in got.collect():
        assert abs(r["distance"] - math.dist(x[r["id"]], x[r["neighbor"]])) < 1e-9
        found.setdefault(r["id"], {})[r["rank"]] = (r["neighbor"], r["certified"])
    hits = 0
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        hits += len(set(np.lexsort((np.arange(len(x)), d))[:4].tolist()) & {n for n, _ in found.get(i, {}).values()})
    assert hits >= 0.95 * 4 * len(x)
    assert sum(c for f in found.values() for _, c in f.values()) > 0.9 * 4 * len(x)
    # A row of a cluster meets its own cluster, not the table.
    reach = neighbors.certified_distance(1.0, 6, 8, 0.05)
    assert 0 < neighbors.collision(reach, 1.0) ** 6 < 1 and abs((1 - neighbors.collision(reach, 1.0) ** 6) ** 8 - 0.05) < 1e-6


# ---- stream

def test_stream_latency_percentiles(spark, tmp_path):
    from panelwright.streaming import scoring as S

    rnd = random.Random(3)
    base = datetime.datetime(2024, 1, 1)
    data = [(base + datetime.timedelta(minutes=rnd.randint(0, 299)), rnd.expovariate(0.1), "k") for _ in range(3000)]
    path = str(tmp_path / "in")
    data.sort()
    for at in range(0, 3000, 750):                                    # files in the order of time, half a window apart
        spark.createDataFrame(data[at:at + 750], "ts timestamp, ms double, kind string").coalesce(1).write.mode("append").parquet(path)
    stream = S.read_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    S.run_to_table(S.health_counters(stream, "ts", latency="ms"), str(tmp_path / "out"), str(tmp_path / "check"))
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert got
    hours = {}
    for ts, ms, _ in data:
        hours.setdefault(ts.hour, []).append(ms)
    for r in got:
        own = sorted(hours[r["window_start"].hour])
        assert r["processed"] == len(own) and abs(r["latency_total"] - sum(own)) < 1e-6
        for name, p in S.LATENCIES.items():
            assert abs(np.searchsorted(own, r[name], "right") / len(own) - p) < 0.02


def test_nearest_fill_writes_no_copies_of_its_rows(spark, monkeypatch):
    """Many blocks, all patterns of gaps and many equal rows; no row is shuffled for a pair of blocks."""
    rng = np.random.default_rng(12)
    x = np.round(rng.normal(size=(700, 3)), 1)
    x[rng.random(x.shape) < 0.2] = np.nan
    x[600:] = [1.0, 2.0, 3.0]
    x[600:650, 1] = np.nan
    cols = list("abc")
    df = spark.createDataFrame([(i, *(None if math.isnan(v) else float(v) for v in r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    want = {}
    for i in range(len(x)):
        for j, c in enumerate(cols):
            if math.isnan(x[i, j]):
                both = ~np.isnan(x[i]) & ~np.isnan(x)
                with np.errstate(all="ignore"):
                    far = np.sqrt(np.where(both, (x[i] - x) ** 2, 0.0).sum(axis=1) * 3 / both.sum(axis=1))
                far[~both.any(axis=1) | np.isnan(x[:, j])] = np.inf
                pick = [o for o in np.lexsort((np.arange(len(x)), far))[:4] if far[o] < np.inf]
                want[i, c] = x[pick, j].mean() if pick else None
    made = []
    monkeypatch.setattr(chained.blocks, "meet", lambda *a, f=chained.blocks.meet: made.append(f(*a)) or made[-1])
    got = {r["id"]: r for r in chained.nearest_fill(df, "id", cols, 4, block=4).collect()}
    assert len(got) == len(x)
    for (i, c), v in want.items():
        assert (got[i][c] is None) == (v is None) and (v is None or abs(got[i][c] - v) < 1e-9)
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan


def test_stored_blocks_find_the_same_neighbours(spark, monkeypatch):
    """Rows without clusters, a crowd of equal rows, far rows and single-precision vectors; no row is copied for a pair of blocks."""
    rng = np.random.default_rng(21)
    x = np.concatenate([rng.normal(size=(260, 6)), np.ones((30, 6)), rng.normal(size=(20, 6)) * 1e6, rng.normal(size=(60, 6)) * 1e-3 + 1e5])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    made = []
    monkeypatch.setattr(neighbors.blocks, "meet", lambda *a, f=neighbors.blocks.meet: made.append(f(*a)) or made[-1])
    for kind in ("double", "float"):
        df = spark.createDataFrame(rows, "id long, x array<double>").select("id", F.col("x").cast(f"array<{kind}>").alias("x")).repartition(3)
        y = x.astype(np.float32).astype(float) if kind == "float" else x
        made.clear()
        got = {(r["id"], r["rank"]): (r["neighbor"], r["distance"]) for r in neighbors.nearest_neighbors(df, "id", "x", 4, block=16, copies=0, few=0).collect()}
        assert len(made) == 1 and len(got) == 4 * len(x)
        for i in range(len(x)):
            d = np.sqrt(((y - y[i]) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((np.arange(len(x)), d)) if j != i][:4]
            assert [got[i, r + 1][0] for r in range(4)] == order and np.allclose([got[i, r + 1][1] for r in range(4)], d[order], rtol=1e-12, atol=0)
        plan = made[0]._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and "Exchange" not in plan
    near = df.where("id < 290")
    sent = neighbors.bucketed_neighbors(near, "id", "x", 4, block=16, copies=1e9)
    assert len(made) == 1
    met = neighbors.bucketed_neighbors(near, "id", "x", 4, block=16, copies=0, few=0)
    assert len(made) > 2
    assert sent.count() == met.count() > 4 * 280 and sent.exceptAll(met).count() == 0
