"""The paths meant for large or skewed data, forced by small limits, against the simple ones."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelwright.operators import labelling, metrics, neighbors, outliers, prefix, quantiles, resample, split, temporal, thresholds
from panelwright.plans.panel import order_panel, scored_panel
from panelwright.runtime import lookup_join, materialize


@pytest.fixture(scope="module")
def scored(spark, sf):
    return materialize(scored_panel(spark, sf), "scored")


def rows(df, digits=9):
    return sorted(tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_running_sums_over_ranges(spark, scored):
    hist = materialize(metrics.score_histogram(scored, by=["segment"]), "h")
    for by in ([], ["segment"]):
        h = hist if by else materialize(metrics.score_histogram(scored), "h")
        for down in (False, True):
            one = prefix.running_sums(h, "score", {"a": "pos", "b": "neg"}, by, down)
            many = prefix.running_sums(h, "score", {"a": "pos", "b": "neg"}, by, down, rows_per_range=7)
            assert rows(one) == rows(many.select(one.columns))


def test_ranking_metrics_over_ranges(scored):
    assert rows(metrics.ranking_metrics(scored, by=["nation"])) == rows(metrics.ranking_metrics(scored, by=["nation"], rows_per_range=3))
    for method in (thresholds.pr_threshold, thresholds.youden_threshold):
        assert method(scored).first()["threshold"] == method(scored, rows_per_range=5).first()["threshold"]


@pytest.mark.parametrize("n", [0, 17, 10_000])
def test_rank_cutoff_takes_exactly_n(spark, n):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 3).alias("v"))     # a third of the rows tie
    cut = prefix.rank_cutoff(df, [("v", True), ("id", False)], n, rows_per_range=11)
    got = 0 if cut is None else df.where(cut).count()
    assert got == min(n, 500)
    want = {r["id"] for r in df.orderBy(F.desc("v"), "id").limit(n).collect()}
    assert (set() if cut is None else {r["id"] for r in df.where(cut).collect()}) == want


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_by_brackets_are_exact(spark, by):
    df = spark.range(30_000).select(
        (F.col("id") % 2).alias("g"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("a"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") % 100).alias("b"),       # one value holds a third
        F.when(F.col("id") % 7 != 0, F.col("id").cast("double")).alias("c"))
    probs = [0.0, 0.01, 0.25, 0.5, 0.93, 1.0]
    simple = quantiles.exact_quantiles(df, ["a", "b", "c"], probs, by, small_cells=10 ** 9)
    hard = quantiles.exact_quantiles(df, ["a", "b", "c"], probs, by, small_cells=0, accuracy=200, rows_per_range=50)
    joined = quantiles.exact_quantiles(df, ["a", "b", "c"], probs, by, small_cells=0, accuracy=200, literals=0)
    assert rows(simple) == rows(hard.select(simple.columns)) == rows(joined.select(simple.columns))


def _hot(spark):
    """One entity holds most of the rows, periods repeat, and a third of its rows are exact copies."""
    return spark.range(900).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 20)).alias("e"),
        F.when(F.col("id") % 3 == 0, 5).otherwise((F.col("id") / 9).cast("int")).alias("year"),
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id").cast("double")).alias("value"))


def test_rolling_over_a_hot_entity(spark):
    df = materialize(_hot(spark), "hot-input")
    plain = temporal.rolling_features(df, "e", "year", ["value"], 3, 1, ["mean", "min", "max"])
    pieces = temporal.rolling_features(df, "e", "year", ["value"], 3, 1, ["mean", "min", "max"], hot_rows=40)
    assert pieces.count() == 900
    # Rows of one period are ordered by a row hash whose low bits differ between the two ways: what
    # holds for any order is the set of rows and the row count per entity.
    key = ["e", "year", "value"]
    assert plain.columns == pieces.columns
    assert rows(plain.select(key)) == rows(pieces.select(key))
    assert pieces.where("value_rolling_min_3y > value or value_rolling_max_3y < value").count() == 0


def test_rolling_pieces_equal_plain_windows(spark):
    df = materialize(spark.range(1000).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 20)).alias("e"),
        F.col("id").cast("int").alias("year"), F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("value")), "u")
    for k in (1, 3):
        plain = temporal.rolling_features(df, "e", "year", ["value"], k, 1, temporal.AGGREGATIONS, bounded_entities=True)
        pieces = temporal.rolling_features(df, "e", "year", ["value"], k, 1, temporal.AGGREGATIONS, hot_rows=37)
        assert rows(plain, 6) == rows(pieces.select(plain.columns), 6)


def test_row_ordinal_of_copies_is_a_permutation(spark):
    df = _hot(spark).withColumn("_tie", F.xxhash64("e", "year", "value"))
    low = F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(1 << 24))
    df = materialize(df.withColumn("_tie", F.shiftleft(F.shiftright("_tie", 24), 24) + low), "t")
    out = temporal.row_ordinal(df, "e", "year", "_tie", rows_per_range=25)
    per = out.groupBy("e").agg(F.count("*").alias("n"), F.countDistinct("_ordinal").alias("d"),
                               F.min("_ordinal").alias("lo"), F.max("_ordinal").alias("hi")).collect()
    assert all(r["n"] == r["d"] and r["lo"] == 0 and r["hi"] == r["n"] - 1 for r in per)
    w = Window.partitionBy("e").orderBy("_ordinal")
    assert out.withColumn("p", F.lag("year").over(w)).where("p > year").count() == 0


def test_shuffled_lookup_equals_broadcast(spark):
    left = spark.range(300).select((F.col("id") % 5).alias("k"), "id", F.when(F.col("id") % 2 == 0, 0).otherwise(1).alias("h"))
    left = left.withColumn("k", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("k")))
    right = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, v string")
    for how in ("left", "inner"):
        a = lookup_join(left, right, ["k"], how)
        b = lookup_join(left, right, ["k"], how, broadcast_rows=0, share=4, least=10)
        key = lambda r: (r["id"], str(r["v"]))
        assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))
    semi = lookup_join(left, right.select("k"), ["k"], "left_semi", broadcast_rows=0, share=4, least=10)
    assert semi.count() == left.where("k in (0, 1, 2)").count()


@pytest.mark.parametrize("pivots,block", [(1, 4096), (7, 4096), (5, 16)])
def test_neighbors_equal_brute_force(spark, pivots, block):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(size=(80, 3)), rng.normal(size=(60, 3)) * 0.01 + 5, np.zeros((10, 3))])
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double").repartition(4)
    out = neighbors.nearest_neighbors(df, "id", ["a", "b", "c"], 4, pivots=pivots, block=block).collect()
    got = {(r["id"], r["rank"]): (r["neighbor"], r["distance"]) for r in out}
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((np.arange(len(x)), d)) if j != i][:4]
        assert [got[i, r + 1][0] for r in range(4)] == order
        assert np.allclose([got[i, r + 1][1] for r in range(4)], d[order])


def test_smote_points_lie_between_minority_rows(spark):
    rng = np.random.default_rng(2)
    data = [(i, float(a), float(b), int(i < 12)) for i, (a, b) in enumerate(rng.normal(size=(120, 2)))]
    df = spark.createDataFrame(data, "id long, a double, b double, label int")
    out = resample.smote(df, ["a", "b"], "id", ratio=0.5, k=3)
    new = out.where("is_synthetic = 1").collect()
    assert len(new) == int(0.5 * 108 - 12) and all(r["label"] == 1 and r["id"] is None for r in new)
    minority = np.array([d[1:3] for d in data if d[3] == 1])
    for r in new:
        p = np.array([r["a"], r["b"]])
        between = any(abs(np.linalg.norm(p - u) + np.linalg.norm(p - v) - np.linalg.norm(u - v)) < 1e-9
                      for u in minority for v in minority)
        assert between
    assert rows(out.repartition(5).select("a", "b")) == rows(resample.smote(df.repartition(3), ["a", "b"], "id", ratio=0.5, k=3).select("a", "b"))
    with pytest.raises(ValueError):
        resample.synthetic_count(50, 100, 0.1)


def test_isolation_forest_finds_the_far_rows(spark):
    rng = np.random.default_rng(3)
    data = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(380, 2)))] + [(380 + i, 30.0 + i, -30.0) for i in range(20)]
    df = spark.createDataFrame(data, "id long, a double, b double")
    out = outliers.isolation_outliers(df, "id", ["a", "b"], 0.05, trees=40, sample_size=64)
    flagged = {r["id"] for r in out.where("is_outlier = 1").collect()}
    assert flagged == set(range(380, 400))


@pytest.mark.parametrize("prevalence", [0.0001, 0.3])
def test_label_share_is_exact(spark, sf, prevalence):
    p = materialize(order_panel(spark, sf), "p")
    n = p.count()
    out = labelling.top_share(p, "n_orders", prevalence, ["entity", "period"], rows_per_range=13)
    assert out.where("target = 1").count() == int(n * prevalence)
    lowest = out.where("target = 1").agg(F.min("n_orders")).first()[0]
    assert out.where("target = 0").where(F.col("n_orders") > (lowest or 10 ** 9)).count() == 0
    by_group = labelling.top_share_by_group(p, "n_orders", prevalence, "entity", "period", rows_per_range=13)
    for r in by_group.groupBy("period").agg(F.count("*").alias("n"), F.sum("target").alias("t")).collect():
        assert r["t"] == int(r["n"] * prevalence)


def test_smote_query_uses_the_whole_embedding(spark, sf):
    from panelwright.plans.catalog_features import smote_rows

    out = smote_rows(spark, sf).toPandas()
    names = [c for c in out.columns if c.startswith("x")]
    assert len(names) == len(spark.read.parquet(f"{sf}/embeddings.parquet").first()["embedding"]) > 8
    old = out[(out["is_synthetic"] == 0) & (out["label"] == 1)][names].to_numpy()
    new = out[out["is_synthetic"] == 1][names].to_numpy()
    between = np.linalg.norm(old[:, None] - old[None], axis=2)
    assert len(new)
    for x in new:
        away = np.linalg.norm(old - x, axis=1)
        detour = away[:, None] + away[None] - between
        np.fill_diagonal(detour, np.inf)
        assert detour.min() < 1e-6


def test_splits_are_disjoint_and_ordered(spark, sf):
    p = materialize(order_panel(spark, sf), "p")
    splitter = split.StratifiedTemporalSplitter(5, period="period", entity="entity", label="label")
    chosen = splitter.cuts(p)
    assert chosen and len({(s.n_train, s.n_val) for s in chosen}) == len(chosen)
    for s, (train, val) in zip(chosen, splitter.split(p), strict=True):
        assert (train.count(), val.count()) == (s.n_train, s.n_val)
        assert split.entity_overlap(train, val, "entity").isEmpty()
        assert train.agg(F.max("period")).first()[0] <= s.cut - s.gap < s.cut < val.agg(F.min("period")).first()[0]


def test_balanced_panel_falls_back_to_row_order(spark, panel):
    splitter = split.StratifiedTemporalSplitter(3)
    assert splitter.cuts(panel) == []
    tagged = panel.withColumn("n", F.substring("patient_id", 2, 4).cast("int"))
    (train, val), = splitter.split(tagged, ["year", "n"])
    assert (train.count(), val.count()) == (239, 60)


def test_partitioning_does_not_change_results(spark, sf):
    p = materialize(order_panel(spark, sf), "p")
    for q in (p.repartition(1), p.repartition(13), p.orderBy(F.rand(5))):
        a = temporal.rolling_features(p, "entity", "period", ["amt"], 3, 1, ["mean", "std"])
        b = temporal.rolling_features(q, "entity", "period", ["amt"], 3, 1, ["mean", "std"])
        assert rows(a, 4) == rows(b, 4)


def test_splits_of_many_periods(spark):
    # 1,200 days with gaps; entities start at every day, so the (period, first period) pairs are far above 250,000.
    rows = spark.range(1200 * 1200).select(
        (F.col("id") % 1200).alias("first"), (F.col("id") / 1200).cast("int").alias("step")).where("first + step < 1200").select(
        F.col("first").alias("entity"), (F.col("first") + F.col("step") + F.floor((F.col("first") + F.col("step")) / 7) * 2).cast("int").alias("day"),
        ((F.col("first") * 7 + F.col("step")) % 11 == 0).cast("int").alias("label"))
    d = rows.toPandas()
    first = d.groupby("entity")["day"].transform("min")
    for gap, disjoint, size in ((1, True, 250_000), (3, True, 500), (2, False, 250_000)):
        table = split.candidate_table(rows, "entity", "day", "label", gap, disjoint, size).toPandas().set_index("cut")
        assert sorted(table.index) == sorted(d["day"].unique())
        for cut in list(table.index[::150]) + [d["day"].min(), d["day"].max()]:
            val = d[(d["day"] > cut) & ((first > cut - gap) | (not disjoint))]
            got = table.loc[cut]
            assert (got["n_train"], got["n_val"]) == ((d["day"] <= cut - gap).sum(), len(val))
            assert np.isnan(got["val_rate"]) if val.empty else abs(got["val_rate"] - val["label"].mean()) < 1e-12
    days = sorted(d["day"].unique())
    role = split.last_periods_role(rows, "day", 1, 500).groupBy("role").agg(F.max("day").alias("hi"), F.min("day").alias("lo")).collect()
    found = {r["role"]: (r["lo"], r["hi"]) for r in role}
    cut = days[int(len(days) * 0.8)]
    assert found["val"] == (min(x for x in days if x > cut), days[-1]) and found["train"] == (days[0], max(x for x in days if x <= cut - 1))
    cuts = split.StratifiedTemporalSplitter(4, period="day", entity="entity", label="label", rows_per_range=500).cuts(rows)
    aims = [int(q) for q in np.quantile(days[1:-1], np.linspace(0.2, 0.8, 4))]
    overall = d["label"].mean()
    for s, aim in zip(cuts, aims, strict=True):
        near = []
        for cut in (aim + x for x in split.NEARBY if aim + x in days or x == 0):
            val = d[(d["day"] > cut) & (first > cut - 1)]
            near.append((abs(val["label"].mean() - overall), cut, (d["day"] <= cut - 1).sum(), len(val)))
        best = min(near, key=lambda x: x[0])
        assert (s.cut, s.n_train, s.n_val) == best[1:]
