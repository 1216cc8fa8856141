"""Column selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.rules import number
from panelwright.operators.quantiles import statistics
from panelwright.runtime import materialize, quoted

METHODS = ("variance_threshold", "importance_threshold", "recursive_elimination", "mutual_information")


def variances(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, var_pop, var_samp) per column, one aggregation."""
    row = df.agg(*[f(number(c)).alias(f"{n}|{c}") for c in cols
                   for n, f in (("p", F.var_pop), ("s", F.var_samp))])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`p|{c}`").alias("var_pop"), F.col(f"`s|{c}`").alias("var_samp"))
        for c in cols])))


def top_k(table: DataFrame, value: str, name: str, k: int) -> DataFrame:
    """The k largest values, ties by name."""
    return table.orderBy(F.desc(value), name).limit(k)


def variance_selection(df: DataFrame, cols: Sequence[str], max_features: int = 50, limit: float = 0.01) -> DataFrame:
    """(feature, var_pop, var_samp) of the selected columns: population variance above ``limit``,
    the most varying ``max_features`` of them."""
    return top_k(variances(df, cols).where(F.col("var_pop") > limit), "var_samp", "feature", max_features)


def mutual_information(df: DataFrame, cols: Sequence[str], label: str = "label", bins: int = 10, **options) -> DataFrame:
    """(feature, n, bins, classes, mi) per column, in nats: how much its quantile bin tells about the label.

    A value's bin is the number of inner decile edges below it (``bins`` - 1 edges), so equal values share a bin. All columns and classes are counted in one pass
    over the rows with a number and a label. The mean excess that binned counts of independent columns have is taken off, which can leave
    a value slightly below 0; a column without values has none.
    """
    edges = [r.asDict() for r in statistics(df, cols, [i / bins for i in range(1, bins)], **options).select("feature", "quantiles").collect()]   # one per column
    cells = [F.struct(F.lit(e["feature"]).alias("feature"), number(e["feature"]).alias("_x"), F.array(*map(F.lit, sorted(set(e["quantiles"])))).alias("_edges"))
             for e in edges if e["quantiles"] is not None and e["quantiles"][0] is not None]
    if not cells:
        return df.sparkSession.createDataFrame([], "feature string, n long, bins long, classes long, mi double")
    y = F.col(quoted(label))
    long = df.where(y.isNotNull()).select(y.alias("_y"), F.inline(F.filter(F.array(*_same_type(cells)), lambda c: c["_x"].isNotNull())))
    below = F.size(F.filter("_edges", lambda e: e < F.col("_x")))
    joint = materialize(long.groupBy("feature", below.alias("_bin"), "_y").agg(F.count("*").alias("_n")), "joint-counts")   # columns x bins x classes rows
    total = joint.groupBy("feature").agg(F.sum("_n").alias("n"), F.count_distinct("_bin").alias("bins"), F.count_distinct("_y").alias("classes"))
    by_bin = joint.groupBy("feature", "_bin").agg(F.sum("_n").alias("_nx"))
    by_class = joint.groupBy("feature", "_y").agg(F.sum("_n").alias("_ny"))
    n = F.col("n").cast("double")
    term = F.col("_n") / n * F.log(F.col("_n") * n / (F.col("_nx") * F.col("_ny")))
    return (joint.join(total, "feature").join(by_bin, ["feature", "_bin"]).join(by_class, ["feature", "_y"])
            .groupBy("feature", "n", "bins", "classes").agg(F.sum(term).alias("_mi"))
            .select("feature", "n", "bins", "classes", (F.col("_mi") - (F.col("bins") - 1) * (F.col("classes") - 1) / (2 * n)).alias("mi")))


def _same_type(cells: Sequence) -> list:
    return [c.cast("struct<feature:string,_x:double,_edges:array<double>>") for c in cells]


def _vectors(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol="_all", handleInvalid="keep").transform(df).select("_all", label)


def importance_selection(df: DataFrame, cols: Sequence[str], label: str = "label", k: int = 50,
                         trees: int = 100, depth: int = 5, seed: int = 42) -> list[str]:
    forest = RandomForestClassifier(featuresCol="_all", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    weights = forest.fit(_vectors(df, cols, label)).featureImportances.toArray()
    ranked = sorted(zip(cols, weights, strict=True), key=lambda t: (-t[1], t[0]))
    return [c for c, _ in ranked[:k]]


def recursive_elimination(df: DataFrame, cols: Sequence[str], label: str = "label", k: int = 50, trees: int = 50,
                          depth: int = 5, step: float = 0.1, seed: int = 42) -> list[str]:
    """Fit, drop the weakest max(1, step * width) columns, repeat until k remain. The rows stay in
    one cached vector column; every round only slices it."""
    cols = list(cols)
    drop = max(1, int(step * len(cols)))
    data = _vectors(df, cols, label).persist()
    try:
        kept = list(range(len(cols)))
        while len(kept) > k:
            sliced = VectorSlicer(inputCol="_all", outputCol="_some", indices=kept).transform(data)
            forest = RandomForestClassifier(featuresCol="_some", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
            weights = forest.fit(sliced).featureImportances.toArray()
            order = sorted(range(len(kept)), key=lambda i: (weights[i], cols[kept[i]]))
            weakest = set(order[:min(drop, len(kept) - k)])
            kept = [c for i, c in enumerate(kept) if i not in weakest]
        return [cols[i] for i in kept]
    finally:
        data.unpersist()


def select_features(df: DataFrame, cols: Sequence[str], method: str, label: str = "label", max_features: int = 50) -> list[str]:
    """Names of the selected columns, in input order."""
    if method == "variance_threshold":
        chosen = {r["feature"] for r in variance_selection(df, cols, max_features).collect()}    # one per column
    elif method == "importance_threshold":
        chosen = set(importance_selection(df, cols, label, max_features))
    elif method == "recursive_elimination":
        chosen = set(recursive_elimination(df, cols, label, min(max_features, len(cols))))
    elif method == "mutual_information":
        ranked = top_k(mutual_information(df, cols, label).where("mi > 0"), "mi", "feature", max_features)
        chosen = {r["feature"] for r in ranked.collect()}                                        # one per column
    else:
        raise ValueError(f"unknown selection method: {method}")
    return [c for c in cols if c in chosen]
