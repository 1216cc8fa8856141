"""Classifier factory, scoring, importances and attributions."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from itertools import accumulate

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.ml import paths
from panelwright.runtime import materialize, stored_rows
from panelwright.sources.readers import sample_rows

log = logging.getLogger(__name__)

# Boosting names of a configuration file all mean Spark's gradient-boosted trees.
ALGORITHMS = {"gbt": GBTClassifier, "lightgbm": GBTClassifier, "xgboost": GBTClassifier, "catboost": GBTClassifier,
              "random_forest": RandomForestClassifier, "logistic_regression": LogisticRegression}
# Setting names of the boosting libraries and what they set here.
SETTINGS = {"learning_rate": "stepSize", "lr": "stepSize", "n_estimators": "maxIter", "iterations": "maxIter",
            "iters": "maxIter", "max_depth": "maxDepth", "depth": "maxDepth", "min_child_samples": "minInstancesPerNode",
            "min_child_weight": "minInstancesPerNode", "subsample": "subsamplingRate", "bagging_fraction": "subsamplingRate",
            "feature_fraction": "featureSubsetStrategy", "colsample_bytree": "featureSubsetStrategy",
            "random_state": "seed", "random_seed": "seed"}
WITHOUT_COUNTERPART = {"num_leaves", "bagging_freq", "reg_lambda", "reg_alpha", "l2_leaf_reg", "l2", "n_jobs", "verbose",
                       "tree_method", "eval_metric", "objective", "metric", "boosting_type", "loss_function",
                       "class_weight", "scale_pos_weight", "importance_type", "gamma", "thread_count"}


def make_classifier(algorithm: str, settings: dict | None = None, seed: int = 42, features: str = "features",
                    label: str = "label", weight: str | None = None):
    """A Spark classifier from an algorithm name and the settings of either vocabulary."""
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm: {algorithm}")
    kind = ALGORITHMS[algorithm]
    model = kind(featuresCol=features, labelCol=label)
    if model.hasParam("seed"):
        model.set(model.getParam("seed"), seed)
    if weight:
        model.set(model.getParam("weightCol"), weight)
    for name, value in (settings or {}).items():
        target = SETTINGS.get(name, name)
        if target == "maxIter" and kind is RandomForestClassifier:
            target = "numTrees"
        if name in WITHOUT_COUNTERPART or (name in SETTINGS and not model.hasParam(target)):
            log.warning("%s has no counterpart in %s and is not used", name, kind.__name__)
            continue
        if not model.hasParam(target):
            raise ValueError(f"unknown setting for {algorithm}: {name}")
        if target == "featureSubsetStrategy":
            value = "all" if float(value) >= 1.0 else str(float(value))
        if target == "minInstancesPerNode":
            value = max(1, int(value))
        model.set(model.getParam(target), value)
    return model


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def model_columns(df: DataFrame, keys: Sequence[str], label: str) -> list[str]:
    """Numeric columns, then vectors, that feed the learner: neither keys nor label."""
    from panelwright.operators.impute import columns_by_kind, vector_columns

    return columns_by_kind(df, [*keys, label])[0] + vector_columns(df)


def with_probability(df: DataFrame, out: str = "score") -> DataFrame:
    """The positive-class probability as a plain column, the vectors dropped."""
    drop = [c for c in ("features", "rawPrediction", "probability", "prediction") if c in df.columns]
    return df.withColumn("_p", vector_to_array("probability")[1]).drop(*drop).withColumnRenamed("_p", out)


def classifier_of(model: PipelineModel):
    return model.stages[-1]


def feature_importances(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance), largest first; coefficients' magnitudes for a linear model.

    The slots of a vector feature are added up.
    """
    from pyspark.sql import SparkSession

    last = classifier_of(model)
    weights = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    slots = {f"{f}_onehot": n + 1 for s in model.stages for f, n in getattr(s, "fitted", {}).get("sizes", {}).items()}
    ends = list(accumulate(slots.get(f, 1) for f in features))
    if ends[-1:] != [len(weights)]:
        raise ValueError(f"{len(weights)} weights for {ends[-1:]} inputs")
    rows = [(f, float(sum(weights[end - slots.get(f, 1):end]))) for f, end in zip(features, ends, strict=True)]
    return (SparkSession.active().createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), "feature"))


def shapley_attributions(classifier, df: DataFrame, features: Sequence[str], key: Sequence[str], rows: int | None = None,
                         background: int = 50, permutations: int = 8, seed: int = 42, fraction: float = 1.0) -> DataFrame:
    """(feature, mean_abs_attribution, n_rows): Shapley values of the score, largest first, averaged over ``n_rows`` rows.

    Every row is explained unless the caller asks for a ``fraction`` or a number of ``rows``. For random feature
    orders, features are switched one by one from a background row to the row's own values; the score change
    belongs to the switched feature. Two-class forests, boosted trees and logistic regressions over plain columns are scored along whole
    orders in the task that holds the row (``paths``); for others the rows * permutations * (features + 1) combinations are scored in one
    distributed batch. Orders and background rows are hashes of the key; the ``background`` rows (a fixed number) stand for the table.
    """
    d = len(features)
    vectors = [c for c in features if isinstance(df.schema[c].dataType, VectorUDT)]      # each is switched as a whole
    numbers = [c for c in features if c not in vectors]
    if [*numbers, *vectors] != list(features):
        raise ValueError("vector features come last")
    vec = F.array(*[F.col(c).cast("double") for c in numbers]).cast("array<double>")
    own = [F.col(c).alias(f"_v{i}") for i, c in enumerate(vectors)]
    base = df.select(*[F.xxhash64(*key, F.lit(seed + i)).alias(c) for i, c in enumerate("hg")], vec.alias("x"), *own)
    # The stored number tells rows apart that share a key or a hash.
    base = materialize(base.withColumn("id", F.monotonically_increasing_id()), "explained")
    n_back = min(background, stored_rows(base))
    if not n_back:
        return df.sparkSession.createDataFrame([], "feature string, mean_abs_attribution double, n_rows long")
    back = materialize(base.orderBy("g", "id").limit(n_back).select(                    # a small fixed number
        (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("g", "id")) - 1).alias("back"), F.col("x").alias("b"),
        *[F.col(f"_v{i}").alias(f"_b{i}") for i in range(len(vectors))]), "background")
    picked = sample_rows(base, fraction, ["h"], seed)
    if rows is not None:
        picked = picked.orderBy("h").limit(rows)
    names = F.array(*[F.lit(c) for c in features])
    scorer = None if vectors else paths.scorer_of(classifier)
    if scorer is not None:
        rest = [[0.0 if v is None else v for v in r["b"]] for r in back.orderBy("back").collect()]              # a small fixed number
        sums = picked.select("h", "x").mapInArrow(paths.attributed(scorer, rest, d, permutations, seed), "f int, total double, n long")
        return (sums.groupBy(F.get(names, F.col("f")).alias("feature"))
                .agg((F.sum("total") / F.sum("n")).alias("mean_abs_attribution"), F.sum("n").alias("n_rows"))
                .orderBy(F.desc("mean_abs_attribution"), "feature"))
    orders = (picked.select(*[c for c in picked.columns if c != "g"], F.explode(F.sequence(F.lit(1), F.lit(permutations))).alias("perm"))
             .withColumn("back", F.pmod(F.xxhash64("h", "perm", F.lit(seed)), F.lit(n_back)).cast("int"))
             .join(F.broadcast(back), "back")
             .withColumn("order", F.array_sort(F.transform(
                 F.sequence(F.lit(0), F.lit(d - 1)),
                 lambda f: F.struct(F.xxhash64(F.col("h"), F.col("perm"), f).alias("r"), f.alias("f")))))
             .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(d))))
             .withColumn("switched", F.transform(F.slice("order", F.lit(1), F.col("step")), lambda s: s["f"])))
    mixed = orders.select("id", F.get(F.col("order"), F.col("step") - 1)["f"].alias("f"), F.get(F.col("order"), F.col("step"))["f"].alias("next"),
                         array_to_vector(F.transform("x", lambda v, i: F.when(F.array_contains(F.col("switched"), i), v)
                                                     .otherwise(F.get(F.col("b"), i)))).alias("features" if not vectors else "_numbers"),
                         *[F.when(F.array_contains(F.col("switched"), len(numbers) + i), F.col(f"_v{i}")).otherwise(F.col(f"_b{i}")).alias(
                             f"_m{i}", metadata=df.schema[c].metadata) for i, c in enumerate(vectors)])
    if vectors:
        mixed = VectorAssembler(inputCols=["_numbers", *[f"_m{i}" for i in range(len(vectors))]], outputCol="features").transform(
            mixed.withMetadata("_numbers", {"ml_attr": {"num_attrs": len(numbers)}}))
    scored = with_probability(classifier.transform(mixed))
    # A step's score counts for the feature just switched and against the one switched next.
    signed = scored.select("id", F.inline(F.array(F.struct(F.col("f"), F.col("score").alias("s")),
                                                  F.struct(F.col("next").alias("f"), (-F.col("score")).alias("s")))))
    per_row = signed.where(F.col("f").isNotNull()).groupBy("id", "f").agg((F.sum("s") / permutations).alias("phi"))
    return (per_row.groupBy(F.get(names, F.col("f")).alias("feature"))
            .agg(F.avg(F.abs("phi")).alias("mean_abs_attribution"), F.count("*").alias("n_rows"))
            .orderBy(F.desc("mean_abs_attribution"), "feature"))
