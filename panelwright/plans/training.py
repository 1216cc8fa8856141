"""The training job: split, prepare, fit per fold, pool the scores, choose a threshold, refit."""

from __future__ import annotations

import random
import statistics
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.rules import inject_nulls
from panelwright.ml.models import make_classifier, model_columns, with_probability
from panelwright.ml.stages import build_stages, fit_stages
from panelwright.operators import metrics
from panelwright.operators.resample import class_weights, smote
from panelwright.operators.split import StratifiedTemporalSplitter, chronological, last_periods_role
from panelwright.operators.thresholds import optimize_threshold
from panelwright.runtime import materialize

CV_METRICS = ["roc_auc", "pr_auc", "f1_score", "precision", "recall", "accuracy"]
# The search space; (low, high, kind) per setting.
SPACE = {
    "gbt": {"maxIter": (10, 60, "int"), "maxDepth": (3, 7, "int"), "stepSize": (1e-3, 0.2, "log"),
            "subsamplingRate": (0.6, 1.0, "float"), "minInstancesPerNode": (1, 50, "int")},
    "random_forest": {"numTrees": (20, 100, "int"), "maxDepth": (3, 10, "int"), "minInstancesPerNode": (1, 50, "int")},
    "logistic_regression": {"maxIter": (5, 50, "int"), "regParam": (1e-4, 1.0, "log"), "elasticNetParam": (0.0, 1.0, "float")},
}


@dataclass
class Training:
    """What a training run leaves: the model for new rows, its threshold and its out-of-fold record."""
    model: PipelineModel
    features: list[str]
    inputs: list[str]
    threshold: float
    scored: DataFrame              # out-of-fold (entity, period, label, score, fold)
    folds: DataFrame               # metrics per fold
    summary: DataFrame             # mean and deviation per metric
    algorithm: str
    config: dict = field(default_factory=dict)


@dataclass
class Columns:
    entity: str = "patient_id"
    period: str = "year"
    label: str = "target"

    @property
    def keys(self) -> list[str]:
        return [self.entity, self.period]


def split_label(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The features (label dropped) and the label's name; an error when it is absent."""
    if label not in df.columns:
        raise ValueError(f"label column {label} is absent")
    return df.drop(label), label


def make_splits(df: DataFrame, config: dict, c: Columns) -> list[tuple[DataFrame, DataFrame]]:
    """(train, validation) per fold. Where no cut leaves rows on both sides, the last fifth of the periods validates; where that leaves a
    side empty too, the last rows do."""
    cv = config.get("cross_validation", {})
    gap = cv.get("gap", 1)
    splitter = StratifiedTemporalSplitter(
        cv.get("n_splits", 5), cv.get("test_size", 0.2), gap, c.period, c.entity, c.label, cv.get("group_disjoint", True))
    cuts = splitter.cuts(df)
    if cuts:
        return splitter.split(df, cuts=cuts)
    periods = df.where(F.col(c.period).isNotNull()).select(c.period).distinct().limit(2).count()
    if periods > 1:
        tagged = materialize(last_periods_role(df, c.period, gap), "last-periods")
        sides = {r["role"] for r in tagged.where("role is not null").select("role").distinct().collect()}      # two at most
        if len(sides) == 2:
            return [(tagged.where("role = 'train'").drop("role"), tagged.where("role = 'val'").drop("role"))]
    return [chronological(df, [c.period, c.entity], cv.get("test_size", 0.2), gap)]


def _algorithm(config: dict) -> tuple[str, dict]:
    model = config.get("model", {})
    name = model.get("algorithm", "gbt")
    return name, dict(model.get(name, {}))


def prepare(train: DataFrame, config: dict, c: Columns) -> tuple[PipelineModel, DataFrame, list[str]]:
    """Fit the preparation on ``train``; the prepared rows (rebalanced if configured) and the learner's columns."""
    pre, ready = fit_stages(build_stages(config, c.entity, c.period, c.label), train)
    ready = materialize(ready, "prepared")
    features = model_columns(ready, c.keys, c.label)
    imbalance = config.get("imbalance", {})
    if imbalance.get("method") == "smote":
        s = imbalance.get("smote", {})
        ready = ready.withColumn("_key", F.xxhash64(*c.keys))
        ready = smote(ready.select("_key", c.label, *features), features, "_key", c.label,
                      s.get("sampling_strategy", 0.1), s.get("k_neighbors"), s.get("random_state", 42))
        ready = materialize(ready.select(c.label, *features), "rebalanced")
    elif imbalance.get("method") == "class_weight":
        ready = class_weights(ready, c.label)
    elif imbalance.get("method") not in (None, "none"):
        raise ValueError(f"unknown imbalance method: {imbalance['method']}")
    return pre, ready, features


def fit_model(train: DataFrame, config: dict, c: Columns) -> tuple[PipelineModel, list[str]]:
    """Preparation and classifier as one pipeline for new rows."""
    pre, ready, features = prepare(train, config, c)
    name, settings = _algorithm(config)
    learner = make_classifier(name, settings, config.get("random_seed", 42), label=c.label, weight=_weight(config))
    vectors = VectorAssembler(inputCols=features, outputCol="features")
    fitted = learner.fit(vectors.transform(ready))
    return PipelineModel(stages=[*pre.stages, vectors, fitted]), features


def train_model(df: DataFrame, config: dict, c: Columns | None = None) -> Training:
    """Cross-validate, choose the threshold on pooled out-of-fold scores, refit on all rows.

    ``df`` is scanned once per fold and stage; pass a stored table. Driver work grows with folds and
    columns only.
    """
    c = c or Columns()
    split_label(df, c.label)
    scored = None
    for i, (train, val) in enumerate(make_splits(df, config, c), 1):
        model, _ = fit_model(train, config, c)
        part = with_probability(model.transform(val)).select(*c.keys, F.col(c.label).alias("label"), "score")
        part = materialize(part.withColumn("fold", F.lit(i)), "fold")
        scored = part if scored is None else scored.unionByName(part)
    scored = scored.withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    folds = materialize(metrics.classification_metrics(scored, by=["fold"]), "fold-metrics")
    method = config.get("evaluation", {}).get("threshold_method", "f1_optimal")
    weights = config.get("threshold", {}).get("metric_weights")
    threshold = optimize_threshold(scored, method, **({"weights": weights} if method == "weighted" and weights else {}))
    model, features = fit_model(df, config, c)
    return Training(model, features, [x for x in df.columns if x != c.label], threshold, scored, folds,
                    metrics.fold_summary(folds, CV_METRICS), _algorithm(config)[0], config)


def evaluate(model: PipelineModel, df: DataFrame, threshold: float, label: str) -> DataFrame:
    """All metrics of the model on ``df`` at its threshold, one row."""
    s = with_probability(model.transform(df)).select(F.col(label).alias("label"), "score")
    s = s.withColumn("pred", (F.col("score") >= threshold).cast("int"))
    return metrics.classification_metrics(s).withColumn("optimal_threshold", F.lit(float(threshold)))


def missing_scenarios(model: PipelineModel, df: DataFrame, threshold: float, c: Columns, scenarios: dict[str, dict[tuple[str, ...], float]],
                      seed: int = 42) -> DataFrame:
    """(scenario, all metrics): the model on ``df`` with cells blanked at each scenario's rates; one scored table, one job for all scenarios.

    A scenario maps tuples of columns that go missing together to their rate; an empty one is the table as it is.
    """
    scored = None
    for name, rates in scenarios.items():
        blanked = inject_nulls(df, c.keys, rates, seed) if rates else df
        part = with_probability(model.transform(blanked)).select(F.lit(name).alias("scenario"), F.col(c.label).alias("label"), "score")
        scored = part if scored is None else scored.unionByName(part)
    scored = scored.withColumn("pred", (F.col("score") >= threshold).cast("int"))
    return metrics.classification_metrics(scored, by=["scenario"])


def draw_trial(rng: random.Random, algorithms: list[str]) -> tuple[str, dict]:
    name = rng.choice(algorithms)
    out = {}
    for setting, (low, high, kind) in SPACE[name].items():
        if kind == "int":
            out[setting] = rng.randint(low, high)
        elif kind == "log":
            out[setting] = low * (high / low) ** rng.random()
        else:
            out[setting] = rng.uniform(low, high)
    return name, out


def _weight(config: dict) -> str | None:
    return "weight" if config.get("imbalance", {}).get("method") == "class_weight" else None


@dataclass
class _Trials:
    """The values of all trials so far, fold by fold, as trials running side by side report them."""
    history: dict[int, list[float]] = field(default_factory=dict)
    finished: int = 0
    lock: threading.Lock = field(default_factory=threading.Lock)

    def report(self, trial: int, values: list[float]) -> bool:
        """Record a trial's values; whether it should stop: its mean is below the median of the others at the same fold, after five full trials."""
        with self.lock:
            others = [statistics.fmean(h[:len(values)]) for t, h in self.history.items() if t != trial and len(h) >= len(values)]
            self.history[trial] = list(values)
            return self.finished >= 5 and bool(others) and statistics.fmean(values) < statistics.median(others)

    def done(self) -> None:
        with self.lock:
            self.finished += 1


def search(df: DataFrame, config: dict, c: Columns | None = None) -> DataFrame:
    """Seeded random search over algorithms and settings, best trial first.

    (trial, algorithm, settings, metric, value, folds, pruned). The preparation of each fold does not
    depend on the trial and is stored once. ``hpo.parallel`` trials run side by side as jobs of the same cluster, each in a scheduling pool of
    its own (fair where the session is); settings are drawn before any starts, so they do not depend on it. A trial is stopped when its running mean falls below the
    median of the other trials at the same fold, as far as they have come, after five full trials. Folds on which the metric is
    undefined are passed over; after ``timeout_sec`` no further trial starts.
    """
    c = c or Columns()
    hpo = config.get("hpo", {})
    metric = {"f1": "f1_score"}.get(hpo.get("opt_metric", "pr_auc"), hpo.get("opt_metric", "pr_auc"))
    rng = random.Random(config.get("random_seed", 42))
    weighted, limit, began = _weight(config), hpo.get("timeout_sec"), time.monotonic()
    folds = []
    for train, val in make_splits(df, config, c):
        pre, ready, features = prepare(train, config, c)
        vectors = VectorAssembler(inputCols=features, outputCol="features")
        folds.append((vectors.transform(materialize(ready, "search-train")),
                      vectors.transform(materialize(pre.transform(val), "search-val"))))
    drawn = [draw_trial(rng, list(hpo.get("algorithms", list(SPACE)))) for _ in range(int(hpo.get("n_trials", 30)))]
    trials = _Trials()
    spark = df.sparkSession

    def run(trial: int) -> tuple | None:
        if limit and trials.history and time.monotonic() - began > limit:
            return None
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{trial}")
        name, settings = drawn[trial]
        values: list[float] = []
        pruned = False
        for train, val in folds:
            fitted = make_classifier(name, settings, config.get("random_seed", 42), label=c.label, weight=weighted).fit(train)
            s = with_probability(fitted.transform(val)).select(F.col(c.label).alias("label"), "score")
            s = s.withColumn("pred", (F.col("score") >= 0.5).cast("int"))
            found = metrics.classification_metrics(s).first()[metric]
            if found is None:
                continue
            values.append(float(found))
            if trials.report(trial, values):
                pruned = len(values) < len(folds)
                break
        trials.done()
        return (trial, name, {k: str(v) for k, v in settings.items()}, metric, statistics.fmean(values) if values else None, len(values), pruned)

    parallel = max(1, int(hpo.get("parallel", 1)))
    if parallel == 1:
        found = [run(i) for i in range(len(drawn))]
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    else:
        with ThreadPoolExecutor(parallel) as pool:
            found = list(pool.map(inheritable_thread_target(spark)(run), range(len(drawn))))
    table = spark.createDataFrame(
        [r for r in found if r], "trial int, algorithm string, settings map<string,string>, metric string, value double, folds int, pruned boolean")
    return table.orderBy("pruned", F.desc("value"), "trial")


def with_best(config: dict, trials: DataFrame) -> dict:
    """The configuration with the best trial's algorithm and settings."""
    best = trials.where(~F.col("pruned")).orderBy(F.desc("value"), "trial").first()
    kinds = {k: kind for k, (_, _, kind) in SPACE[best["algorithm"]].items()}
    settings = {k: int(v) if kinds[k] == "int" else float(v) for k, v in best["settings"].items()}
    model = {**config.get("model", {}), "algorithm": best["algorithm"], best["algorithm"]: settings}
    return {**config, "model": model}
