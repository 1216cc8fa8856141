"""The operators as Spark ML stages. Fitted state is a plain dict parameter, encoder maps are tables;
both are saved with the pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReader, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators import chained, encode, impute, scale, select, temporal
from panelwright.runtime import materialize


class _Options(Params):
    """Settings in one dict parameter; unknown names are errors."""

    options = Param(Params._dummy(), "options", "settings of the stage")
    DEFAULTS: dict = {}

    def __init__(self, **settings):
        super().__init__()
        unknown = set(settings) - set(self.DEFAULTS)
        if unknown:
            raise ValueError(f"{type(self).__name__}: unknown settings {sorted(unknown)}")
        self._set(options={**self.DEFAULTS, **settings})

    def opt(self, name: str):
        return self.getOrDefault(self.options)[name]


class _Fitted(Model, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "fitted values")

    def __init__(self, state: dict | None = None):
        super().__init__()
        if state is not None:
            self._set(state=state)

    @property
    def fitted(self) -> dict:
        return self.getOrDefault(self.state)

    def get_feature_names_out(self) -> list[str]:
        return list(self.fitted.get("features", []))


class MissingValueHandler(_Options, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fill numeric and text columns; optionally mark columns that had missing cells at fit time.

    ``advanced`` = 'iterative' fills the numeric columns by chained regressions; what they cannot fill takes the strategy's value. Columns
    with a share of missing cells above ``drop_threshold`` are dropped (none if it is None).
    """

    DEFAULTS = {"numeric_strategy": "median", "categorical_strategy": "most_frequent", "add_indicator": True,
                "numeric_constant": 0.0, "categorical_constant": "missing_value", "exclude": [], "exact": True,
                "advanced": None, "max_iter": 10, "drop_threshold": None}

    def _fit(self, df: DataFrame) -> MissingValueModel:
        if self.opt("advanced") not in (None, "iterative"):
            raise ValueError(f"unknown advanced imputation: {self.opt('advanced')}")
        numeric, text = impute.columns_by_kind(df, self.opt("exclude"))
        limit = self.opt("drop_threshold")
        dropped = impute.sparse_columns(df, [*numeric, *text], limit) if limit is not None and (numeric or text) else []
        df = df.drop(*dropped)
        numeric, text = ([c for c in cols if c not in dropped] for cols in (numeric, text))
        chain = chained.chained_fill(df, numeric, self.opt("max_iter")).state() if self.opt("advanced") and numeric else None
        fills = {**impute.numeric_fills(df, numeric, self.opt("numeric_strategy"), self.opt("numeric_constant"), self.opt("exact")),
                 **impute.categorical_fills(df, text, self.opt("categorical_strategy"), self.opt("categorical_constant"))}
        marks = impute.columns_with_nulls(df, [c for c in df.columns if c not in self.opt("exclude")]) if self.opt("add_indicator") else []
        empty = [c for c in (*numeric, *text) if c not in fills]
        return MissingValueModel({"fills": fills, "indicators": marks, "features": [*numeric, *text], "empty": empty, "chain": chain, "dropped": dropped})


class MissingValueModel(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.fitted
        df = df.drop(*s.get("dropped", []))
        marked = impute.fill(df, {}, s["indicators"])                     # marks first: afterwards nothing is missing
        if s.get("chain"):
            marked = chained.apply_chained(marked, chained.ChainedFill.of(s["chain"]))
        return impute.fill(marked, s["fills"])


class TemporalFeatureEngineer(_Options, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Freeze the numeric columns at fit time, add rolling, trend and lag features on transform."""

    DEFAULTS = {"entity": "patient_id", "period": "year", "window_years": 3, "min_periods": 1, "features": [],
                "aggregations": ["mean", "std", "trend"], "exclude": ["age", "target"], "bounded_entities": False}

    def _fit(self, df: DataFrame) -> TemporalFeatureModel:
        o = self.getOrDefault(self.options)
        chosen = o["features"] or temporal.detect_features(df, o["entity"], o["period"], o["exclude"])
        names = temporal.feature_names([f for f in chosen if f in df.columns], o["window_years"], o["aggregations"])
        return TemporalFeatureModel({**o, "inputs": chosen, "features": names})


class TemporalFeatureModel(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.fitted
        return temporal.rolling_features(df, s["entity"], s["period"], s["inputs"], s["window_years"], s["min_periods"],
                                         s["aggregations"], True, s["bounded_entities"])


class _MapWriter(MLWriter):
    def __init__(self, instance: CategoricalEncoderModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        for i, feature in enumerate(self.instance.fitted["features"]):
            table = self.instance.tables.get(feature)
            if table is not None:
                table.write.parquet(f"{path}/maps/{i}")


class _MapReader(MLReader):
    def load(self, path: str) -> CategoricalEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CategoricalEncoderModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        mapped = model.fitted.get("sizes", {}) if model.fitted["method"] == "one_hot" else model.fitted["features"]
        model.tables = {f: self.sparkSession.read.parquet(f"{path}/maps/{i}")
                        for i, f in enumerate(model.fitted["features"]) if f in mapped}
        return model


class CategoricalEncoder(_Options, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Encode every text column: 'target_encoding', 'label_encoding' or 'one_hot'; ``one_hot_output`` is 'columns' or, for any number of values, 'vector'."""

    DEFAULTS = {"one_hot_output": "columns", "method": "target_encoding", "handle_unknown": "ignore", "min_samples_leaf": 20, "cv_folds": 5,
                "random_state": 42, "label": "target", "keys": ["patient_id", "year"]}

    def _features(self, df: DataFrame) -> list[str]:
        skip = {self.opt("label"), *self.opt("keys")}
        return impute.columns_by_kind(df, skip)[1]

    def _fit(self, df: DataFrame) -> CategoricalEncoderModel:
        method, features = self.opt("method"), self._features(df)
        if method == "target_encoding":
            return self._target_model(features, encode.category_stats(df, features, self.opt("label")) if features else None)
        state = {"method": method, "features": features, "handle_unknown": self.opt("handle_unknown")}
        model = CategoricalEncoderModel(state)
        if method == "label_encoding":
            model.tables = {f: materialize(encode.label_map(df, f), "label-map") for f in features}
        elif method == "one_hot":
            found = {f: encode.categories(df, f, self.opt("one_hot_output")) for f in features}
            model.tables = {f: v for f, v in found.items() if isinstance(v, DataFrame)}
            state["categories"] = {f: v for f, v in found.items() if f not in model.tables}
            state["sizes"] = {f: table.count() for f, table in model.tables.items()}
        else:
            raise ValueError(f"unknown encoding method: {method}")
        return model

    def _target_model(self, features: list[str], stats: DataFrame | None) -> CategoricalEncoderModel:
        overall = encode.overall_mean(stats) if features else 0.0
        model = CategoricalEncoderModel({"method": "target_encoding", "features": features, "overall": overall,
                                         "handle_unknown": self.opt("handle_unknown")})
        model.tables = {f: encode.full_map(stats, f, overall, self.opt("min_samples_leaf")) for f in features}
        return model

    def fit_transform(self, df: DataFrame) -> tuple[CategoricalEncoderModel, DataFrame]:
        """The model for new rows, and the training rows encoded without their own fold."""
        folds, features = self.opt("cv_folds"), self._features(df)
        if self.opt("method") != "target_encoding" or folds <= 1 or not features:
            model = self.fit(df)
            return model, model.transform(df)
        out = df.withColumn("_fold", encode.hash_fold(self.opt("keys"), folds, self.opt("random_state")))
        stats = encode.category_stats(out, features, self.opt("label"), "_fold")
        model = self._target_model(features, stats)
        for f in features:
            table = encode.fold_map(stats, f, "_fold", model.fitted["overall"], self.opt("min_samples_leaf"))
            out = encode.apply_map(out, table, [f, "_fold"], model.fitted["overall"], f)
        return model, out.drop("_fold")


class CategoricalEncoderModel(_Fitted):
    tables: dict[str, DataFrame] = {}

    def write(self) -> MLWriter:
        return _MapWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _MapReader()

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.fitted
        for f in s["features"]:
            if f not in df.columns:
                continue
            if s["method"] == "target_encoding":
                df = encode.apply_map(df, self.tables[f], [f], s["overall"], f)
            elif s["method"] == "label_encoding":
                policy = "error" if s["handle_unknown"] == "error" else "keep"
                df = encode.label_encode(df, f, self.tables[f], policy, out=f)
            else:
                df = encode.one_hot(df, f, s["categories"].get(f, self.tables.get(f)), s.get("sizes", {}).get(f))
        return df


class DataScaler(_Options, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """'standard' or 'minmax' scaling of the numeric columns."""

    DEFAULTS = {"method": "standard", "exclude": []}

    def _fit(self, df: DataFrame) -> DataScalerModel:
        numeric, _ = impute.columns_by_kind(df, self.opt("exclude"))
        found = scale.scaling_parameters(df, numeric, self.opt("method"))
        return DataScalerModel({"parameters": {c: list(v) for c, v in found.items()}, "features": numeric})


class DataScalerModel(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        return scale.scale(df, {c: tuple(v) for c, v in self.fitted["parameters"].items()})


class FeatureSelector(_Options, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Keep the keys, the label, text and vector columns and the selected numeric columns."""

    DEFAULTS = {"method": "recursive_elimination", "max_features": 50, "label": "target", "keys": ["patient_id", "year"]}

    def _fit(self, df: DataFrame) -> FeatureSelectorModel:
        keep = [*self.opt("keys"), self.opt("label")]
        numeric, text = impute.columns_by_kind(df, keep)
        chosen = select.select_features(df, numeric, self.opt("method"), self.opt("label"), self.opt("max_features"))
        return FeatureSelectorModel({"features": chosen, "keep": [*keep, *text, *impute.vector_columns(df)], "dropped": [c for c in numeric if c not in chosen]})


class FeatureSelectorModel(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        names = [c for c in (*self.fitted["keep"], *self.fitted["features"]) if c in df.columns]
        return df.select(*names)


class BooleanToInt(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Booleans become 0/1, so that they count as numeric columns."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return impute.booleans_to_int(df)


class ColumnAligner(_Options, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Exactly the given columns in the given order; absent ones are filled with 0, extra ones dropped."""

    DEFAULTS = {"columns": [], "keep": []}

    def report(self, df: DataFrame) -> tuple[list[str], list[str]]:
        """(missing, extra) column names."""
        wanted, have = set(self.opt("columns")), set(df.columns)
        return ([c for c in self.opt("columns") if c not in have],
                [c for c in df.columns if c not in wanted and c not in self.opt("keep")])

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df.select(*[c for c in self.opt("keep") if c in df.columns],
                        *[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in self.opt("columns")])
        if len(out.columns) < len(self.opt("columns")):
            raise ValueError("column count mismatch")
        return out


def build_stages(config: dict, entity: str = "patient_id", period: str = "year", label: str = "target") -> list:
    """The preparation stages of a configuration: fill, roll, encode, scale, select."""
    engineering = config.get("feature_engineering", {})
    keys = [entity, period]
    missing = config.get("missing_values", {})
    advanced = missing.get("advanced_imputation", {})
    stages: list = [BooleanToInt(), MissingValueHandler(
        add_indicator=False, exclude=[*keys, label], numeric_strategy=missing.get("numeric_strategy", "median"),
        categorical_strategy=missing.get("categorical_strategy", "most_frequent"), drop_threshold=missing.get("drop_threshold"),
        advanced=advanced.get("method", "iterative") if advanced.get("enabled") else None, max_iter=advanced.get("max_iter", 10))]
    if engineering.get("rolling_window_years"):
        stages.append(TemporalFeatureEngineer(
            entity=entity, period=period, window_years=engineering["rolling_window_years"], exclude=["age", label],
            aggregations=list(engineering.get("temporal_features", ["mean", "std", "trend"])),
            features=list(engineering.get("features", [])),
            bounded_entities=bool(engineering.get("bounded_entities", False))))
    enc = engineering.get("categorical_encoding", {})
    stages.append(CategoricalEncoder(method=enc.get("method", "target_encoding"), one_hot_output=enc.get("one_hot_output", "columns"), cv_folds=enc.get("cv_folds", 5),
                                     handle_unknown=enc.get("handle_unknown", "ignore"), label=label, keys=keys,
                                     random_state=config.get("random_seed", 42)))
    scaling = engineering.get("scaling", {})
    if scaling.get("enabled", True):
        stages.append(DataScaler(method=scaling.get("method", "standard"), exclude=[*keys, label]))
    if config.get("feature_selection"):
        sel = config["feature_selection"]
        stages.append(FeatureSelector(method=sel.get("method", "recursive_elimination"),
                                      max_features=sel.get("max_features", 50), label=label, keys=keys))
    return stages


def fit_stages(stages: Sequence, df: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """Fit the stages in order. Where a stage offers ``fit_transform``, its training output is used
    for the later stages, so out-of-fold encodings reach the learner."""
    fitted = []
    for stage in stages:
        if isinstance(stage, Transformer):
            fitted.append(stage)
            df = stage.transform(df)
        elif hasattr(stage, "fit_transform"):
            model, df = stage.fit_transform(df)
            fitted.append(model)
        else:
            model = stage.fit(df)
            fitted.append(model)
            df = model.transform(df)
        if isinstance(stage, TemporalFeatureEngineer):
            df = materialize(df, "temporal")        # the later fits read the windows, not redo them
    return PipelineModel(stages=fitted), df
