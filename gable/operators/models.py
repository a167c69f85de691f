"""Regression models on Spark ML: baselines, blending, stacking, search, time series and explanation tables."""

from __future__ import annotations

import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gable.operators.knn import KNeighborsRegressor
from gable.operators.metrics import column_name, get_metric, regression_scores
from gable.operators.profile import literal_rows
from gable.operators.select import importance_table
from gable.operators.splits import k_fold
from gable.operators.stages import FittedModel, FittedStage, WithParts, one_of, with_state
from gable.operators.timeseries import DelayedFeatureTransformer, shifted

# ---- fixed values: default settings of the valuation models ------------------------------------------------
TREE_DEFAULTS = {"learning_rate": 0.06325, "max_depth": 14, "n_estimators": 766, "min_child_weight": 0.672}
KNN_DEFAULTS = {"n_neighbors": 5, "weights": "distance"}
STACKING_FOLDS = 3
# -----------------------------------------------------------------------------------------------------------


def _assembled(features: Sequence[str], output: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="keep")


def linear_regressor(
    features: Sequence[str], label: str, prediction: str = "prediction", fit_intercept: bool = True, normalize: bool = False
) -> Pipeline:
    """Ordinary least squares by the normal equations."""
    model = LinearRegression(
        featuresCol=f"_{prediction}_features", labelCol=label, predictionCol=prediction,
        fitIntercept=fit_intercept, standardization=normalize, regParam=0.0, solver="normal",
    )
    return Pipeline(stages=[_assembled(features, f"_{prediction}_features"), model])


def tree_regressor(
    features: Sequence[str],
    label: str,
    prediction: str = "prediction",
    n_estimators: int = TREE_DEFAULTS["n_estimators"],
    max_depth: int = TREE_DEFAULTS["max_depth"],
    learning_rate: float = TREE_DEFAULTS["learning_rate"],
    min_child_weight: float = TREE_DEFAULTS["min_child_weight"],
    seed: int = 0,
) -> Pipeline:
    """Gradient-boosted trees on the squared error; Spark allows a depth of up to 30."""
    model = GBTRegressor(
        featuresCol=f"_{prediction}_features", labelCol=label, predictionCol=prediction, maxIter=n_estimators,
        maxDepth=max_depth, stepSize=learning_rate, minInstancesPerNode=max(1, round(min_child_weight)), seed=seed,
    )
    return Pipeline(stages=[_assembled(features, f"_{prediction}_features"), model])


def forest_regressor(
    features: Sequence[str], label: str, prediction: str = "prediction", n_estimators: int = 20, max_depth: int = 5, seed: int = 0
) -> Pipeline:
    """Random forest: takes the place of a neural network in a blend."""
    model = RandomForestRegressor(
        featuresCol=f"_{prediction}_features", labelCol=label, predictionCol=prediction,
        numTrees=n_estimators, maxDepth=max_depth, seed=seed,
    )
    return Pipeline(stages=[_assembled(features, f"_{prediction}_features"), model])


def knn_regressor(
    features: Sequence[str], label: str, prediction: str = "prediction", key: str = "unit_indx", **options
) -> KNeighborsRegressor:
    return KNeighborsRegressor(features=list(features), label=label, prediction=prediction, key=key, **{**KNN_DEFAULTS, **options})


def fit_cached(estimator: Estimator, df: DataFrame) -> Model:
    """Fit with the training rows kept (memory, then disk) while an estimator passes over them."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(kept)
    finally:
        kept.unpersist()


# ---- baselines ------------------------------------------------------------------------------------------------
class MeanBaselineModel(FittedModel):
    DEFAULTS = with_state({"label": None, "prediction": "prediction"})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.opt("prediction"), F.lit(self.learned["mean"]))


class MeanBaseline(FittedStage):
    """Predicts the mean of the training target."""

    DEFAULTS = {"label": None, "prediction": "prediction"}
    MODEL = MeanBaselineModel

    def learn(self, df):
        return {"mean": df.agg(F.avg(self.opt("label"))).first()[0]}


def last_value_baseline(
    df: DataFrame, order: Sequence[str], target: str, series: Sequence[str] = (), gap: int = 1,
    prediction: str = "prediction",
) -> DataFrame:
    """Predicts the value ``gap`` rows earlier (the value itself for gap 0 refers to the row before)."""
    return shifted(df, order, {prediction: (target, max(gap, 1))}, series)


# ---- blending and stacking ----------------------------------------------------------------------------------------
_BLEND = {"names": [], "key": None}


class BlendModel(WithParts, FittedModel):
    """The fitted base models and, last of its parts, the fitted final model."""

    DEFAULTS = with_state(_BLEND)

    def __init__(self, parts: Sequence[Model] = (), **options):
        super().__init__(**options)
        self.parts = list(parts)

    def n_parts(self) -> int:
        return len(self.opt("names")) + 1

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.parts[-1].transform(_apply_all(dataset, self.parts[:-1]))
        return out.drop(*[c for c in out.columns if c.startswith("_") and c.endswith("_features")])


class Blend(WithParts, FittedStage):
    """Base models whose predictions, as columns named after them, feed a final model.

    ``in_sample`` trains the final model on predictions for the rows the base models were fitted on;
    ``out_of_fold`` on predictions by models that did not see the row (k folds by key). A stage like any other: it can stand
    in a pipeline, be searched, saved and loaded, before and after it is fitted.
    """

    DEFAULTS = _BLEND | {"mode": "in_sample", "folds": STACKING_FOLDS, "seed": 0, "parallelism": 3}

    def __init__(self, bases: dict[str, Estimator] | None = None, final: Estimator | None = None, key: str | None = None, mode: str = "in_sample", **options):
        if bases is not None and not bases:
            raise ValueError("a blend needs at least one base model")
        bases = bases or {}
        if any(isinstance(b, (MeanBaseline, Blend)) for b in bases.values()):
            raise ValueError("baselines and stacked models cannot be stacked")
        super().__init__(names=list(bases), key=key, mode=mode, **options)
        one_of(self, mode=("in_sample", "out_of_fold"))
        self.parts = [*bases.values(), final]

    def n_parts(self) -> int:
        return len(self.opt("names")) + 1

    def _fit(self, dataset: DataFrame) -> BlendModel:
        kept = dataset.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            meta = self.out_of_fold(kept) if self.opt("mode") == "out_of_fold" else None
            with ThreadPoolExecutor(self.opt("parallelism")) as pool:
                fitted = list(pool.map(lambda b: b.fit(kept), self.parts[:-1]))
            final = fit_cached(self.parts[-1], _apply_all(kept, fitted) if meta is None else meta)
            return BlendModel([*fitted, final], names=self.opt("names"), key=self.opt("key"), state={"fitted": True})
        finally:
            kept.unpersist()

    def out_of_fold(self, df: DataFrame) -> DataFrame:
        """Every row once, with base predictions by models fitted on the other folds."""
        folded = k_fold(df, self.opt("key"), self.opt("folds"), seed=self.opt("seed"))

        def one(i: int) -> DataFrame:
            train, held = folded.filter(F.col("fold") != i), folded.filter(F.col("fold") == i)
            train = train.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                return _apply_all(held, [b.fit(train) for b in self.parts[:-1]])
            finally:
                train.unpersist()

        with ThreadPoolExecutor(self.opt("parallelism")) as pool:
            return reduce(DataFrame.unionByName, pool.map(one, range(self.opt("folds")))).drop("fold")


def _apply_all(df: DataFrame, fitted: Sequence[Model]) -> DataFrame:
    """Add every model's prediction column in place, so that nothing is aligned by position."""
    for model in fitted:
        df = model.transform(df)
    return df.drop(*[c for c in df.columns if c.startswith("_") and c.endswith("_features")])


def stacked_regressor(
    bases: dict[str, object], label: str, key: str, final=None, prediction: str = "stacked", folds: int = STACKING_FOLDS, seed: int = 0
) -> Blend:
    """Out-of-fold stacking with a linear final model unless another is given."""
    final = final or linear_regressor(list(bases), label, prediction)
    return Blend(bases, final, key, "out_of_fold", folds=folds, seed=seed)


# ---- importance and prediction tables ---------------------------------------------------------------------------------
def feature_importance(spark, fitted: PipelineModel, threshold: float | None = None) -> DataFrame:
    """(feature, importance) of a fitted pipeline that ends in a Spark ML model behind an assembler."""
    model = fitted.stages[-1]
    assembler = next(s for s in reversed(fitted.stages[:-1]) if isinstance(s, VectorAssembler))
    weights = model.coefficients if hasattr(model, "coefficients") else model.featureImportances
    return importance_table(spark, assembler.getInputCols(), weights.toArray(), threshold)


def partitioned_predict(fitted: Model, df: DataFrame, partitions: int | None = None, by: str | None = None) -> DataFrame:
    """Score in parallel; a partition count is only needed when the input files are too few or too large."""
    if partitions:
        df = df.repartition(partitions, by) if by else df.repartition(partitions)
    return fitted.transform(df)


def partial_dependence(fitted: Model, df: DataFrame, feature: str, grid: Sequence[float], prediction: str = "prediction") -> DataFrame:
    """Mean prediction with one feature set to each grid value: the grid is a small array exploded per row."""
    values = F.explode(F.array(*[F.lit(float(g)) for g in grid]))
    scored = fitted.transform(df.withColumn(feature, values))
    return scored.groupBy(F.col(feature).alias("value")).agg(F.avg(prediction).alias("mean_prediction"))


def quantile_grid(df: DataFrame, feature: str, points: int = 20) -> list[float]:
    """Grid of equally spaced quantiles (approximate: a grid needs no exact cut)."""
    probs = [i / (points - 1) for i in range(points)]
    found = df.agg(F.percentile_approx(feature, probs, 10_000)).first()[0]
    return sorted(set(float(v) for v in found))


# ---- hyper-parameter search -----------------------------------------------------------------------------------------------
class RegressionEvaluator(Evaluator):
    """Any regression metric of the registry as a Spark ML evaluator."""

    def __init__(self, metric: str, label: str, prediction: str = "prediction"):
        super().__init__()
        self.metric, self.label, self.prediction = metric, label, prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        row = regression_scores(dataset, self.label, self.prediction, [self.metric], ()).first()
        return float(row[column_name(self.metric)])

    def isLargerBetter(self) -> bool:
        return get_metric(self.metric).greater_is_better


def random_grid(space: dict, trials: int, seed: int = 0) -> list[dict]:
    """Distinct random points of ``{param: values}``."""
    draw = random.Random(seed)
    points: list[dict] = []
    most = 1
    for values in space.values():
        most *= len(values)
    while len(points) < min(trials, most):
        point = {p: draw.choice(list(values)) for p, values in space.items()}
        if point not in points:
            points.append(point)
    return points


def _held_out(df: DataFrame, key: str | None, train_ratio: float, seed: int) -> Column:
    """Whether a row is held out: by the hash of its key, or of its plain columns, so partitioning does not matter."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant", "udt")]
    parts = 1 << 20
    return F.pmod(F.xxhash64(F.lit(seed), *([key] if key else plain)), F.lit(parts)) >= int(train_ratio * parts)


def search(
    df: DataFrame, estimator: Estimator, points: list[dict], metric: str, label: str, prediction: str = "prediction",
    train_ratio: float = 0.8, parallelism: int = 3, seed: int = 0, key: str | None = None, fold_col: str | None = None,
) -> tuple[Model, DataFrame]:
    """Best model by a metric and the trials as (trial, parameters, metric), best first.

    A share of the rows is held out, chosen by the hash of ``key`` (or of all plain columns); ``fold_col`` names a column of
    whole numbers from 0 instead, each of which is held out once, and the trial's metric is the mean. Both repeat under any
    partitioning. The best point is fitted anew on all rows.
    """
    evaluator = RegressionEvaluator(metric, label, prediction)
    fold = F.col(fold_col) if fold_col else F.when(_held_out(df, key, train_ratio, seed), 0).otherwise(1)
    kept = df.withColumn("_fold", fold.cast("int")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        folds = range(kept.agg(F.max("_fold")).first()[0] + 1) if fold_col else [0]

        def trial(point: dict) -> float:
            scores = []
            for i in folds:
                model = estimator.fit(kept.filter(F.col("_fold") != i), point)
                scores.append(evaluator.evaluate(model.transform(kept.filter(F.col("_fold") == i))))
            return sum(scores) / len(scores)

        with ThreadPoolExecutor(parallelism) as pool:
            found = list(pool.map(trial, points))
        pick = max if evaluator.isLargerBetter() else min
        best = estimator.fit(kept, points[found.index(pick(found))])
    finally:
        kept.unpersist()
    rows = []
    for i, (point, value) in enumerate(zip(points, found)):
        text = ", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda kv: kv[0].name))
        rows.append((i, text, float(value)))
    trials = literal_rows(df.sparkSession, rows, ["trial", "parameters", "metric"])
    best_first = F.desc("metric") if evaluator.isLargerBetter() else F.asc("metric")
    return best, trials.orderBy(best_first, "trial")


# ---- time series -------------------------------------------------------------------------------------------------------------
_SERIES = {"order": [], "target": None, "features": [], "series": [], "gap": 1, "max_delay": 2}


class _Delayed(WithParts):
    """Delayed features by the stage's options; its one part works on them."""

    def n_parts(self) -> int:
        return 1

    @property
    def delays(self) -> DelayedFeatureTransformer:
        return DelayedFeatureTransformer(**{n: self.opt(n) for n in _SERIES})

    def input_columns(self) -> list[str]:
        return list(self.delays.shifts())


class TimeSeriesModel(_Delayed, FittedModel):
    DEFAULTS = with_state(_SERIES)

    def __init__(self, parts: Sequence[Model] = (), **options):
        super().__init__(**options)
        self.parts = list(parts)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        known: Column = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.input_columns()])
        out = self.parts[0].transform(self.delays.transform(dataset))
        # A row with a missing delay has a NaN in its assembled vector.
        return out.withColumn("prediction", F.when(known, F.col("prediction"))).select(*dataset.columns, "prediction")


class TimeSeriesRegressor(_Delayed, FittedStage):
    """Delayed features at a row predict the target ``gap`` rows later.

    Fit drops rows that lack a delay or a future target; the model returns every row, null where it has no features.
    ``make_estimator(inputs, label)`` gives the regressor; both stages save and load with it.
    """

    DEFAULTS = _SERIES

    def __init__(self, make_estimator=None, order: Sequence[str] = (), target: str | None = None, **options):
        super().__init__(order=list(order), target=target, **options)
        self.parts = [make_estimator(self.input_columns(), "_future")] if make_estimator else []

    def _fit(self, dataset: DataFrame) -> TimeSeriesModel:
        future = {"_future": (self.opt("target"), -self.opt("gap"))}
        rows = shifted(self.delays.transform(dataset), self.opt("order"), future, self.opt("series"))
        model = self.parts[0].fit(rows.na.drop(subset=[*self.input_columns(), "_future"]))
        return TimeSeriesModel([model], **self.options(), state={"fitted": True})
