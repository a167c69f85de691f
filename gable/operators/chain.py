"""Recommended preprocessing chains, feature provenance and the features-only part of a fitted chain."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gable.operators.dates import DateTimeFeaturizer
from gable.operators.encode import OneHotEncoder
from gable.operators.impute import Imputer
from gable.operators.profile import literal_rows, null_shares
from gable.operators.reduce import StandardScaler
from gable.operators.stages import ExpressionTransformer, columns_of, numeric_columns, time_columns
from gable.operators.text import TextFeaturizer
from gable.operators.timeseries import DelayedFeatureTransformer


class DropColumns(ExpressionTransformer):
    DEFAULTS = {"columns": []}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.opt("columns"))


class AssembleFeatures(ExpressionTransformer):
    """All numeric columns but the excluded ones, as the vector that Spark ML estimators read."""

    DEFAULTS = {"exclude": [], "columns": None, "output": "features"}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self.opt("columns") or [c for c in numeric_columns(dataset) if c not in self.opt("exclude")]
        return VectorAssembler(inputCols=cols, outputCol=self.opt("output"), handleInvalid="keep").transform(dataset)


def recommended_stages(
    df: DataFrame,
    target: str,
    problem_type: str = "regression",
    linear: bool = False,
    text: tuple[str, ...] = (),
    index: str = "unit_indx",
    order: list[str] | None = None,
    options: dict[str, dict] | None = None,
) -> list:
    """Stages that the schema calls for, in the usual order; ``options`` adds arguments by stage name."""
    options = options or {}

    def make(stage, **own):
        return stage(**{**own, **options.get(stage.__name__, {})})

    features = df.drop(target)
    stages: list = []
    empty = [c for c, s in null_shares(features).items() if s == 1]
    if empty:
        stages.append(make(DropColumns, columns=empty))
    live = features.drop(*empty)
    if columns_of(live, T.NumericType, T.StringType, T.BooleanType):
        ignored = [index, target, *text]
        stages.append(make(Imputer, ignore=ignored))
    if text:
        stages.append(make(TextFeaturizer, text_columns=list(text)))
    dates = time_columns(live)
    if problem_type.startswith("time series"):
        stages.append(make(DelayedFeatureTransformer, order=order or dates, features=numeric_columns(live.drop(index)), target=target))
    if dates:
        stages.append(make(DateTimeFeaturizer, columns=dates))
    categories = [c for c in columns_of(live, T.StringType) if c not in text]
    if categories:
        stages.append(make(OneHotEncoder, features_to_encode=categories))
    if linear:
        stages.append(make(StandardScaler, columns=[c for c in numeric_columns(live) if c != index]))
    return stages


def build_chain(df: DataFrame, target: str, estimator: Estimator, **how) -> Pipeline:
    """Recommended stages, feature assembly and the estimator as one Spark ML pipeline."""
    index = how.get("index", "unit_indx")
    stages = recommended_stages(df, target, **how)
    return Pipeline(stages=[*stages, AssembleFeatures(exclude=[index, target]), estimator])


def features_only(fitted: PipelineModel) -> PipelineModel:
    """Every stage but the final estimator."""
    return PipelineModel(fitted.stages[:-1])


def provenance(fitted: PipelineModel) -> dict[str, list[str]]:
    """Source column -> derived columns, followed through the stages."""
    reached: dict[str, list[str]] = {}
    for stage in fitted.stages:
        for source, derived in getattr(stage, "provenance", dict)().items():
            owners = [s for s, names in reached.items() if source in names] or [source]
            for owner in owners:
                others = [n for n in reached.get(owner, []) if n != source]
                reached[owner] = list(dict.fromkeys([*others, *derived]))
    return reached


def provenance_table(spark: SparkSession, fitted: PipelineModel) -> DataFrame:
    rows = [(s, d) for s, names in provenance(fitted).items() for d in names]
    return literal_rows(spark, rows, ["source", "derived"])
