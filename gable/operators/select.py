"""Feature selection by forest importance, importance tables, and automatic features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gable.operators.profile import literal_rows
from gable.operators.stages import (
    ExpressionTransformer,
    FittedModel,
    FittedStage,
    columns_of,
    numeric_columns,
    time_columns,
    with_state,
)

_SELECT = {
    "columns": None,
    "target": None,
    "number_features": None,
    "n_estimators": 10,
    "max_depth": 5,
    "percent_features": 0.5,
    "threshold": None,
    "seed": 0,
}


class SelectFromModel(FittedModel):
    """Drops the input columns that were not selected."""

    DEFAULTS = with_state(_SELECT)

    def get_names(self) -> list[str]:
        return list(self.learned["selected"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*[c for c in self.learned["columns"] if c not in self.learned["selected"]])

    def provenance(self):
        return {c: [c] for c in self.get_names()}


class _ForestSelector(FittedStage):
    DEFAULTS = _SELECT
    MODEL = SelectFromModel
    FOREST: type

    def learn(self, df):
        y = self.opt("target")
        cols = self.opt("columns") or [c for c in numeric_columns(df) if c != y]
        rows = VectorAssembler(inputCols=cols, outputCol="_features", handleInvalid="skip").transform(df)
        forest = self.FOREST(
            featuresCol="_features", labelCol=y, numTrees=self.opt("n_estimators"), maxDepth=self.opt("max_depth"), seed=self.opt("seed")
        )
        weights = [float(w) for w in forest.fit(rows).featureImportances.toArray()]
        limit = sum(weights) / len(weights) if self.opt("threshold") == "mean" else self.opt("threshold")
        ranked = sorted(range(len(cols)), key=lambda i: (-weights[i], i))
        if self.opt("number_features"):
            ranked = ranked[: max(1, int(self.opt("percent_features") * self.opt("number_features")))]
        chosen = {cols[i] for i in ranked if limit is None or weights[i] >= limit}
        return {"columns": cols, "selected": [c for c in cols if c in chosen], "importances": weights}


class RFRegressorSelectFromModel(_ForestSelector):
    FOREST = RandomForestRegressor


class RFClassifierSelectFromModel(_ForestSelector):
    FOREST = RandomForestClassifier


def importance_table(spark: SparkSession, features: Sequence[str], weights: Sequence[float], threshold: float | None = None) -> DataFrame:
    """(feature, importance) by falling absolute importance, kept from a threshold on."""
    if threshold is not None and threshold < 0:
        raise ValueError("The provided importance threshold must be non-negative")
    rows = literal_rows(spark, [(f, float(w)) for f, w in zip(features, weights)], ["feature", "importance"])
    if threshold is not None:
        rows = rows.filter(F.abs("importance") >= threshold)
    return rows.orderBy(F.desc(F.abs("importance")), "feature")


def automatic_features(df: DataFrame, text: Sequence[str] = (), places: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Features generated from the schema: date parts, text counts, and distances between coordinate pairs.

    ``places`` lists (latitude, longitude) column pairs in degrees; every two pairs give a haversine in miles.
    """
    made = {}
    for c in time_columns(df):
        made |= {
            f"DAY({c})": F.dayofmonth(c),
            f"MONTH({c})": F.month(c),
            f"WEEKDAY({c})": F.weekday(c),
            f"YEAR({c})": F.year(c),
        }
    for c in text:
        made[f"NUM_CHARACTERS({c})"] = F.length(c)
        made[f"NUM_WORDS({c})"] = F.size(F.split(F.col(c), " "))
    for i, a in enumerate(places):
        for b in places[i + 1 :]:
            made[f"HAVERSINE({a[0]}, {b[0]})"] = haversine_miles(*a, *b)
    return df.withColumns(made).drop(*time_columns(df), *text) if made else df


# ---- fixed value: mean earth radius in miles --------------------------------------------------------------
EARTH_MILES = 3958.7613
# -----------------------------------------------------------------------------------------------------------


def haversine_miles(lat1: str, lon1: str, lat2: str, lon2: str):
    a1, a2 = F.radians(lat1), F.radians(lat2)
    half = F.pow(F.sin((a2 - a1) / 2), F.lit(2.0)) + F.cos(a1) * F.cos(a2) * F.pow(
        F.sin((F.radians(lon2) - F.radians(lon1)) / 2), F.lit(2.0)
    )
    return F.asin(F.sqrt(half)) * 2 * EARTH_MILES


class DFSTransformer(ExpressionTransformer):
    """Automatic features of one table, keeping its index column."""

    DEFAULTS = {"index": "index", "text_columns": [], "places": []}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.opt("index") not in dataset.columns:
            raise ValueError(f"index column {self.opt('index')} not found")
        return automatic_features(dataset, self.opt("text_columns"), [tuple(p) for p in self.opt("places")])


def string_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.StringType)
