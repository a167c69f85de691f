"""One-hot and target encoding."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gable.operators.spread import lookup_join
from gable.operators.stages import FittedModel, FittedStage, columns_of, one_of, with_state
from gable.runtime import written

_ONE_HOT = {
    "top_n": 100,
    "features_to_encode": None,
    "categories": None,
    "drop": None,
    "handle_unknown": "ignore",
    "handle_missing": "error",
}


# Most indicator columns that a feature may add when top_n is None.
MAX_CATEGORIES = 10_000


class OneHotEncoderModel(FittedModel):
    DEFAULTS = with_state(_ONE_HOT)

    def categories_of(self, feature: str) -> list[str]:
        """Categories of a feature, in output order."""
        if feature not in self.learned:
            raise ValueError(f"no categories were learned for {feature}")
        return list(self.learned[feature])

    def kept(self, feature: str) -> list[str]:
        """Categories that get a column, after the ``drop`` option."""
        found = self.categories_of(feature)
        if self.opt("drop") == "first" or (self.opt("drop") == "if_binary" and len(found) == 2):
            return found[1:]
        return found

    def get_feature_names(self) -> list[str]:
        return [f"{c}_{v}" for c in self.learned for v in self.kept(c)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        made = {}
        for c in self.learned:
            value = F.col(c).cast("string")
            if self.opt("handle_missing") == "as_category":
                value = F.coalesce(value, F.lit("nan"))
            if self.opt("handle_unknown") == "error":
                known = value.isNull() | value.isin(self.categories_of(c))
                value = F.when(known, value).otherwise(F.raise_error(F.concat(F.lit(f"unknown category in {c}: "), value)))
            for v in self.kept(c):
                made[f"{c}_{v}"] = F.coalesce((value == v).cast("double"), F.lit(0.0))
        return dataset.withColumns(made).drop(*self.learned) if made else dataset.drop(*self.learned)

    def provenance(self):
        return {c: [f"{c}_{v}" for v in self.kept(c)] for c in self.learned}


class OneHotEncoder(FittedStage):
    """Indicator columns of the most frequent categories; ties go to the smaller value.

    Each column contributes at most ``top_n`` rows to the driver.
    """

    DEFAULTS = _ONE_HOT
    MODEL = OneHotEncoderModel

    def __init__(self, **options):
        listed = options.get("categories") is not None
        if listed and options.get("top_n") is not None:
            raise ValueError("give either the categories or how many to keep")
        super().__init__(**options, **({"top_n": None} if listed and "top_n" not in options else {}))
        one_of(self, handle_unknown=("ignore", "error"), handle_missing=("as_category", "error"), drop=(None, "first", "if_binary"))

    def learn(self, df):
        cols = self.opt("features_to_encode") or columns_of(df, T.StringType)
        if not set(cols) <= set(df.columns):
            raise ValueError(f"columns to encode that are not there: {sorted(set(cols) - set(df.columns))}")
        given = self.opt("categories")
        if given is not None:
            if len(given) != len(cols):
                raise ValueError(f"{len(cols)} columns need as many lists of categories, not {len(given)}")
            return {c: [str(v) for v in values] for c, values in zip(cols, given)}
        if not cols:
            return {}
        tops = []
        for c in cols:
            value = F.col(c).cast("string")
            if self.opt("handle_missing") == "as_category":
                value = F.coalesce(value, F.lit("nan"))
            counts = df.select(value.alias("v")).filter("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
            # Without top_n every category counts, as long as there are no more than MAX_CATEGORIES.
            counts = counts.orderBy(F.desc("n"), "v").limit(MAX_CATEGORIES + 1 if self.opt("top_n") is None else self.opt("top_n"))
            tops.append(counts.select(F.lit(c).alias("c"), "v"))
        state: dict[str, list[str]] = {c: [] for c in cols}
        for r in reduce(DataFrame.unionByName, tops).collect():
            state[r["c"]].append(r["v"])
        if self.opt("top_n") is None and any(len(v) > MAX_CATEGORIES for v in state.values()):
            raise ValueError(f"more than {MAX_CATEGORIES} categories in one column: choose top_n")
        return {c: sorted(v) for c, v in state.items()}


_TARGET = {
    "cols": None,
    "target": None,
    "smoothing": 1.0,
    "handle_unknown": "value",
    "handle_missing": "value",
}
_HANDLING = ("value", "error", "return_nan")


class TargetEncoderModel(FittedModel):
    """Joins the learned (value, encoding) table of each column; the table stays distributed."""

    DEFAULTS = with_state(_TARGET)

    def __init__(self, mapping: DataFrame | None = None, **options):
        super().__init__(**options)
        self.mapping = mapping

    def _transform(self, dataset: DataFrame) -> DataFrame:
        prior = F.lit(self.learned["prior"])
        for c in self.learned["cols"]:
            table = self.mapping.filter(F.col("column") == c).select(
                F.col("value").alias("_value"), F.col("encoded").alias("_encoded"), F.col("n").alias("_n")
            )
            rows = dataset.withColumn("_value", F.col(c).cast("string"))
            joined = lookup_join(rows, table, ["_value"], weight="_n")
            encoded = (
                F.when(F.col("_encoded").isNotNull(), F.col("_encoded"))
                .when(F.col("_value").isNull(), self._otherwise("handle_missing", c, prior))
                .otherwise(self._otherwise("handle_unknown", c, prior))
            )
            joined = joined.withColumn(c, encoded)
            dataset = joined.select(*dataset.columns)
        return dataset

    def _otherwise(self, option: str, column: str, prior):
        if self.opt(option) == "value":
            return prior
        if self.opt(option) == "error":
            return F.raise_error(F.lit(f"{option.split('_')[1]} value in {column}")).cast("double")
        return F.lit(None).cast("double")

    def provenance(self):
        return {c: [c] for c in self.learned["cols"]}

    def write(self) -> MLWriter:
        return _TargetEncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TargetEncoderReader(cls)


class _TargetEncoderWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.mapping.write.parquet(f"{path}/mapping")


class _TargetEncoderReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.mapping = self.sparkSession.read.parquet(f"{path}/mapping")
        return model


class TargetEncoder(FittedStage):
    """Category mean of the target, shrunk to the overall mean for rare categories.

    weight = 1 / (1 + exp(-(n - 1) / smoothing)); a category seen once takes the overall mean.
    """

    DEFAULTS = _TARGET
    MODEL = TargetEncoderModel

    def __init__(self, **options):
        super().__init__(**options)
        one_of(self, handle_unknown=_HANDLING, handle_missing=_HANDLING)
        if not self.opt("smoothing") > 0:
            raise ValueError("smoothing must be positive")

    def _fit(self, dataset):
        cols = self.opt("cols") or [c for c in columns_of(dataset, T.StringType) if c != self.opt("target")]
        y = F.col(self.opt("target")).cast("double")
        prior = dataset.agg(F.avg(y)).first()[0]
        pairs = F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
        )
        stats = (
            dataset.select(y.alias("_y"), F.inline(pairs))
            .filter("value IS NOT NULL")
            .groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("mean"))
        )
        weight = 1 / (1 + F.exp(-(F.col("n") - 1) / F.lit(float(self.opt("smoothing")))))
        encoded = F.when(F.col("n") == 1, F.lit(prior)).otherwise(F.lit(prior) * (1 - weight) + F.col("mean") * weight)
        mapping = stats.select("column", "value", "n", encoded.alias("encoded")).transform(written)
        return TargetEncoderModel(mapping=mapping, **self.options(), state={"cols": cols, "prior": prior})
