"""Filling missing values: fit is one aggregate job (plus one count of values for modes)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gable.operators.spread import exact_quantiles
from gable.operators.stages import FittedModel, FittedStage, columns_of, numeric_columns, with_state

NUMERIC = ("mean", "median", "most_frequent", "constant")
CATEGORICAL = ("most_frequent", "constant")


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Most frequent non-null value per column, the smallest among equals.

    Values are counted by (column, value) with a map-side combine; one row per column reaches the driver.
    """
    found: dict[str, object] = {}
    numbers = [c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)]
    for group, kind in ((numbers, "double"), ([c for c in cols if c not in numbers], "string")):
        if not group:
            continue
        pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast(kind).alias("v")) for c in group])
        counts = df.select(F.inline(pairs)).filter("v IS NOT NULL").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("c").agg(F.min(F.struct(-F.col("n"), F.col("v").alias("v"))).alias("best"))
        found |= {r["c"]: r["v"] for r in best.select("c", "best.v").collect()}
    for c in numbers:
        if c in found and isinstance(df.schema[c].dataType, T.IntegralType):
            found[c] = int(found[c])
    return found


def learn_fills(
    df: DataFrame, plan: dict[str, tuple[str, object]]
) -> dict[str, object]:
    """Fill value per column of ``{column: (strategy, constant)}``; columns without any value are left out."""
    extra = [F.count(c).alias(f"n__{c}") for c in plan]
    extra += [F.avg(c).alias(f"mean__{c}") for c, (s, _) in plan.items() if s == "mean"]
    medians = {f"median__{c}": (c, 0.5) for c, (s, _) in plan.items() if s == "median"}
    one = exact_quantiles(df, medians, (), extra) if medians else df.agg(*extra)
    row = one.first()
    present = {c: p for c, p in plan.items() if row[f"n__{c}"]}
    modes = column_modes(df, [c for c, (s, _) in present.items() if s == "most_frequent"])
    fills: dict[str, object] = {}
    for c, (strategy, constant) in present.items():
        if strategy in ("mean", "median"):
            fills[c] = row[f"{strategy}__{c}"]
        elif strategy == "most_frequent":
            fills[c] = modes[c]
        elif constant is not None:
            fills[c] = constant
        else:
            fills[c] = 0 if isinstance(df.schema[c].dataType, T.NumericType) else "missing_value"
    return fills


class ImputerModel(FittedModel):
    """Coalesce with the learned value; columns that held no value at fit time are dropped."""

    DEFAULTS = with_state({})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills, dropped = self.learned["fills"], self.learned["dropped"]
        made = {}
        for c, v in fills.items():
            kind = dataset.schema[c].dataType
            if isinstance(kind, T.IntegralType) and isinstance(v, float):
                # A mean or median turns whole numbers into doubles, whatever its value.
                made[c] = F.coalesce(F.col(c).cast("double"), F.lit(v))
            else:
                made[c] = F.coalesce(F.col(c), F.lit(v).cast(kind))
        return dataset.withColumns(made).drop(*dropped) if made else dataset.drop(*dropped)

    def provenance(self):
        return {c: [c] for c in self.learned["fills"]}


class _ImputerStage(FittedStage):
    def plan(self, df: DataFrame) -> dict[str, tuple[str, object]]:
        raise NotImplementedError

    def _fit(self, dataset: DataFrame) -> ImputerModel:
        plan = self.plan(dataset)
        fills = learn_fills(dataset, plan) if plan else {}
        return ImputerModel(state={"fills": fills, "dropped": [c for c in plan if c not in fills]})


class Imputer(_ImputerStage):
    """Numbers and categories are filled by separate strategies."""

    DEFAULTS = {
        "categorical_strategy": "most_frequent",
        "numeric_strategy": "mean",
        "categorical_fill_value": None,
        "numeric_fill_value": None,
        "ignore": ["unit_indx"],
    }

    def __init__(self, **options):
        super().__init__(**options)
        if self.opt("categorical_strategy") not in CATEGORICAL:
            raise ValueError(f"invalid categorical strategy; choose from {CATEGORICAL}")
        if self.opt("numeric_strategy") not in NUMERIC:
            raise ValueError(f"invalid numeric strategy; choose from {NUMERIC}")

    def plan(self, df):
        numbers = numeric_columns(df)
        others = columns_of(df, T.StringType, T.BooleanType)
        plan = {c: (self.opt("numeric_strategy"), self.opt("numeric_fill_value")) for c in numbers}
        plan |= {c: (self.opt("categorical_strategy"), self.opt("categorical_fill_value")) for c in others}
        return {c: plan[c] for c in df.columns if c in plan and c not in self.opt("ignore")}


class SimpleImputer(_ImputerStage):
    """One strategy for every column; an all-boolean frame is returned as it is."""

    DEFAULTS = {
        "strategy": "most_frequent",
        "fill_value": None,
        "ignore": ["unit_indx"],
    }

    def plan(self, df):
        if self.opt("strategy") not in NUMERIC:
            raise ValueError(f"invalid strategy; choose from {NUMERIC}")
        cols = [c for c in columns_of(df, T.NumericType, T.StringType, T.BooleanType) if c not in self.opt("ignore")]
        if all(isinstance(df.schema[c].dataType, T.BooleanType) for c in cols):
            return {}
        if self.opt("strategy") in ("mean", "median") and set(cols) - set(numeric_columns(df)):
            raise ValueError(f"{self.opt('strategy')} needs numeric columns only")
        return {c: (self.opt("strategy"), self.opt("fill_value")) for c in cols}


class PerColumnImputer(_ImputerStage):
    """``impute_strategies``: column -> {"impute_strategy": ..., "fill_value": ...}."""

    DEFAULTS = {
        "impute_strategies": {},
        "default_strategy": "most_frequent",
        "ignore": ["unit_indx"],
    }

    def plan(self, df):
        asked = self.opt("impute_strategies")
        if not isinstance(asked, dict):
            raise ValueError("impute_strategies must be a dictionary of column to strategy")
        plan = {}
        for c in columns_of(df, T.NumericType, T.StringType, T.BooleanType):
            if c not in self.opt("ignore"):
                own = asked.get(c, {})
                plan[c] = (own.get("impute_strategy", self.opt("default_strategy")), own.get("fill_value"))
        return plan
