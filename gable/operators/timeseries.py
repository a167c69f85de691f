"""Shifts, delayed features and polynomial detrending over an explicit row order."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gable.operators.spread import lookup_join, rank_by_order
from gable.operators.stages import ExpressionTransformer, FittedModel, FittedStage, with_state

CHUNK_ROWS = 1_000_000


def shifted(
    df: DataFrame,
    order: Sequence[str],
    shifts: dict[str, tuple[str, int]],
    series: Sequence[str] = (),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``{name: (column, k)}``: the value k rows earlier (later for negative k) in the series.

    Every series is cut into chunks of positions; rows near a chunk edge are copied to the neighbour chunk, so that
    every window sees its full reach.
    """
    back = max([k for _, k in shifts.values() if k > 0], default=0)
    ahead = max([-k for _, k in shifts.values() if k < 0], default=0)
    if chunk_rows <= max(back, ahead):
        raise ValueError("a chunk must be longer than the longest shift")
    ranked = rank_by_order(df, order, series, "_pos")
    chunk = F.floor((F.col("_pos") - 1) / chunk_rows)
    offset = (F.col("_pos") - 1) % chunk_rows
    homes = F.array(
        chunk,
        F.when(offset >= chunk_rows - back, chunk + 1),
        F.when((offset < ahead) & (chunk > 0), chunk - 1),
    )
    spread = ranked.withColumn("_home", chunk).withColumn("_chunk", F.explode(F.filter(homes, lambda h: h.isNotNull())))
    w = Window.partitionBy(*series, "_chunk").orderBy("_pos")
    out = spread.withColumns({n: F.lag(c, k).over(w) for n, (c, k) in shifts.items()})
    return out.filter(F.col("_chunk") == F.col("_home")).drop("_pos", "_home", "_chunk")


def ordinal_codes(df: DataFrame, col: str) -> DataFrame:
    """(value, code): 0-based code of each distinct value in sorted order."""
    values = df.select(F.col(col).alias("value")).filter("value IS NOT NULL").distinct()
    return rank_by_order(values, ["value"], (), "code").withColumn("code", (F.col("code") - 1).cast("double"))


class DelayedFeatureTransformer(ExpressionTransformer):
    """Add ``<c>_delay_t`` for features (t = 1..max_delay) and for the target (from 0 when there is a gap).

    Text columns are delayed as ordinal codes of their sorted values.
    """

    DEFAULTS = {
        "order": [],
        "series": [],
        "features": [],
        "target": None,
        "max_delay": 2,
        "gap": 1,
        "delay_features": True,
        "delay_target": True,
    }

    def shifts(self, columns: Sequence[str] | None = None) -> dict[str, tuple[str, int]]:
        """Delayed columns; without a target column (at scoring time) there are none of the target."""
        out = {}
        if self.opt("delay_features"):
            for c in self.opt("features"):
                out |= {f"{c}_delay_{t}": (c, t) for t in range(1, self.opt("max_delay") + 1)}
        if self.opt("delay_target") and self.opt("target") and (columns is None or self.opt("target") in columns):
            start = 1 if self.opt("gap") == 0 else 0
            c = self.opt("target")
            out |= {f"{c}_delay_{t}": (c, t) for t in range(start, self.opt("max_delay") + 1)}
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if not self.opt("order"):
            raise ValueError("delays need an order column")
        shifts = self.shifts(dataset.columns)
        rows = dataset
        coded = {}
        for c in dict.fromkeys(c for c, _ in shifts.values()):
            if isinstance(dataset.schema[c].dataType, T.StringType):
                codes = ordinal_codes(dataset, c).select(F.col("value").alias(c), F.col("code").alias(f"_code_{c}"))
                rows = lookup_join(rows, codes, [c])
                coded[c] = f"_code_{c}"
        plan = {n: (coded.get(c, c), t) for n, (c, t) in shifts.items()}
        out = shifted(rows, self.opt("order"), plan, self.opt("series"))
        return out.drop(*coded.values()).select(*dataset.columns, *shifts)

    def provenance(self):
        out: dict[str, list[str]] = {}
        for name, (c, _) in self.shifts().items():
            out.setdefault(c, []).append(name)
        return out


_TREND = {"target": None, "order": [], "degree": 1}


class PolynomialDetrenderModel(FittedModel):
    DEFAULTS = with_state(_TREND)

    def _placed(self, df: DataFrame) -> DataFrame:
        ranked = rank_by_order(df, self.opt("order"), (), "_pos")
        u = (F.col("_pos") - 1) / F.lit(float(self.learned["scale"]))
        trend = F.lit(0.0)
        for a in reversed(self.learned["coefficients"]):
            trend = trend * u + F.lit(float(a))
        return ranked.withColumn("_trend", trend)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        y = self.opt("target")
        return self._placed(dataset).withColumn(y, F.col(y) - F.col("_trend")).drop("_pos", "_trend")

    def inverse_transform(self, dataset: DataFrame) -> DataFrame:
        y = self.opt("target")
        return self._placed(dataset).withColumn(y, F.col(y) + F.col("_trend")).drop("_pos", "_trend")


class PolynomialDetrender(FittedStage):
    """Least-squares polynomial of the target on the row position, from one aggregate of power sums."""

    DEFAULTS = _TREND
    MODEL = PolynomialDetrenderModel

    def __init__(self, **options):
        super().__init__(**options)
        if not isinstance(self.opt("degree"), int) or isinstance(self.opt("degree"), bool):
            raise TypeError("the degree of the trend is a whole number")

    def learn(self, df):
        if not self.opt("target"):
            raise ValueError("a trend needs a target column")
        d, y = self.opt("degree"), F.col(self.opt("target")).cast("double")
        ranked = rank_by_order(df.select(*self.opt("order"), self.opt("target")), self.opt("order"), (), "_pos", "_n")
        # Positions are scaled to [0, 1], which keeps the power sums well conditioned.
        u = (F.col("_pos") - 1) / F.greatest(F.col("_n") - 1, F.lit(1))
        sums = ranked.agg(
            F.max("_n").alias("n"),
            *[F.sum(F.pow(u, F.lit(float(i)))).alias(f"u{i}") for i in range(2 * d + 1)],
            *[F.sum(F.pow(u, F.lit(float(i))) * y).alias(f"v{i}") for i in range(d + 1)],
        ).first()
        left = np.array([[sums[f"u{i + j}"] for j in range(d + 1)] for i in range(d + 1)])
        right = np.array([sums[f"v{i}"] for i in range(d + 1)])
        return {"coefficients": np.linalg.solve(left, right).tolist(), "scale": max(sums["n"] - 1, 1)}
