"""Comparables: group aggregates of similar properties, joined back to units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gable.functions import domain as D
from gable.operators.spread import exact_quantiles, lookup_join
from gable.operators.stages import FittedModel, FittedStage, WithTable, one_of, with_state
from gable.runtime import written

OPS = ("mean", "std", "min", "median", "max")


def build_lookup(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    price: str | None = None,
    ops: Sequence[str] = OPS,
) -> DataFrame:
    """Per key: ``<col>__<op>`` for each feature and price, and ``density_count`` (rows in the group)."""
    plain = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    cols = [*features, *([price] if price else [])]
    extra = [F.count(F.lit(1)).alias("density_count")]
    extra += [plain[op](c).alias(f"{c}__{op}") for c in cols for op in ops if op in plain]
    medians = {f"{c}__median": (c, 0.5) for c in cols} if "median" in ops else {}
    out = exact_quantiles(df, medians, keys, extra) if medians else df.groupBy(*keys).agg(*extra)
    return out.select(*keys, *[f"{c}__{op}" for c in cols for op in ops], "density_count")


def add_lookup(
    units: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join the lookup to units; heavy groups are spread by their ``density_count``."""
    weight = "density_count" if "density_count" in lookup.columns else None
    return lookup_join(units, lookup, keys, how, weight)


def minus_features(df: DataFrame, features: Sequence[str], ops: Sequence[str] = OPS) -> DataFrame:
    """Replace each feature aggregate by unit value minus aggregate; price aggregates stay."""
    made = {f"{c}_minus_{op}": F.col(c) - F.col(f"{c}__{op}") for c in features for op in ops}
    return df.withColumns(made).drop(*[f"{c}__{op}" for c in features for op in ops])


def comparables_features(
    units: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    ops: Sequence[str] = OPS,
) -> DataFrame:
    return minus_features(add_lookup(units, lookup, keys), features, ops)


def merge_train_with_lookup(
    train: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    price: str,
    carried: Sequence[str],
) -> DataFrame:
    """Inner-join form: every number whose name contains a feature name is subtracted from that feature,
    price aggregates are copied, and the carried columns follow."""
    # The lookup may name its type key with a trailing double underscore.
    lookup = lookup.withColumnsRenamed({f"{k}__": k for k in keys})
    merged = add_lookup(train, lookup, keys, "inner")
    out: list[Column] = []
    numbers = [f.name for f in merged.schema.fields if isinstance(f.dataType, T.NumericType)]
    for base in features:
        related = [c for c in numbers if base in c and c != base]
        out += [(F.col(base) - F.col(c)).alias(f"{base}_minus_{c}") for c in related]
    out += [F.col(c) for c in merged.columns if price in c and c != price]
    return merged.select(*out, *carried)


def neighbourhood_stats(
    units: DataFrame, lat: str, lon: str, value: str, half_side: float = D.HALF_SIDE_METRES
) -> DataFrame:
    """Per distinct location (radians): units and mean value inside the box around it.

    Units are first summed per location, so a location shared by many units is one row. Locations meet by
    a grid cell as wide as the box is high (latitude), then the exact box test decides.
    """
    spots = units.groupBy(lat, lon).agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_sum"), F.count(value).alias("_k"))
    # The polar radius is the smallest radius, so this step is at least the half height of any box.
    step = half_side / D.WGS84_B * 1.01
    bounds = {
        "_lat0": D.lat_min(lat, half_side), "_lat1": D.lat_max(lat, half_side),
        "_lon0": D.lon_min(lat, lon, half_side), "_lon1": D.lon_max(lat, lon, half_side),
    }
    # Longitude width depends on latitude; the band row fixes one longitude step for both sides.
    row = F.floor(F.col(lat) / step)
    boxes = spots.select(lat, lon).withColumns(bounds).withColumn("_row", F.explode(F.sequence(row - 1, row + 1)))
    # Widest half width within the rows a box can reach: at the poleward edge of the band.
    poleward = F.least((F.greatest(F.abs(F.col("_row")), F.abs(F.col("_row") + 1)) + 1) * step, F.lit(1.5))
    boxes = boxes.withColumn("_lon_step", half_side / (D.WGS84_B * F.cos(poleward)) * 1.01)
    boxes = boxes.withColumn(
        "_cell",
        F.explode(F.sequence(F.floor(F.col("_lon0") / F.col("_lon_step")), F.floor(F.col("_lon1") / F.col("_lon_step")))),
    )
    there = spots.withColumn("_row", row)
    poleward = F.least((F.greatest(F.abs(F.col("_row")), F.abs(F.col("_row") + 1)) + 1) * step, F.lit(1.5))
    there = there.select(
        "_row",
        F.floor(F.col(lon) / (half_side / (D.WGS84_B * F.cos(poleward)) * 1.01)).alias("_cell"),
        F.col(lat).alias("_there_lat"), F.col(lon).alias("_there_lon"), "_n", "_sum", "_k",
    )
    inside = boxes.join(there, ["_row", "_cell"]).filter(
        F.col("_there_lat").between(F.col("_lat0"), F.col("_lat1"))
        & F.col("_there_lon").between(F.col("_lon0"), F.col("_lon1"))
    )
    return inside.groupBy(lat, lon).agg(
        F.sum("_n").alias("n_nearby"), F.try_divide(F.sum("_sum"), F.sum("_k")).alias("mean_nearby")
    )


_COMPARABLES = {"keys": [], "features": [], "price": None, "ops": list(OPS)}


class ComparablesModel(WithTable, FittedModel):
    """Joins the lookup of the training rows and turns feature aggregates into differences."""

    DEFAULTS = with_state(_COMPARABLES)

    def __init__(self, table: DataFrame | None = None, **options):
        super().__init__(**options)
        self.table = table

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return comparables_features(dataset, self.table, self.opt("keys"), self.opt("features"), self.opt("ops"))

    def provenance(self):
        return {c: [f"{c}_minus_{op}" for op in self.opt("ops")] for c in self.opt("features")}


class Comparables(FittedStage):
    """Aggregates of the training rows per key as features: what a unit has above its group, and the group's prices.

    The lookup stays a distributed table. Units of a key that training has not seen get nulls.
    """

    DEFAULTS = _COMPARABLES
    MODEL = ComparablesModel

    def __init__(self, **options):
        super().__init__(**options)
        one_of(self, ops=OPS)

    def _fit(self, dataset: DataFrame) -> ComparablesModel:
        lookup = build_lookup(dataset, self.opt("keys"), self.opt("features"), self.opt("price"), self.opt("ops"))
        return ComparablesModel(table=written(lookup), **self.options(), state={"fitted": True})
