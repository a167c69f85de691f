"""Preparation of raw merged price and certificate rows, and their enrichment for scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gable.functions import domain as D
from gable.operators import relational as R
from gable.operators.spread import lookup_join
from gable.operators.splits import split_by_key
from gable.runtime import written

# ---- fixed values: columns of a prepared row --------------------------------------------------------
PREPARED = [
    "POSTCODE",
    "POSTCODE_OUTCODE",
    "POSTCODE_AREA",
    "POSTTOWN_e",
    "PROPERTY_TYPE_e",
    "TOTAL_FLOOR_AREA_e",
    "NUMBER_HEATED_ROOMS_e",
    "FLOOR_LEVEL_e",
    "Latitude_m",
    "Longitude_m",
]
# -----------------------------------------------------------------------------------------------------


def raw_rows(rows: DataFrame) -> DataFrame:
    """Give property rows the column names of the raw merged files."""
    return rows.select(
        "unit_indx",
        F.col("price_p").alias("Price_p"),
        F.col("postcode").alias("Postcode"),
        F.concat(F.lit("1 High Street "), F.col("postcode")).alias("FULLADRESS_e"),
        F.lit(D.MATCH_TYPES[0]).alias("TypeOfMatching_m"),
        F.col("rooms").cast("string").alias("NUMBER_HABITABLE_ROOMS_e"),
        F.col("rooms").cast("string").alias("NUMBER_HEATED_ROOMS_e"),
        F.lit(None).cast("string").alias("FLAT_STOREY_COUNT_e"),
        F.col("area").cast("string").alias("TOTAL_FLOOR_AREA_e"),
        F.col("floor_label").alias("FLOOR_LEVEL_e"),
        F.col("property_type").alias("PROPERTY_TYPE_e"),
        F.concat(F.lit("TOWN "), D.postcode_outcode("postcode")).alias("POSTTOWN_e"),
        F.lit(51.5).alias("Latitude_m"),
        F.lit(-0.1).alias("Longitude_m"),
    )


def prepare(
    df: DataFrame,
    drop_outlier: bool = True,
    target: str = "Price_p",
    index: str = "unit_indx",
    order: list[str] | None = None,
) -> DataFrame:
    """Raw merged rows to prepared rows. ``order`` gives the row order used when there is no index yet."""
    if drop_outlier:
        df = R.drop_outliers(df, target)
    df = R.filter_match_types(df)
    if "POSTCODE_AREA" not in df.columns:
        df = df.withColumns(
            {"POSTCODE_OUTCODE": D.postcode_outcode("Postcode"), "_full": D.postcode_from_address("FULLADRESS_e")}
        )
        df = df.drop("Postcode").withColumnRenamed("_full", "POSTCODE")
        df = df.withColumn("POSTCODE_AREA", D.postcode_area("POSTCODE_OUTCODE"))
    if index not in df.columns:
        if not order:
            raise ValueError("rows need an index column or an order to number them by")
        df = R.with_row_index(df, order, index)
    df = df.withColumns(
        {
            "PROPERTY_TYPE_e": D.property_type("PROPERTY_TYPE_e"),
            "FLOOR_LEVEL_e": D.floor_level("FLOOR_LEVEL_e"),
            "NUMBER_HEATED_ROOMS_e": D.heated_rooms("NUMBER_HEATED_ROOMS_e"),
            "TOTAL_FLOOR_AREA_e": D.try_double("TOTAL_FLOOR_AREA_e"),
        }
    )
    kept = [index, *PREPARED]
    if target in df.columns:
        df = df.withColumn(target, D.try_double(target))
        kept.append(target)
    return df.select(*kept)


def prepare_and_split(
    df: DataFrame, target: str = "Price_p", test_size: float = 0.15, index: str = "unit_indx", seed: int = 0, **options,
) -> DataFrame:
    """Prepared rows with a ``split`` column: validate, train or test.

    A share of every postcode area is set aside as ``validate``; of the rest, rows with price and area whose
    (area, type) key occurs more than five times are split by that key. Other rows are left out.
    """
    # The splits read the prepared rows many times: they are written once.
    prepared = prepare(df, target=target, index=index, **options).transform(written)
    outer = split_by_key(prepared, index, test_size, ["POSTCODE_AREA"], seed, names=("rest", "validate"))
    aside = outer.filter("split = 'validate'")
    rest = R.drop_nan_target_rows(outer.filter("split = 'rest'"), target).na.drop(subset=["TOTAL_FLOOR_AREA_e"])
    rest = rest.drop("split").withColumn("key", D.composite_key("POSTCODE_AREA", "PROPERTY_TYPE_e"))
    rest = R.remove_rare_keys(rest, ["key"], 5)
    inner = split_by_key(rest, index, test_size, ["key"], seed + 1).drop("key")
    return inner.unionByName(aside)


def add_coordinates(
    rows: DataFrame,
    postcodes: DataFrame,
    outcodes: DataFrame,
    postcode: str = "postcode",
) -> DataFrame:
    """Latitude from the postcode table, else from the outcode table (joined on the computed outcode).

    ``postcodes`` has (postcode, latitude), ``outcodes`` has (outcode, outcode_latitude).
    """
    fine = lookup_join(rows, postcodes, [postcode])
    fine = fine.withColumn("outcode", D.postcode_outcode(postcode))
    coarse = lookup_join(fine, outcodes, ["outcode"])
    return coarse.withColumn("latitude", D.coordinate_fallback("latitude", "outcode_latitude")).drop("outcode_latitude")
