"""Reading property, price and coordinate tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gable.functions.domain import nan_to_null
from gable.operators.profile import number_of_features, target_distribution

# ---- fixed values: columns, types and fill values of a prepared property row ---------------------
PROPERTY_SCHEMA = T.StructType(
    [
        T.StructField("unit_indx", T.LongType()),
        T.StructField("POSTCODE", T.StringType()),
        T.StructField("POSTCODE_OUTCODE", T.StringType()),
        T.StructField("POSTCODE_AREA", T.StringType()),
        T.StructField("POSTTOWN_e", T.StringType()),
        T.StructField("PROPERTY_TYPE_e", T.StringType()),
        T.StructField("TOTAL_FLOOR_AREA_e", T.DoubleType()),
        T.StructField("NUMBER_HEATED_ROOMS_e", T.DoubleType()),
        T.StructField("FLOOR_LEVEL_e", T.DoubleType()),
        T.StructField("Latitude_m", T.DoubleType()),
        T.StructField("Longitude_m", T.DoubleType()),
        T.StructField("Price_p", T.DoubleType()),
    ]
)
PROPERTY_FILL = {
    "POSTCODE": "None",
    "POSTCODE_OUTCODE": "None",
    "POSTCODE_AREA": "None",
    "POSTTOWN_e": "None",
    "PROPERTY_TYPE_e": "None",
    "TOTAL_FLOOR_AREA_e": -1.0,
    "NUMBER_HEATED_ROOMS_e": -1.0,
    "FLOOR_LEVEL_e": 0.0,
    "Latitude_m": -1.0,
    "Longitude_m": -1.0,
    "Price_p": -1.0,
}
# -------------------------------------------------------------------------------------------------


def nulls_for_nans(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL once, at the source: Spark sorts NaN above every number."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(c) for c in floats}) if floats else df


def load_data(
    spark: SparkSession,
    path: str | Sequence[str],
    index: str | None,
    target: str,
    n_rows: int | None = None,
    drop: Sequence[str] = (),
    schema: T.StructType | str | None = None,
    verbose: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """CSV -> (features, target). Both keep ``index`` (if given), which replaces row alignment."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    paths = [path] if isinstance(path, str) else list(path)
    df = nulls_for_nans(reader.csv(paths))
    if n_rows is not None:
        df = (df.orderBy(index) if index else df).limit(n_rows)
    features = df.drop(target, *drop)
    labels = df.select(*([index] if index else []), target)
    if verbose:
        number_of_features(features).show(truncate=False)
        target_distribution(df, target).show(truncate=False)
    return features, labels


def read_parquet_prefix(spark: SparkSession, prefix: str, pattern: str = "*.parquet") -> DataFrame:
    """Every object below a prefix, with columns merged by name."""
    reader = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True)
    return nulls_for_nans(reader.option("pathGlobFilter", pattern).parquet(prefix))


def read_parquet_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return nulls_for_nans(spark.read.parquet(*paths))


def read_years(spark: SparkSession, template: str, years: Sequence[int]) -> DataFrame:
    """Union of one parquet set per year; a column absent from a year is null there."""
    frames = [spark.read.parquet(template.format(year=y)) for y in years]
    return nulls_for_nans(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames))


def register_parquet_view(spark: SparkSession, glob: str, view: str) -> DataFrame:
    df = nulls_for_nans(spark.read.format("parquet").load(glob))
    df.createOrReplaceTempView(view)
    return df


def register_csv_view(
    spark: SparkSession, path: str, view: str, schema: T.StructType | str | None = None
) -> DataFrame:
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = nulls_for_nans(reader.csv(path))
    df.createOrReplaceTempView(view)
    return df


def with_fill_values(df: DataFrame) -> DataFrame:
    """Apply the declared fill values of the prepared-row contract."""
    return df.na.fill({c: v for c, v in PROPERTY_FILL.items() if c in df.columns})


def conform(df: DataFrame) -> DataFrame:
    """Cast to the prepared-row contract; columns it lacks become null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in PROPERTY_SCHEMA.fields
        ]
    )
