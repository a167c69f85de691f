"""Property rows derived from the sales tables, as a DataFrame and as SQL text.

An order is a sale, its customer gives postcode and property type, its line items give floor area, rooms
and floor label. Prices are whole pounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.functions import domain as D
from gable.operators.comparables import build_lookup
from gable.operators.spread import lookup_join

# ---- fixed values: floor label per highest line number --------------------------------------------
LINE_FLOORS = {1: "Ground", 2: "1st", 3: "2nd", 4: "NO DATA!", 5: "mid floor", 6: "top floor"}
OTHER_FLOOR = "7th"
# -------------------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def property_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    floor = F.col("last_line")
    label = None
    for line, text in LINE_FLOORS.items():
        label = F.when(floor == line, text) if label is None else label.when(floor == line, text)
    rooms = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("unit_indx"))
        .agg(F.sum("l_quantity").alias("area"), F.count(F.lit(1)).alias("rooms"), F.max("l_linenumber").alias("last_line"))
        .withColumn("floor_label", label.otherwise(OTHER_FLOOR))
        .drop("last_line")
    )
    town = F.when(F.col("c_nationkey") % 2 == 0, "E").otherwise("NW")
    sales = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("unit_indx"),
        F.floor("o_totalprice").cast("double").alias("price_p"),
        F.col("o_orderdate").alias("sold_at"),
        F.concat(
            town, F.col("c_nationkey").cast("string"), F.lit(" "), (F.col("c_custkey") % 4).cast("string"), F.lit("AB")
        ).alias("postcode"),
        F.col("c_mktsegment").alias("property_type"),
    )
    return sales.join(rooms, "unit_indx", "left")


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property rows with the derived postcode parts, floor number, heated rooms and comparables key."""
    rows = property_rows(spark, sf_dir).withColumns(
        {
            "postcode_outcode": D.postcode_outcode("postcode"),
            "floor_level": D.floor_level("floor_label"),
            "heated_rooms": D.heated_rooms("rooms"),
        }
    )
    rows = rows.withColumn("postcode_area", D.postcode_area("postcode_outcode"))
    return rows.withColumn("key", D.composite_key("postcode_area", "property_type"))


def valued_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units with a deterministic valuation: the mean price of their (postcode, property type) group."""
    rows = units(spark, sf_dir)
    keys = ["postcode", "property_type"]
    means = build_lookup(rows, keys, [], "price_p", ops=["mean"])
    return lookup_join(
        rows, means, keys, weight="density_count"
    ).withColumnRenamed("price_p__mean", "avm")


PROPERTY_SQL = """property AS (
  SELECT o_orderkey AS unit_indx, CAST(floor(o_totalprice) AS DOUBLE) AS price_p, o_orderdate AS sold_at,
         CASE WHEN c_nationkey % 2 = 0 THEN 'E' ELSE 'NW' END || CAST(c_nationkey AS VARCHAR) || ' '
           || CAST(c_custkey % 4 AS VARCHAR) || 'AB' AS postcode,
         c_mktsegment AS property_type, area, rooms, floor_label
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (
    SELECT l_orderkey, sum(l_quantity) AS area, count(*) AS rooms,
           CASE max(l_linenumber) WHEN 1 THEN 'Ground' WHEN 2 THEN '1st' WHEN 3 THEN '2nd' WHEN 4 THEN 'NO DATA!'
             WHEN 5 THEN 'mid floor' WHEN 6 THEN 'top floor' ELSE '7th' END AS floor_label
    FROM lineitem GROUP BY l_orderkey
  ) l ON l_orderkey = o_orderkey
)"""

UNITS_SQL = (
    PROPERTY_SQL
    + """, units AS (
  SELECT *, postcode_area || '_' || property_type AS key FROM (
    SELECT *, CASE WHEN regexp_matches(substr(postcode_outcode, 2, 1), '^[0-9]$') THEN substr(postcode_outcode, 1, 1)
                ELSE substr(postcode_outcode, 1, 2) END AS postcode_area
    FROM (
      SELECT *, split_part(postcode, ' ', 1) AS postcode_outcode,
        CAST(CASE floor_label WHEN 'Ground' THEN 0 WHEN '1st' THEN 1 WHEN '2nd' THEN 2 WHEN 'NO DATA!' THEN 0
          WHEN 'mid floor' THEN 3 WHEN 'top floor' THEN 22 END AS DOUBLE) AS floor_level,
        CAST(coalesce(rooms, 0) AS DOUBLE) AS heated_rooms
      FROM property))
)"""
)

VALUED_SQL = (
    UNITS_SQL
    + """, valued AS (
  SELECT u.*, m.avm FROM units u
  JOIN (SELECT postcode, property_type, avg(price_p) AS avm FROM units GROUP BY postcode, property_type) m
    ON u.postcode = m.postcode AND u.property_type = m.property_type
)"""
)


def with_sql(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"
