"""Queries for sources, relational basics, domain functions, joins, aggregation and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from gable.functions import domain as D
from gable.operators import comparables as C
from gable.operators import prep as P
from gable.operators import profile as S
from gable.operators import relational as R
from gable.plans.property_view import PROPERTY_SQL, UNITS_SQL, VALUED_SQL, property_rows, table, units, valued_units, with_sql
from gable.plans.registry import SQL, query
from gable.runtime import scratch_path
from gable.sources import readers, writers

KEYS = ["postcode", "property_type"]
FEATURES = ["area", "heated_rooms", "floor_level"]


def _rounded(df, digits=6, but=()):
    """Round every double column, so that engines that sum in another order print the same."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double" and f.name not in but]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


# ---- comparables ---------------------------------------------------------------------------------
def _aggregates(cols, digits=4):
    parts = []
    for c in cols:
        for op, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("median", "median"), ("max", "max")):
            parts.append(f"round({f}({c}), {digits}) AS {c}__{op}")
    return ", ".join(parts)


LOOKUP_SQL = f"""lookup AS (SELECT postcode, property_type, {_aggregates([*FEATURES, "price_p"])},
  count(*) AS density_count FROM units GROUP BY postcode, property_type)"""


def _lookup(rows):
    frame = C.build_lookup(rows, KEYS, FEATURES, "price_p")
    return frame.select(*KEYS, *[F.round(c, 4).alias(c) for c in frame.columns if "__" in c], "density_count")


@query("comparables_lookup", "F1 F10", with_sql(f"{UNITS_SQL}, {LOOKUP_SQL}", "SELECT * FROM lookup"))
def comparables_lookup(spark, sf_dir):
    return _lookup(units(spark, sf_dir))


_MINUS = ", ".join(f"round({c} - {c}__{op}, 4) AS {c}_minus_{op}" for c in FEATURES for op in C.OPS)
_PRICES = ", ".join(f"price_p__{op}" for op in C.OPS)


@query(
    "comparables_features",
    "E1 E6 F2 F3 C8 B11 D20",
    with_sql(
        f"{UNITS_SQL}, {LOOKUP_SQL}",
        f"""SELECT u.unit_indx, u.postcode AS POSTCODE, u.property_type, u.key, {_MINUS}, {_PRICES}, density_count
        FROM units u LEFT JOIN lookup l ON u.postcode = l.postcode AND u.property_type = l.property_type""",
    ),
)
def comparables_features(spark, sf_dir):
    rows = units(spark, sf_dir)
    out = C.comparables_features(rows, _lookup(rows), KEYS, FEATURES)
    minus = [F.round(f"{c}_minus_{op}", 4).alias(f"{c}_minus_{op}") for c in FEATURES for op in C.OPS]
    prices = [f"price_p__{op}" for op in C.OPS]
    out = R.rename(out, {"postcode": "POSTCODE"})
    return out.select("unit_indx", "POSTCODE", "property_type", "key", *minus, *prices, "density_count")


@query("comparables_stage", "D20 A12 F1 F2 F3", SQL["comparables_features"])
def comparables_stage(spark, sf_dir):
    """The fitted stage after it was saved and loaded."""
    rows = units(spark, sf_dir)
    path = scratch_path(spark, "comparables")
    C.Comparables(keys=KEYS, features=FEATURES, price="price_p").fit(rows).write().save(path)
    model = C.ComparablesModel.load(path)
    model.table = model.table.select(*KEYS, *[F.round(c, 4).alias(c) for c in model.table.columns if "__" in c], "density_count")
    out = model.transform(rows)
    minus = [F.round(f"{c}_minus_{op}", 4).alias(f"{c}_minus_{op}") for c in FEATURES for op in C.OPS]
    out = R.rename(out, {"postcode": "POSTCODE"})
    return out.select("unit_indx", "POSTCODE", "property_type", "key", *minus, *[f"price_p__{op}" for op in C.OPS], "density_count")


_MERGED = ", ".join(f"round({c} - {c}__{op}, 4) AS {c}_minus_{c}__{op}" for c in FEATURES for op in C.OPS)


@query(
    "train_lookup_merge",
    "E2 F4",
    with_sql(
        f"{UNITS_SQL}, {LOOKUP_SQL}",
        f"""SELECT {_MERGED}, {_PRICES}, unit_indx, u.property_type, u.postcode, postcode_area, density_count, price_p
        FROM units u JOIN lookup l ON u.postcode = l.postcode AND u.property_type = l.property_type""",
    ),
)
def train_lookup_merge(spark, sf_dir):
    rows = units(spark, sf_dir)
    lookup = _lookup(rows).withColumnRenamed("property_type", "property_type__")
    carried = ["unit_indx", "property_type", "postcode", "postcode_area", "density_count", "price_p"]
    columns = ["unit_indx", "property_type", "postcode", "postcode_area", "price_p", *FEATURES]
    merged = C.merge_train_with_lookup(
        rows.select(*columns), lookup, KEYS, FEATURES, "price_p", carried
    )
    return _rounded(merged, 4)


# Suppliers get coordinates from their keys, so that many share a spot.
_SPOTS_SQL = """spots AS (SELECT s_suppkey, CAST(round(s_acctbal * 100) AS BIGINT) AS pence, radians(51.5 + (s_suppkey % 37) * 0.0007) AS lat,
  radians(-0.12 + (s_nationkey % 11) * 0.0009) AS lon FROM supplier)"""
_HALF = D.HALF_SIDE_METRES
_RADIUS = (
    f"sqrt((pow({D.WGS84_A}*{D.WGS84_A}*cos(lat),2)+pow({D.WGS84_B}*{D.WGS84_B}*sin(lat),2))"
    f"/(pow({D.WGS84_A}*cos(lat),2)+pow({D.WGS84_B}*sin(lat),2)))"
)


def _spots(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.round(F.col("s_acctbal") * 100).cast("long").alias("pence"),
        D.deg2rad(51.5 + (F.col("s_suppkey") % 37) * 0.0007).alias("lat"),
        D.deg2rad(-0.12 + (F.col("s_nationkey") % 11) * 0.0009).alias("lon"),
    )


@query(
    "geo_bbox",
    "C9 C10 C11",
    with_sql(
        _SPOTS_SQL,
        f"""SELECT s_suppkey, round(degrees(lat - {_HALF}/{_RADIUS}), 9) AS lat_min,
        round(degrees(lat + {_HALF}/{_RADIUS}), 9) AS lat_max,
        round(degrees(lon - {_HALF}/({_RADIUS}*cos(lat))), 9) AS lon_min,
        round(degrees(lon + {_HALF}/({_RADIUS}*cos(lat))), 9) AS lon_max,
        round({_RADIUS}*cos(lat), 3) AS parallel_radius FROM spots""",
    ),
)
def geo_bbox(spark, sf_dir):
    deg = lambda c: F.round(D.rad2deg(c), 9)
    return _spots(spark, sf_dir).select(
        "s_suppkey",
        deg(D.lat_min("lat")).alias("lat_min"),
        deg(D.lat_max("lat")).alias("lat_max"),
        deg(D.lon_min("lat", "lon")).alias("lon_min"),
        deg(D.lon_max("lat", "lon")).alias("lon_max"),
        F.round(D.parallel_radius("lat"), 3).alias("parallel_radius"),
    )


@query(
    "neighbourhood_prices",
    "E9",
    with_sql(
        _SPOTS_SQL
        + f""", places AS (SELECT lat, lon, count(*) AS n, sum(pence) AS total FROM spots GROUP BY lat, lon),
        box AS (SELECT lat, lon, lat - {_HALF}/{_RADIUS} AS lat0, lat + {_HALF}/{_RADIUS} AS lat1,
          lon - {_HALF}/({_RADIUS}*cos(lat)) AS lon0, lon + {_HALF}/({_RADIUS}*cos(lat)) AS lon1
          FROM places)""",
        """SELECT round(degrees(b.lat), 7) AS lat, round(degrees(b.lon), 7) AS lon,
        CAST(sum(p.n) AS BIGINT) AS n_nearby, CAST(sum(p.total) AS DOUBLE) / CAST(sum(p.n) AS DOUBLE) AS mean_nearby
        FROM box b JOIN places p ON p.lat BETWEEN lat0 AND lat1 AND p.lon BETWEEN lon0 AND lon1
        GROUP BY b.lat, b.lon""",
    ),
)
def neighbourhood_prices(spark, sf_dir):
    near = C.neighbourhood_stats(_spots(spark, sf_dir), "lat", "lon", "pence")
    return near.select(
        F.round(F.degrees("lat"), 7).alias("lat"),
        F.round(F.degrees("lon"), 7).alias("lon"),
        "n_nearby",
        "mean_nearby",
    )


# ---- domain functions ------------------------------------------------------------------------------
@query(
    "postcode_parts",
    "C1 C2 C3 C4 C7",
    with_sql(
        UNITS_SQL,
        """SELECT unit_indx, postcode_outcode, postcode_area,
        CASE WHEN TRY_CAST(right(left(postcode, 2), 1) AS INT) IS NULL THEN left(postcode, 2) ELSE left(postcode, 1) END
          AS area_by_cast,
        postcode AS from_address, coalesce(nullif(property_type, 'BUILDING'), 'No PROPERTY_TYPE_e') AS property_type
        FROM units""",
    ),
)
def postcode_parts(spark, sf_dir):
    address = F.concat(F.lit("1 High Street "), F.col("postcode"))
    return units(spark, sf_dir).select(
        "unit_indx",
        "postcode_outcode",
        "postcode_area",
        D.postcode_area_by_cast("postcode").alias("area_by_cast"),
        D.postcode_from_address(address).alias("from_address"),
        D.property_type(F.nullif(F.col("property_type"), F.lit("BUILDING"))).alias("property_type"),
    )


@query(
    "floor_normalise",
    "C5 C6",
    with_sql(UNITS_SQL, "SELECT unit_indx, floor_label, floor_level, heated_rooms FROM units"),
)
def floor_normalise(spark, sf_dir):
    return units(spark, sf_dir).select("unit_indx", "floor_label", "floor_level", "heated_rooms")


@query(
    "nearest_area_flags",
    "C12",
    with_sql(
        UNITS_SQL
        + """, stats AS (SELECT postcode, property_type, median(area) AS med, min(area) AS lo, max(area) AS hi
          FROM units GROUP BY postcode, property_type),
        d AS (SELECT unit_indx, abs(area - med) AS dmed, abs(area - lo) AS dmin, abs(area - hi) AS dmax
          FROM units u JOIN stats s ON u.postcode = s.postcode AND u.property_type = s.property_type)""",
        """SELECT unit_indx,
        coalesce(dmed <= dmax, false) OR coalesce(dmed <= dmin, false) AS near_median,
        coalesce(dmin <= dmax, false) OR coalesce(dmin <= dmed, false) AS near_min,
        coalesce(dmax <= dmin, false) OR coalesce(dmax <= dmed, false) AS near_max FROM d""",
    ),
)
def nearest_area_flags(spark, sf_dir):
    rows = units(spark, sf_dir).select("unit_indx", "area", *KEYS)
    lookup = C.build_lookup(rows, KEYS, ["area"])
    joined = C.add_lookup(rows, lookup, KEYS)
    flags = D.nearest_area_flags("area", "area__median", "area__min", "area__max")
    return joined.select("unit_indx", *[c.alias(n) for n, c in flags.items()])


@query(
    "half_even_round",
    "C13",
    "SELECT l_orderkey, round_even(l_quantity / 2, 0) AS half_quantity, round_even(l_quantity / 8, 2) AS eighth FROM lineitem",
)
def half_even_round(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        D.round_half_even(F.col("l_quantity") / 2).alias("half_quantity"),
        D.round_half_even(F.col("l_quantity") / 8, 2).alias("eighth"),
    )


@query(
    "text_normalise",
    "C15",
    f"""SELECT doc_id, md5(lower(translate(text, '{D.PUNCTUATION.replace("'", "''")}', ''))) AS clean_md5 FROM documents""",
)
def text_normalise(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(D.clean_text("text")).alias("clean_md5"))


@query(
    "parse_dates",
    "C16",
    "SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS parsed FROM orders",
)
def parse_dates(spark, sf_dir):
    # The sale date is printed in the two text forms of the raw files and parsed back.
    long_form = F.date_format("o_orderdate", "M/d/yy H:mm")
    short_form = F.date_format("o_orderdate", "M/d/yy")
    text = F.when(F.col("o_orderkey") % 2 == 0, long_form).otherwise(short_form)
    return table(spark, sf_dir, "orders").select("o_orderkey", D.parse_timestamp(text).cast("timestamp_ntz").alias("parsed"))


# ---- relational basics -----------------------------------------------------------------------------
@query("select_cols", "B1", with_sql(PROPERTY_SQL, "SELECT unit_indx, price_p, area FROM property"))
def select_cols(spark, sf_dir):
    return R.select_columns(property_rows(spark, sf_dir), ["unit_indx", "price_p", "area"])


@query("drop_cols", "B2", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_cols(spark, sf_dir):
    return R.drop_columns(table(spark, sf_dir, "customer"), ["c_name", "c_acctbal"])


@query("drop_null_cols", "B3", with_sql(PROPERTY_SQL, "SELECT unit_indx, price_p, postcode, property_type FROM property"))
def drop_null_cols(spark, sf_dir):
    rows = property_rows(spark, sf_dir).drop("sold_at").withColumn("never", F.lit(None).cast("double"))
    # An all-null column always goes; threshold 0 then removes every column with any null.
    return R.drop_null_columns(R.drop_null_columns(rows), 0.0)


@query("substring_keep", "B4", with_sql(UNITS_SQL, "SELECT postcode, postcode_outcode, postcode_area, price_p FROM units"))
def substring_keep(spark, sf_dir):
    return R.keep_by_substring(units(spark, sf_dir), "postcode", ["price_p"])


@query(
    "match_type_filter",
    "B5 E8",
    "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view', 'purchase')",
)
def match_type_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return R.filter_match_types(R.filter_match_types(events), "event_type", ["click", "view", "purchase"])


@query(
    "drop_outliers",
    "B6 F10 B16",
    with_sql(
        UNITS_SQL
        + """, one AS (SELECT * FROM units WHERE price_p BETWEEN (SELECT quantile_cont(price_p, 0.01) FROM units)
          AND (SELECT quantile_cont(price_p, 0.99) FROM units)),
        two AS (SELECT * FROM one WHERE price_p BETWEEN 10000 AND (SELECT quantile_cont(price_p, 0.99) FROM one))""",
        """SELECT unit_indx, price_p, area, rooms, floor_level FROM two
        WHERE rooms < 10 AND coalesce(floor_level, 0) < 20 AND area < 800 AND area > 0""",
    ),
)
def drop_outliers(spark, sf_dir):
    rows = units(spark, sf_dir).select("unit_indx", "price_p", "area", "rooms", "floor_level")
    return R.drop_outliers(rows, "price_p", "rooms", "floor_level", "area")


@query("dropna_target", "B7 B10", with_sql(PROPERTY_SQL, "SELECT unit_indx, area FROM property WHERE area IS NOT NULL"))
def dropna_target(spark, sf_dir):
    return R.drop_nan_target_rows(property_rows(spark, sf_dir).select("unit_indx", "area"), "area")


@query(
    "dropna_rows",
    "B8",
    with_sql(UNITS_SQL, "SELECT unit_indx, area, floor_level FROM units WHERE area IS NOT NULL AND floor_level IS NOT NULL"),
)
def dropna_rows(spark, sf_dir):
    return R.drop_rows_with_nulls(units(spark, sf_dir).select("unit_indx", "area", "floor_level"))


@query(
    "pad_results",
    "B9",
    with_sql(UNITS_SQL, "SELECT unit_indx, CASE WHEN floor_level IS NOT NULL THEN area END AS area FROM units"),
)
def pad_results(spark, sf_dir):
    rows = units(spark, sf_dir).select("unit_indx", "area", "floor_level")
    partial = R.drop_rows_with_nulls(rows).select("unit_indx", "area")
    return R.align_to_rows(rows, partial, "unit_indx")


@query(
    "cast_columns",
    "B12",
    "SELECT event_id, TRY_CAST(regexp_extract(props, '\"k\": ([0-9a-z]+)', 1) AS DOUBLE) AS k FROM events",
)
def cast_columns(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select("event_id", F.regexp_extract("props", '"k": ([0-9a-z]+)', 1).alias("k"))
    return R.cast_columns(raw, {"k": "double"})


@query(
    "row_index",
    "B13",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS unit_indx FROM orders",
)
def row_index(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return R.with_row_index(rows, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "unit_indx")


@query(
    "double_types",
    "B14",
    with_sql(UNITS_SQL, "SELECT price_p, area, CAST(rooms AS DOUBLE) AS rooms, floor_level, heated_rooms FROM units"),
)
def double_types(spark, sf_dir):
    return R.ensure_double_types(units(spark, sf_dir))


@query(
    "fill_defaults",
    "B15",
    with_sql(
        PROPERTY_SQL,
        """SELECT unit_indx, coalesce(area, -1.0) AS area, coalesce(rooms, 0) AS rooms,
        coalesce(floor_label, 'None') AS floor_label FROM property""",
    ),
)
def fill_defaults(spark, sf_dir):
    rows = property_rows(spark, sf_dir).select("unit_indx", "area", "rooms", "floor_label")
    return R.fill_nulls(rows, {"area": -1.0, "rooms": 0, "floor_label": "None", "absent": 1})


@query(
    "conditional_column",
    "B16",
    with_sql(
        PROPERTY_SQL,
        """SELECT unit_indx, CASE WHEN price_p < 100000 THEN 'low' WHEN price_p < 300000 THEN 'middle' ELSE 'high' END
        AS price_class FROM property""",
    ),
)
def conditional_column(spark, sf_dir):
    price = F.col("price_p")
    label = R.choose((price < 100000, "low"), (price < 300000, "middle"), otherwise="high")
    return property_rows(spark, sf_dir).select("unit_indx", label.alias("price_class"))


@query(
    "sample_exact",
    "B17",
    "SELECT o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (ORDER BY md5('7|' || CAST(o_orderkey AS VARCHAR)), o_orderkey) <= 500",
)
def sample_exact(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return R.sample_rows(rows, 500, "o_orderkey", seed=7)


def _poisson_sql(u, mean):
    """Number of draws whose cumulated Poisson probability lies below u."""
    return " + ".join(f"CASE WHEN {u} >= {p!r} THEN 1 ELSE 0 END" for p in R.poisson_steps(mean))


_DRAW = "('0x' || substr(md5('7|' || CAST(o_orderkey AS VARCHAR)), 1, 13))::BIGINT / 4503599627370496.0"


@query("sample_share", "B17", f"SELECT o_orderkey FROM orders WHERE {_DRAW} < 0.25")
def sample_share(spark, sf_dir):
    return R.sample_fraction(table(spark, sf_dir, "orders").select("o_orderkey"), 0.25, "o_orderkey", seed=7)


@query("sample_fraction", "B17", f"SELECT o_orderkey FROM (SELECT o_orderkey, unnest(range(0, {_poisson_sql(_DRAW, 0.5)})) FROM orders)")
def sample_fraction(spark, sf_dir):
    return R.sample_fraction(table(spark, sf_dir, "orders").select("o_orderkey"), 0.5, "o_orderkey", replace=True, seed=7)


@query(
    "dedup_units",
    "B18",
    """SELECT l_orderkey, l_extendedprice, l_partkey FROM lineitem QUALIFY row_number() OVER
    (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_partkey) = 1""",
)
def dedup_units(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_partkey")
    return R.drop_duplicates(lines, "l_orderkey", [F.col("l_extendedprice"), F.col("l_partkey")])


@query(
    "semi_ids",
    "B19",
    with_sql(
        VALUED_SQL,
        "SELECT unit_indx, price_p FROM property WHERE unit_indx IN (SELECT unit_indx FROM valued WHERE abs((avm - price_p) / price_p) < 0.2)",
    ),
)
def semi_ids(spark, sf_dir):
    valued = valued_units(spark, sf_dir)
    ids = valued.filter(F.abs((F.col("avm") - F.col("price_p")) / F.col("price_p")) < 0.2).select("unit_indx")
    return R.keep_members(property_rows(spark, sf_dir).select("unit_indx", "price_p"), ids, "unit_indx")


# ---- joins -----------------------------------------------------------------------------------------
_COORDS_SQL = """postcode_coords AS (SELECT DISTINCT postcode, CASE WHEN postcode LIKE '%3AB' THEN NULL ELSE
    51.0 + length(postcode) / 8.0 END AS latitude FROM units WHERE postcode NOT LIKE '%2AB'),
  outcode_coords AS (SELECT postcode_outcode AS postcode, CAST(count(*) AS DOUBLE) AS latitude FROM units
    GROUP BY postcode_outcode)"""


@query(
    "coord_fallback",
    "E4 C14",
    with_sql(
        f"{UNITS_SQL}, {_COORDS_SQL}",
        """SELECT u.unit_indx, u.postcode, coalesce(p.latitude, o.latitude) AS latitude FROM units u
        LEFT JOIN postcode_coords p ON u.postcode = p.postcode
        LEFT JOIN outcode_coords o ON u.postcode_outcode = o.postcode""",
    ),
)
def coord_fallback(spark, sf_dir):
    rows = units(spark, sf_dir).select("unit_indx", "postcode")
    fine = rows.filter(~F.col("postcode").endswith("2AB")).select("postcode").distinct()
    fine = fine.withColumn(
        "latitude", F.when(~F.col("postcode").endswith("3AB"), 51.0 + F.length("postcode") / 8.0)
    )
    coarse = rows.groupBy(D.postcode_outcode("postcode").alias("outcode")).agg(
        F.count(F.lit(1)).cast("double").alias("outcode_latitude")
    )
    return P.add_coordinates(rows, fine, coarse).select("unit_indx", "postcode", "latitude")


@query(
    "row_concat",
    "E7 A4",
    """SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, NULL::VARCHAR AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer""",
)
def row_concat(spark, sf_dir):
    a = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_nationkey AS nation")
    b = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment"
    )
    return a.unionByName(b, allowMissingColumns=True)


@query(
    "index_join",
    "E10",
    """SELECT o_orderkey, o_totalprice, year(o_orderdate)::INTEGER AS sold_year, (month(o_orderdate) - 1)::INTEGER AS sold_month FROM orders""",
)
def index_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    parts = orders.select(
        "o_orderkey", F.year("o_orderdate").alias("sold_year"), (F.month("o_orderdate") - 1).alias("sold_month")
    )
    return orders.select("o_orderkey", "o_totalprice").join(parts, "o_orderkey")


# ---- aggregation ------------------------------------------------------------------------------------
@query("value_counts", "F5", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts(spark, sf_dir):
    return S.value_counts(table(spark, sf_dir, "events"), "event_type")


@query(
    "rare_key_filter",
    "F6 E8",
    with_sql(
        UNITS_SQL,
        """SELECT unit_indx, postcode, heated_rooms FROM units
        QUALIFY count(*) OVER (PARTITION BY postcode, heated_rooms) > 5""",
    ),
)
def rare_key_filter(spark, sf_dir):
    rows = units(spark, sf_dir).select("unit_indx", "postcode", "heated_rooms")
    return R.remove_rare_keys(rows, ["postcode", "heated_rooms"], 5)


@query(
    "target_distribution",
    "F7",
    """SELECT o_orderstatus AS target, printf('%.2f%%', count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders)) AS share
    FROM orders GROUP BY o_orderstatus""",
)
def target_distribution(spark, sf_dir):
    return S.target_distribution(table(spark, sf_dir, "orders"), "o_orderstatus")


@query(
    "dtype_counts",
    "F8",
    """SELECT CASE WHEN data_type IN ('BIGINT','INTEGER','DOUBLE') THEN 'Numeric' WHEN data_type = 'VARCHAR' THEN 'Categorical'
      ELSE 'Datetime' END AS type_class, count(*) AS n_features, (SELECT count(*) FROM orders) AS n_rows
    FROM (SELECT unnest([typeof(o_orderkey), typeof(o_custkey), typeof(o_orderstatus), typeof(o_totalprice),
      typeof(o_orderdate), typeof(o_orderpriority)]) AS data_type FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1))
    GROUP BY 1""",
)
def dtype_counts(spark, sf_dir):
    return S.number_of_features(table(spark, sf_dir, "orders"))


@query(
    "null_share",
    "F9",
    with_sql(
        UNITS_SQL,
        """SELECT 'area' AS "column", round(avg(CASE WHEN area IS NULL THEN 1.0 ELSE 0 END), 6) AS null_share FROM units
        UNION ALL SELECT 'floor_level', round(avg(CASE WHEN floor_level IS NULL THEN 1.0 ELSE 0 END), 6) FROM units
        UNION ALL SELECT 'price_p', round(avg(CASE WHEN price_p IS NULL THEN 1.0 ELSE 0 END), 6) FROM units""",
    ),
)
def null_share(spark, sf_dir):
    return _rounded(S.null_share(units(spark, sf_dir), ["area", "floor_level", "price_p"]))


@query(
    "exact_quantiles",
    "F10",
    """SELECT q, round(quantile_cont(o_totalprice, q), 6) AS value FROM orders, (SELECT unnest([0.01, 0.16, 0.5, 0.84, 0.99]) AS q)
    GROUP BY q""".replace("quantile_cont(o_totalprice, q)", "CASE q WHEN 0.01 THEN quantile_cont(o_totalprice, 0.01) "
    "WHEN 0.16 THEN quantile_cont(o_totalprice, 0.16) WHEN 0.5 THEN quantile_cont(o_totalprice, 0.5) "
    "WHEN 0.84 THEN quantile_cont(o_totalprice, 0.84) ELSE quantile_cont(o_totalprice, 0.99) END")
    .replace("SELECT q,", "SELECT CAST(q AS DOUBLE) AS q,"),
)
def exact_quantiles(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_totalprice")
    return _rounded(S.quantiles(orders, "o_totalprice", [0.01, 0.16, 0.5, 0.84, 0.99]))


@query(
    "representatives",
    "F11",
    with_sql(
        UNITS_SQL,
        """SELECT key, unit_indx FROM units QUALIFY row_number() OVER (PARTITION BY key ORDER BY
        md5('11|' || CAST(unit_indx AS VARCHAR)), unit_indx) = 1""",
    ),
)
def representatives(spark, sf_dir):
    return R.representatives(units(spark, sf_dir).select("key", "unit_indx"), ["key"], "unit_indx", seed=11)


@query(
    "distinct_counts",
    "F12",
    with_sql(
        UNITS_SQL,
        """SELECT 'postcode' AS "column", count(DISTINCT postcode) AS n_distinct FROM units
        UNION ALL SELECT 'area', count(DISTINCT area) FROM units
        UNION ALL SELECT 'floor_label', count(DISTINCT floor_label) FROM units""",
    ),
)
def distinct_counts(spark, sf_dir):
    return S.distinct_count(units(spark, sf_dir), "postcode", "area", "floor_label")


def _profile_sql(c):
    return f"""SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS n_null, round(avg({c}), 4) AS mean,
    round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS smallest, CAST(max({c}) AS DOUBLE) AS largest,
    round(quantile_cont({c}, 0.25), 4) AS q25, round(median({c}), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q75,
    count(DISTINCT {c}) AS n_distinct FROM units"""


@query("profile", "F13", with_sql(UNITS_SQL, " UNION ALL ".join(_profile_sql(c) for c in ("price_p", "area", "floor_level"))))
def profile(spark, sf_dir):
    return _rounded(S.profile(units(spark, sf_dir), ["price_p", "area", "floor_level"]), 4)


@query(
    "problem_type",
    "F14",
    """SELECT * FROM (SELECT 'price' AS target, CASE WHEN count(DISTINCT o_totalprice) = 2 THEN 'binary'
      WHEN count(DISTINCT o_totalprice) > 10 THEN 'regression' ELSE 'multiclass' END AS problem_type FROM orders
    UNION ALL SELECT 'quality', CASE WHEN count(DISTINCT quality) = 2 THEN 'binary'
      WHEN count(DISTINCT quality) > 10 THEN 'regression' ELSE 'multiclass' END FROM labels
    UNION ALL SELECT 'event_type', CASE WHEN count(DISTINCT event_type) = 2 THEN 'binary' ELSE 'multiclass' END FROM events)""",
)
def problem_type(spark, sf_dir):
    found = [
        ("price", S.detect_problem_type(table(spark, sf_dir, "orders"), "o_totalprice")),
        ("quality", S.detect_problem_type(table(spark, sf_dir, "labels"), "quality")),
        ("event_type", S.detect_problem_type(table(spark, sf_dir, "events"), "event_type")),
    ]
    return S.literal_rows(spark, found, ["target", "problem_type"])


@query("extremes", "F15", "SELECT max(o_totalprice) AS largest, min(o_totalprice) AS smallest FROM orders")
def extremes(spark, sf_dir):
    return S.extremes(table(spark, sf_dir, "orders"), "o_totalprice")


# ---- ordering -----------------------------------------------------------------------------------------
@query(
    "latest_per_key",
    "G1",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders QUALIFY row_number() OVER
    (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
)
def latest_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return R.latest_per_key(orders, ["o_custkey"], "o_orderdate", "o_orderkey")


@query(
    "top_categories",
    "G4 G7",
    "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10",
)
def top_categories(spark, sf_dir):
    return S.value_counts(table(spark, sf_dir, "part"), "p_brand").orderBy(F.desc("n"), "p_brand").limit(10)


# ---- preparation and sources ------------------------------------------------------------------------------
@query(
    "prepare_units",
    "B5 B6 C1 C2 C4 C5 C6 C7",
    with_sql(
        UNITS_SQL
        + """, one AS (SELECT * FROM units WHERE price_p BETWEEN (SELECT quantile_cont(price_p, 0.01) FROM units)
          AND (SELECT quantile_cont(price_p, 0.99) FROM units)),
        two AS (SELECT * FROM one WHERE price_p BETWEEN 10000 AND (SELECT quantile_cont(price_p, 0.99) FROM one))""",
        """SELECT unit_indx, postcode AS "POSTCODE", postcode_outcode AS "POSTCODE_OUTCODE", postcode_area AS "POSTCODE_AREA",
        'TOWN ' || postcode_outcode AS "POSTTOWN_e", property_type AS "PROPERTY_TYPE_e", area AS "TOTAL_FLOOR_AREA_e",
        heated_rooms AS "NUMBER_HEATED_ROOMS_e", floor_level AS "FLOOR_LEVEL_e", CAST(51.5 AS DOUBLE) AS "Latitude_m",
        CAST(-0.1 AS DOUBLE) AS "Longitude_m", price_p AS "Price_p" FROM two
        WHERE rooms < 10 AND area < 800 AND area > 0""",
    ),
)
def prepare_units(spark, sf_dir):
    return P.prepare(P.raw_rows(property_rows(spark, sf_dir)))


@query(
    "source_round_trip",
    "A1 A2 A3 A5 A6 A7 A8 A9 A10",
    """SELECT 'parquet_prefix' AS source, count(*) AS n, round(sum(s_acctbal), 2) AS total FROM supplier
    UNION ALL SELECT 'parquet_parts', 2 * count(*), round(2 * sum(s_acctbal), 2) FROM supplier
    UNION ALL SELECT 'csv', count(*), round(sum(s_acctbal), 2) FROM supplier
    UNION ALL SELECT 'csv_view', count(*), round(sum(s_acctbal), 2) FROM supplier
    UNION ALL SELECT 'parquet_view', count(*), round(sum(s_acctbal), 2) FROM supplier
    UNION ALL SELECT 'table', count(*), round(sum(s_acctbal), 2) FROM supplier
    UNION ALL SELECT 'dated', count(*), round(sum(s_acctbal), 2) FROM supplier""",
)
def source_round_trip(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier")
    root = scratch_path(spark, "sources")
    gz = writers.write_gzip_parquet(rows, f"{root}/gz")
    text = writers.write_csv(rows, f"{root}/csv")
    features, labels = readers.load_data(spark, text, "s_suppkey", "s_acctbal", schema=rows.schema)
    frames = {
        "parquet_prefix": readers.read_parquet_prefix(spark, gz),
        "parquet_parts": readers.read_parquet_parts(spark, [gz, gz]),
        "csv": features.join(labels, "s_suppkey"),
        "csv_view": readers.register_csv_view(spark, text, "supplier_csv", rows.schema),
        "parquet_view": readers.register_parquet_view(spark, f"{root}/{{gz}}", "supplier_parquet"),
        "table": writers.replace_table(rows, "gable_supplier", f"{root}/table"),
        "dated": writers.save_dated_output(rows, f"{root}/dated", "2021-02-07"),
    }
    out = None
    for name, frame in frames.items():
        one = frame.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("s_acctbal"), 2).alias("total"))
        one = one.select(F.lit(name).alias("source"), "n", "total")
        out = one if out is None else out.unionByName(one)
    return out
