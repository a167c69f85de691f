"""Property-domain scalar functions (postcodes, floors, geography, dates, rounding)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------------------
# Floor label -> number text. Labels that are absent (7th, 8th, 10th) have no number.
FLOOR_LABELS = {
    "NO DATA!": "0", "NODATA!": "0", "Basement": "-1", "Ground": "0",
    "1st": "1", "2nd": "2", "3rd": "3", "4th": "4", "5th": "5", "6th": "6", "9th": "9",
    "11th": "11", "12th": "12", "13th": "13", "14th": "14", "15th": "15", "16th": "16",
    "17th": "17", "18th": "18", "19th": "19", "20th": "20",
    "21st or above": "21", "top floor": "22", "mid floor": "3",
}
FLOOR_NUMBERS = [str(n) for n in range(-1, 23)]
MATCH_TYPES = ["1. Address Matched", "2. Address Matched No Spec", "3. No in Address Matched"]
NO_PROPERTY_TYPE = "No PROPERTY_TYPE_e"
# WGS84 semi-axes in metres, and half the side of the search box (0.1 mile).
WGS84_A = 6378137.0
WGS84_B = 6356752.3
HALF_SIDE_METRES = 1000 * 0.1 * 1.60934
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# -------------------------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def postcode_outcode(postcode: Column | str) -> Column:
    """First whitespace-separated token."""
    return F.split(F.trim(_col(postcode)), r"\s+")[0]


def postcode_area(outcode: Column | str) -> Column:
    """First letter when a digit follows it, else the first two characters."""
    o = _col(outcode)
    return F.when(F.substring(o, 2, 1).rlike("^[0-9]$"), F.substring(o, 1, 1)).otherwise(F.substring(o, 1, 2))


def postcode_area_by_cast(postcode: Column | str) -> Column:
    """The area rule as the batch SQL states it: the second character fails to cast to a number."""
    p = _col(postcode)
    second = F.right(F.left(p, F.lit(2)), F.lit(1)).try_cast("int")
    return F.when(second.isNull(), F.left(p, F.lit(2))).otherwise(F.left(p, F.lit(1)))


def postcode_from_address(address: Column | str) -> Column:
    """Last two space-separated tokens of a full address; the whole text when it has fewer."""
    tokens = F.split(_col(address), " ")
    last_two = F.when(F.size(tokens) >= 2, F.slice(tokens, -2, 2)).otherwise(tokens)
    return F.concat_ws(" ", last_two)


def floor_level(label: Column | str) -> Column:
    """Floor label or number text as a double; unknown labels give null."""
    c = _col(label)
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(FLOOR_LABELS.items())])
    text = F.coalesce(F.try_element_at(table, c), c)
    return F.when(text.isin(FLOOR_NUMBERS), text.try_cast("double"))


def heated_rooms(rooms: Column | str) -> Column:
    return F.coalesce(_col(rooms).try_cast("double"), F.lit(0.0))


def property_type(value: Column | str) -> Column:
    return F.coalesce(_col(value).cast("string"), F.lit(NO_PROPERTY_TYPE))


def composite_key(*cols: Column | str, sep: str = "_") -> Column:
    """Key text of several values; a missing value prints as ``nan``."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("nan")) for c in cols])


def deg2rad(c: Column | str) -> Column:
    return F.radians(_col(c))


def rad2deg(c: Column | str) -> Column:
    return F.degrees(_col(c))


def earth_radius(lat: Column | str) -> Column:
    """Ellipsoid radius in metres at a latitude in radians."""
    phi = _col(lat)
    cos, sin = F.cos(phi), F.sin(phi)
    top = F.pow(WGS84_A**2 * cos, F.lit(2.0)) + F.pow(WGS84_B**2 * sin, F.lit(2.0))
    bottom = F.pow(WGS84_A * cos, F.lit(2.0)) + F.pow(WGS84_B * sin, F.lit(2.0))
    return F.sqrt(top / bottom)


def lat_min(lat: Column | str, half_side: float = HALF_SIDE_METRES) -> Column:
    return _col(lat) - F.lit(half_side) / earth_radius(lat)


def lat_max(lat: Column | str, half_side: float = HALF_SIDE_METRES) -> Column:
    return _col(lat) + F.lit(half_side) / earth_radius(lat)


def parallel_radius(lat: Column | str) -> Column:
    """Radius of the circle of latitude."""
    return earth_radius(lat) * F.cos(_col(lat))


def lon_min(lat: Column | str, lon: Column | str, half_side: float = HALF_SIDE_METRES) -> Column:
    return _col(lon) - F.lit(half_side) / parallel_radius(lat)


def lon_max(lat: Column | str, lon: Column | str, half_side: float = HALF_SIDE_METRES) -> Column:
    return _col(lon) + F.lit(half_side) / parallel_radius(lat)


def nearest_area_flags(
    area: Column | str, median: Column | str, smallest: Column | str, largest: Column | str
) -> dict[str, Column]:
    """Which group aggregate the area is close to; the two tests of a flag are joined with OR."""
    to = {n: F.abs(_col(area) - _col(c)) for n, c in (("median", median), ("min", smallest), ("max", largest))}

    def near(this: str, *others: str) -> Column:
        tests = [F.coalesce(to[this] <= to[o], F.lit(False)) for o in others]
        return tests[0] | tests[1]

    return {
        "near_median": near("median", "max", "min"),
        "near_min": near("min", "max", "median"),
        "near_max": near("max", "min", "median"),
    }


def round_half_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(_col(c), digits)


def coordinate_fallback(precise: Column | str, coarse: Column | str) -> Column:
    return F.coalesce(_col(precise), _col(coarse))


def clean_text(c: Column | str) -> Column:
    """Lower-case text without ASCII punctuation."""
    return F.lower(F.translate(_col(c), PUNCTUATION, ""))


def parse_timestamp(c: Column | str, formats: Sequence[str] = ("M/d/yy H:mm", "M/d/yy")) -> Column:
    """First format that parses; null when none does. Two-digit years 69 to 99 are 1969 to 1999, others 2000 to 2068."""
    parsed = []
    for f in formats:
        found = F.try_to_timestamp(_col(c), F.lit(f))
        if re.search(r"(?<!y)yy(?!y)", f):
            found = F.when(F.year(found) >= 2069, found - F.expr("INTERVAL 100 YEARS")).otherwise(found)
        parsed.append(found)
    return F.coalesce(*parsed)


def try_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def nan_to_null(c: Column | str) -> Column:
    return F.when(~F.isnan(_col(c)), _col(c))
