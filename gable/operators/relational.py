"""Column choice, row filters, casts, dedup and sampling."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gable.functions.domain import MATCH_TYPES
from gable.operators.profile import null_shares
from gable.operators.spread import (
    exact_quantiles,
    hash_order,
    lookup_join,
    rank_by_hash,
    rank_by_order,
)
from gable.runtime import written


def _require(df: DataFrame, cols: Sequence[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found in input data: {missing}")


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    _require(df, cols)
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    _require(df, cols)
    return df.drop(*cols)


def drop_null_columns(df: DataFrame, pct_null_threshold: float = 1.0) -> DataFrame:
    """Drop columns whose null share reaches the threshold (any null at all for threshold 0)."""
    if not 0 <= pct_null_threshold <= 1:
        raise ValueError("the share of nulls is a number from 0 to 1")
    shares = null_shares(df)
    if pct_null_threshold == 0:
        return df.drop(*[c for c, s in shares.items() if s > 0])
    return df.drop(*[c for c, s in shares.items() if s >= pct_null_threshold])


def keep_by_substring(df: DataFrame, part: str, also: Sequence[str] = ()) -> DataFrame:
    return df.select(*[c for c in df.columns if part in c or c in also])


def filter_match_types(df: DataFrame, col: str = "TypeOfMatching_m", kept: Sequence[str] = MATCH_TYPES) -> DataFrame:
    return df.filter(F.col(col).isin(list(kept))) if col in df.columns else df


def drop_outliers(
    df: DataFrame,
    price: str = "Price_p",
    rooms: str = "NUMBER_HABITABLE_ROOMS_e",
    storeys: str = "FLAT_STOREY_COUNT_e",
    area: str = "TOTAL_FLOOR_AREA_e",
) -> DataFrame:
    """Trim the price tails twice, then bound rooms, storeys and area; nulls in rooms or area drop the row.

    The cut-offs come from one pass, which counts equal prices; only these three scalars reach the driver, so both price
    filters can be pushed to the scan.
    """
    prices = df.groupBy(F.col(price).cast("double").alias("_price")).agg(F.count(F.lit(1)).alias("_n")).transform(written)
    cut = exact_quantiles(prices, {"lo": ("_price", 0.01), "hi": ("_price", 0.99)}, weight="_n").first()
    if cut is None or cut["lo"] is None:
        return df.limit(0)
    inside = prices.filter(F.col("_price").between(cut["lo"], cut["hi"]))
    again = exact_quantiles(inside, {"hi": ("_price", 0.99)}, weight="_n").first()["hi"]
    kept = df.filter(F.col(price).between(cut["lo"], cut["hi"]))
    return kept.filter(
        F.col(price).between(10000, again)
        & (F.col(rooms).try_cast("double") < 10)
        & (F.coalesce(F.col(storeys).try_cast("double"), F.lit(0.0)) < 20)
        & (F.col(area).try_cast("double") < 800)
        & (F.col(area).try_cast("double") > 0)
    )


def drop_nan_target_rows(df: DataFrame, target: str) -> DataFrame:
    return df.na.drop(subset=[target])


def drop_rows_with_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(subset) if subset else None)


def align_to_rows(rows: DataFrame, partial: DataFrame, key: str) -> DataFrame:
    """Bring a result that lost rows back to every row, null where it has none."""
    return rows.select(key).join(partial, key, "left")


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast with null for text that does not parse (an ANSI cast would raise)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "unit_indx") -> DataFrame:
    """0-based position in a total order; kept as it is when the column exists."""
    if name in df.columns:
        return df
    return rank_by_order(df, order, rank_col=name).withColumn(name, F.col(name) - 1)


def ensure_double_types(df: DataFrame, ignore: Sequence[str] = ("unit_indx", "_c0")) -> DataFrame:
    """Cast every column to double; drop those that hold a value which does not cast."""
    cols = [c for c in df.columns if c not in ignore]
    known = [c for c in cols if isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))]
    other = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    good = set(known)
    if other:
        lost = df.agg(
            *[F.sum((F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).cast("int")).alias(c) for c in other]
        ).first()
        good |= {c for c in other if not lost[c]}
    return df.select(*[F.col(c).try_cast("double").alias(c) for c in cols if c in good])


def fill_nulls(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.na.fill({c: v for c, v in defaults.items() if c in df.columns and v is not None})


def choose(*cases: tuple[Column, object], otherwise: object = None) -> Column:
    """First matching case, as a column."""
    out = None
    for test, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def poisson_steps(mean: float) -> list[float]:
    """Cumulated Poisson probabilities, as far as a double tells them from 1."""
    steps, term, total = [], math.exp(-mean), 0.0
    while total + term > total and total < 1 - 1e-15:
        total += term
        steps.append(total)
        term *= mean / len(steps)
    return steps


def sample_fraction(df: DataFrame, fraction: float, key: str, replace: bool = False, seed: int = 0) -> DataFrame:
    """About a share of the rows, chosen by the md5 of the key, so that it is the same on any cluster.

    With replacement each row is repeated a Poisson number of times, read off the same hash.
    """
    # 52 bits of the hash are a number from 0 to 1 that a double holds exactly.
    draw = F.conv(F.substring(hash_order(key, seed), 1, 13), 16, 10).cast("long") / F.lit(2.0**52)
    if not replace:
        return df.filter(draw < fraction)
    times = sum(((draw >= p).cast("int") for p in poisson_steps(fraction)), F.lit(0))
    return df.withColumn("_times", F.array_repeat(F.lit(0), times)).withColumn("_times", F.explode("_times")).drop("_times")


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (or all), the first in md5 order of the key."""
    return df.orderBy(hash_order(key, seed), key).limit(n)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order``, chosen by an aggregate with a map-side combine.

    Unlike a row number, no task sorts a whole group. Order columns must be ascending expressions.
    """
    kept = list(cols or [c for c in df.columns if c not in keys])
    ordering = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    smallest = F.min(F.struct(*ordering, F.struct(*kept).alias("_row"))).alias("_best")
    return df.groupBy(*keys).agg(smallest).select(*keys, "_best._row.*")


def latest_per_key(df: DataFrame, keys: Sequence[str], time: str, tie: str, cols: Sequence[str] | None = None) -> DataFrame:
    """The latest row per key, the smallest ``tie`` value winning among equal times (null last)."""
    kept = F.struct(*(cols or [c for c in df.columns if c not in keys])).alias("_row")
    if isinstance(df.schema[tie].dataType, T.NumericType):
        newest = F.max(F.struct(F.col(time).alias("_t"), (-F.col(tie)).alias("_i"), kept)).alias("_best")
        return df.groupBy(*keys).agg(newest).select(*keys, "_best._row.*")
    # Other kinds have no opposite to take the largest of: first the smallest of each time, then the latest time.
    at = df.groupBy(*keys, F.col(time).alias("_t")).agg(F.min(F.struct(F.col(tie).isNull().alias("_none"), F.col(tie).alias("_i"), kept)).alias("_first"))
    return at.groupBy(*keys).agg(F.max(F.struct("_t", "_first._row")).alias("_best")).select(*keys, "_best._row.*")


def drop_duplicates(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    return first_per_key(df, [key], order)


def representatives(df: DataFrame, keys: Sequence[str], unit: str, seed: int = 0) -> DataFrame:
    """One reproducibly random row per key."""
    return first_per_key(df, keys, [hash_order(unit, seed), F.col(unit)])


def keep_members(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def remove_rare_keys(
    df: DataFrame, keys: Sequence[str], more_than: int = 5
) -> DataFrame:
    """Rows whose key occurs more than the given number of times."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > more_than)
    joined = lookup_join(df, counts, keys, "inner", weight="_n")
    return joined.drop("_n")
