"""Skew-safe building blocks: ranks, running totals, quantiles and lookup joins.

A plain ``row_number().over(partitionBy(k))`` or ``percentile`` moves a whole group into one task. The
functions here give the same answers while a group may hold any share of the rows: rows are ordered in
ranges (or hash buckets), every range is counted with a map-side combine, and only the small table of
per-range counts is accumulated per group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gable.runtime import written

# Salts given to a heavy join key.
SALTS = 64

_STRATUM, _BUCKET, _ORDER, _ROW = "_stratum", "_bucket", "_order", "_row"


def stratum_label(cols: Sequence[str]) -> Column:
    """One non-null string per combination of values, so that null groups join to themselves."""
    if not cols:
        return F.lit("")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols]
    return F.concat_ws("\x1f", *parts)


def hash_order(key: str, seed: int = 0) -> Column:
    """Reproducible pseudo-random order: md5 of ``seed|key`` as hex text."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def hash_number(*parts: Column) -> Column:
    """A reproducible whole number from 0 to 2**52 - 1: the first digits of the md5 of the parts, joined by ``|``."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def rank_by_hash(
    df: DataFrame,
    key: str,
    seed: int = 0,
    strata: Sequence[str] = (),
    rank_col: str = "rank",
    size_col: str | None = None,
    digits: int = 4,
) -> DataFrame:
    """1-based rank of each row in md5 order within its stratum; ``key`` must be unique.

    Buckets are the first hex digits of the hash, so they are equally filled whatever the stratum sizes;
    a stratum is spread over 16**digits of them.
    """
    marked = df.withColumns({_STRATUM: stratum_label(strata), _ORDER: hash_order(key, seed)})
    marked = marked.withColumn(_BUCKET, F.substring(_ORDER, 1, digits))
    counts = marked.groupBy(_STRATUM, _BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(_STRATUM)
    earlier = whole.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        _STRATUM,
        _BUCKET,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_stratum_size"),
    )
    within = F.row_number().over(Window.partitionBy(_STRATUM, _BUCKET).orderBy(_ORDER, key))
    ranked = marked.join(offsets, [_STRATUM, _BUCKET]).withColumn(rank_col, F.col("_before") + within)
    if size_col:
        ranked = ranked.withColumn(size_col, F.col("_stratum_size"))
    return ranked.drop(_STRATUM, _BUCKET, _ORDER, "_before", "_stratum_size")


def _fixed_order(df: DataFrame, order: Sequence[str | Column], strata: Sequence[str]) -> DataFrame:
    """Range-partition and sort by (stratum, order) and fix the row positions with a checkpoint.

    Range bounds come from sampling, so positions are only stable once they are materialised.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = (
        df.withColumn(_STRATUM, stratum_label(strata))
        .repartitionByRange(F.col(_STRATUM), *cols)
        .sortWithinPartitions(F.col(_STRATUM), *cols)
        .withColumn(_ROW, F.monotonically_increasing_id())
    )
    # The partition number sits above bit 33 of the generated id.
    return ranged.withColumn(_BUCKET, F.shiftright(_ROW, 33)).transform(written)


def _with_offsets(fixed: DataFrame, aggs: dict[str, Column], strata: Sequence[str]) -> DataFrame:
    """Join per-range aggregates, their total before the range and over the stratum, to the rows."""
    blocks = fixed.groupBy(_STRATUM, _BUCKET).agg(
        F.min(_ROW).alias("_first"), *[c.alias(f"_{n}_block") for n, c in aggs.items()]
    )
    whole = Window.partitionBy(_STRATUM)
    earlier = whole.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        _STRATUM,
        _BUCKET,
        "_first",
        *[F.coalesce(F.sum(f"_{n}_block").over(earlier), F.lit(0)).alias(f"_{n}_before") for n in aggs],
        *[F.sum(f"_{n}_block").over(whole).alias(f"_{n}_total") for n in aggs],
    )
    if not strata:
        # One row per partition of `fixed`: bounded by the partition count.
        offsets = F.broadcast(offsets)
    return fixed.join(offsets, [_STRATUM, _BUCKET])


def rank_by_order(
    df: DataFrame,
    order: Sequence[str | Column],
    strata: Sequence[str] = (),
    rank_col: str = "rank",
    size_col: str | None = None,
) -> DataFrame:
    """1-based position of each row in the given total order within its stratum."""
    placed = _with_offsets(_fixed_order(df, order, strata), {"n": F.count(F.lit(1))}, strata)
    placed = placed.withColumn(rank_col, F.col(_ROW) - F.col("_first") + F.col("_n_before") + 1)
    if size_col:
        placed = placed.withColumn(size_col, F.col("_n_total"))
    return placed.drop(_STRATUM, _BUCKET, _ROW, "_first", "_n_before", "_n_total")


def running_totals(
    df: DataFrame, order: Sequence[str | Column], sums: Sequence[str], strata: Sequence[str] = ()
) -> DataFrame:
    """Add ``<c>_before`` (sum over earlier rows of the stratum) and ``<c>_total`` for each column."""
    placed = _with_offsets(_fixed_order(df, order, strata), {c: F.sum(c) for c in sums}, strata)
    earlier = Window.partitionBy(_STRATUM, _BUCKET).orderBy(_ROW).rowsBetween(Window.unboundedPreceding, -1)
    added: dict[str, Column] = {}
    for c in sums:
        added[f"{c}_before"] = F.col(f"_{c}_before") + F.coalesce(F.sum(c).over(earlier), F.lit(0))
        added[f"{c}_total"] = F.col(f"_{c}_total")
    names = [c for c in df.columns]
    return placed.withColumns(added).select(*names, *added)


def value_bucket(value: Column) -> Column:
    """A coarse bucket that never falls as the value rises: 370 buckets per factor of e, so at most a few hundred thousand."""
    size = F.when(value == 0, 0.0).otherwise(F.floor(F.ln(F.least(F.abs(value), F.lit(1.7e308))) * 370) + 400_000)
    return F.when(F.isnan(value), 1_000_000.0).otherwise(F.signum(value) * size).cast("int")


def exact_quantiles(
    df: DataFrame,
    wanted: dict[str, tuple[str, float]],
    keys: Sequence[str] = (),
    extra: Sequence[Column] = (),
    size_col: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles ``{name: (column, q)}`` per group, next to ``extra`` aggregates.

    ``size_col`` adds the number of rows of the group; ``weight`` names a column of whole numbers that say how often a row
    counts (rows of weight 0 or null do not). The input is evaluated once, and once more if there are ``extra`` aggregates.

    One plan for all sizes and all columns. Equal values of a group are one row with their number (map-side combine).
    These rows fall into value buckets whose number is bounded. Running totals over the buckets of a group tell which
    buckets hold a wanted position; only those are ordered value by value. So neither a large group nor a frequent
    value gathers rows in one task, and no step needs to know how large groups are.
    """
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    marked = df.withColumn(_STRATUM, stratum_label(keys))
    times = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    pairs = F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(columns)])
    named = [F.first(k).alias(k) for k in keys]
    rows = marked.select(_STRATUM, *keys, times.alias("_times"), F.inline(pairs)).filter("_times > 0")
    # Nulls are kept: a group without any value is still a group.
    counted = written(rows.groupBy(_STRATUM, "_c", "_v").agg(*named, F.sum("_times").alias("_k")).withColumn("_b", value_bucket(F.col("_v"))))
    size = [F.sum(F.when(F.col("_c") == 0, F.col("_k"))).alias(size_col)] if size_col else []
    if not keys and not extra:
        result = counted.agg(F.count(F.lit(1)).alias("_rows"), *size).withColumn(_STRATUM, F.lit(""))
    elif not extra:
        result = counted.groupBy(_STRATUM).agg(*named, *size)
    else:
        all_rows = [F.sum(times).alias(size_col)] if size_col else []
        group = [*named, F.count(F.lit(1)).alias("_rows"), *all_rows, *extra]
        result = marked.groupBy(_STRATUM).agg(*group) if keys else df.agg(*group).withColumn(_STRATUM, F.lit(""))
    ties = counted.filter("_v IS NOT NULL").drop(*keys)
    of = Window.partitionBy(_STRATUM, "_c")
    earlier = of.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = ties.groupBy(_STRATUM, "_c", "_b").agg(F.sum("_k").alias("_n"))
    buckets = buckets.withColumns({"_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "_size": F.sum("_n").over(of)})
    # Positions from 0, of the values below and above each quantile.
    at = {n: F.lit(float(q)) * (F.col("_size") - 1) for n, (_, q) in wanted.items()}
    mine = {n: F.col("_c") == columns.index(c) for n, (c, _) in wanted.items()}
    inside = lambda position, start, number: (position >= start) & (position < start + number)
    holds = [mine[n] & (inside(F.floor(p), F.col("_before"), F.col("_n")) | inside(F.ceil(p), F.col("_before"), F.col("_n"))) for n, p in at.items()]
    near = ties.join(buckets.filter(reduce(Column.__or__, holds)), [_STRATUM, "_c", "_b"])
    below = Window.partitionBy(_STRATUM, "_c", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_k").over(below), F.lit(0)))
    value = lambda n, position: F.max(F.when(mine[n] & inside(position, F.col("_start"), F.col("_k")), F.col("_v")))
    picked = near.groupBy(_STRATUM).agg(
        *[value(n, F.floor(p)).alias(f"_lo_{n}") for n, p in at.items()],
        *[value(n, F.ceil(p)).alias(f"_hi_{n}") for n, p in at.items()],
        *[F.max(F.when(mine[n], p - F.floor(p))).alias(f"_part_{n}") for n, p in at.items()],
    )
    between = [(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_part_{n}")).alias(n) for n in wanted]
    return result.join(picked.select(_STRATUM, *between), _STRATUM, "left").drop(_STRATUM, "_rows")


def heavy_keys(counted: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Keys with more than a partition's fair share of all rows. There are fewer of them than shuffle partitions."""
    partitions = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counted.agg(F.sum(weight)).scalar()
    return counted.filter(F.col(weight) * partitions > total).select(*keys)


def lookup_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", weight: str | None = None, salts: int = SALTS
) -> DataFrame:
    """Join rows to a lookup that is unique on ``keys``, spreading heavy keys over ``salts`` tasks.

    A key is heavy if it has more rows than a shuffle partition should get, so the broadcast list of heavy keys has
    fewer rows than there are partitions. ``weight`` names a row-count column of the lookup; without it the keys are
    counted on the row side. The lookup and the counts are written, since each is read several times. The form is the same
    at every size; AQE turns it into a broadcast join when the lookup proves small.
    """
    lookup = written(lookup)
    if weight:
        counted = lookup.select(*keys, F.col(weight).alias("_n"))
    else:
        counted = written(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    heavy = F.broadcast(heavy_keys(counted, keys, "_n").withColumn("_heavy", F.lit(True)))
    plain = [f.name for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    spread = F.pmod(F.xxhash64(*plain), F.lit(salts))
    no_match = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    left = rows.join(heavy, list(keys), "left").withColumn(
        "_salt", F.when(F.col("_heavy") | no_match, spread).otherwise(F.lit(0).cast("bigint"))
    )
    right = lookup.join(heavy, list(keys), "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_heavy"), F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).otherwise(
                F.array(F.lit(0).cast("bigint"))
            )
        ),
    )
    joined = left.drop("_heavy").join(right.drop("_heavy"), [*keys, "_salt"], how)
    return joined.drop("_salt")
