"""Counts, shares and per-column summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gable.operators.spread import exact_quantiles

# ---- fixed values: type class of each Spark type -------------------------------------------------
TYPE_CLASSES = {
    T.BooleanType: "Boolean",
    T.IntegerType: "Numeric",
    T.LongType: "Numeric",
    T.DoubleType: "Numeric",
    T.StringType: "Categorical",
    T.TimestampType: "Datetime",
    T.TimestampNTZType: "Datetime",
}
# -------------------------------------------------------------------------------------------------


def value_counts(df: DataFrame, *cols: str, name: str = "n") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Share of each non-null value as text such as ``12.34%`` (of all rows, null rows included)."""
    total = df.count()
    counts = df.groupBy(F.col(target).alias("target")).agg(F.count(F.lit(1)).alias("n")).filter("target IS NOT NULL")
    return counts.select("target", F.format_string("%.2f%%", F.col("n") / F.lit(total) * 100).alias("share"))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A few known rows as a DataFrame, built from literals on the JVM side."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def number_of_features(df: DataFrame) -> DataFrame:
    """Number of columns per type class, next to the row count."""
    found: dict[str, int] = {}
    for field in df.schema.fields:
        kind = TYPE_CLASSES.get(type(field.dataType))
        if kind:
            found[kind] = found.get(kind, 0) + 1
    pairs = [F.struct(F.lit(k).alias("type_class"), F.lit(n).cast("long").alias("n_features")) for k, n in sorted(found.items())]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.inline(F.array(*pairs)), "n_rows")


def null_share(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column with its share of nulls, from a single aggregate."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return one.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_share")) for c in cols]))
    )


def null_shares(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    """The same as a dictionary (one row reaches the driver)."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols if row[c] is not None}


def quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles in long form (q, value)."""
    wide = exact_quantiles(df, {f"q{i}": (col, q) for i, q in enumerate(probs)})
    pairs = [F.struct(F.lit(float(q)).alias("q"), F.col(f"q{i}").alias("value")) for i, q in enumerate(probs)]
    return wide.select(F.inline(F.array(*pairs)))


def distinct_count(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct non-null values per column, long form.

    Each value is counted after a grouping by (column, value), so no task holds all values of a column.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    seen = df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return seen.groupBy("column").agg(F.count("value").alias("n_distinct"))


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long-format report of numeric columns: count, nulls, distinct, mean, std, extremes and quartiles."""
    stats = {
        "n": lambda c: F.count(c),
        "n_null": lambda c: F.sum(F.col(c).isNull().cast("long")),
        "mean": lambda c: F.avg(c),
        "std": lambda c: F.stddev_samp(c),
        "smallest": lambda c: F.min(F.col(c).cast("double")),
        "largest": lambda c: F.max(F.col(c).cast("double")),
    }
    quartiles = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    one = exact_quantiles(
        df,
        {f"{s}__{c}": (c, q) for c in cols for s, q in quartiles.items()},
        extra=[f(c).alias(f"{s}__{c}") for c in cols for s, f in stats.items()],
    )
    names = [*stats, *quartiles]
    long = one.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{s}__{c}").alias(s) for s in names]) for c in cols])
        )
    )
    return long.join(distinct_count(df, *cols), "column", "left").withColumn(
        "n_distinct", F.coalesce("n_distinct", F.lit(0))
    )


def extremes(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).alias("largest"), F.min(col).alias("smallest"))


def detect_problem_type(df: DataFrame, target: str) -> str:
    """``binary``, ``multiclass`` or ``regression`` from the non-null target values.

    Eleven distinct values decide every case, so no more are counted.
    """
    values = df.select(target).filter(F.col(target).isNotNull()).distinct()
    n = values.limit(11).count()
    if n < 2:
        raise ValueError("the target has fewer than two distinct values")
    if n == 2:
        return "binary"
    numeric = isinstance(df.schema[target].dataType, T.NumericType)
    return "regression" if numeric and n > 10 else "multiclass"
