"""Writing tables and batch output."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Replace a table (managed, or kept at ``path``) by the rows of ``df`` and read it back."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def write_gzip_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("compression", "gzip").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def save_dated_output(df: DataFrame, path: str, run_date: dt.date | str | None = None) -> DataFrame:
    """Write one gzip partition per run date (replacing that date only) and read it back."""
    day = str(run_date or dt.date.today())
    (
        df.withColumn("run_date", F.lit(day).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy("run_date")
        .parquet(path)
    )
    return df.sparkSession.read.parquet(path).filter(F.col("run_date") == F.lit(day).cast("date"))
