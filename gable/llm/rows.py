"""Row identity and repeated rows, for operators over tables whose id may be null or repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def row_key(docs: DataFrame, id_column: str = "doc_id", column: str = "text") -> Column:
    """Identifies a row by its id and its text, so that repeated ids with other texts stay apart."""
    return F.struct(docs[id_column].cast("long").alias("id"), F.xxhash64(text_of(docs, column)).alias("hash"))
