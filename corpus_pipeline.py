"""The corpus pipeline: toxic texts go, one text of each near-duplicate class stays, texts with benchmark items go, personal
data is redacted, and what is left is packed into sequences.

A stage is a function of (spark, docs, sf_dir); docs is what its predecessor kept, written as parquet and read again. All
but the last return the columns of documents.

Null texts count as empty, and of equal texts one row stays, so of repeated rows, too. Rows whose id is null have no label.
Extra columns pass through, whatever their names; an empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gable.llm import decontamination, neardup, packing, pii, toxicity
from gable.runtime import written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the model, trained on the labelled ones among docs, scores below one half."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates."""
    return neardup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with each span of personal data replaced by its kind."""
    return pii.redact_pii(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their ids, placed in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

#: The trained model and the tokenizer's ids are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
