"""Registered queries of this subpackage and their SQL: thin digests of the operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.llm import chat, decontamination, lexical, licenses, mixing, neardup, packing, pii, quality, repeats, rollups, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_harmonic_packing")
def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


@query("op5_pii_spans")
def op5_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


@query("op6_quality_ratio")
def op6_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *quality.FIGURES, "base_failed", "kept", "score")


@query("op2_license_scan", licenses.SQL)
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


@query("op1_perspective_rotation", chat.SQL)
def op1_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = F.array_join(F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return chat.rotate(table(spark, sf_dir, "conversations")).withColumn("mask", mask)


@query("op9_token_rollup", rollups.SQL)
def op9_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.replayed(table(spark, sf_dir, "documents"))


@query("op8_template_leaks")
def op8_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


@query("op10_string_kernel_toxicity")
def op10_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.digest(toxicity.score_texts(docs, model))


@query("op4_bagminhash_classes", neardup.SQL)
def op4_bagminhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).drop("hash")


@query("op7_suffix_repeats")
def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query("op11_budget_mix")
def op11_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


@query("op12_cholesky_whitening")
def op12_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op13_lexical_tiles", lexical.SQL)
def op13_lexical_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
