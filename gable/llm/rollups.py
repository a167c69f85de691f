"""Token counts kept as rollups: batches of signed changes add to totals by source, language and tokenizer version.

A change is an insert, a delete or a revised count of one document. A batch is summed per key (with Spark's map-side
combine, so a hot source is no matter) and written as one folder named after its id. A batch counts once its folder holds
the success marker; committing the same id again leaves the folder as it is, and a batch that was lost half-way is written
again as a whole. Totals are sums over the committed folders, so the order of batches does not matter. compact() folds
batches into a snapshot that records which ids it holds; a snapshot counts once it is complete.

Null counts are 0, null sources, languages and versions are keys like any other. Repeated rows are changes of their own.
Keys whose documents and tokens have all gone are left out. Empty batches are committed like others. Extra columns are
ignored. An unknown kind of change raises an error.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.llm.rows import text_of
from gable.runtime import scratch_path, written

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
# The patterns whose matches are the tokens of each version.
VERSIONS = {"space_words_v1": r"[^\x20\x09-\x0D]+", "signs_v2": r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"}


def count_tokens(text: Column, version: str) -> Column:
    return F.regexp_count(text, F.lit(VERSIONS[version])).cast("long")


class Rollup:
    """Totals below a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _list(self, name: str) -> list[str]:
        """Names of the complete folders below one of the rollup's folders."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(root):
            return []
        there = [s.getPath() for s in system.listStatus(root)]
        marker = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(p.getName() for p in there if system.exists(marker(p, "_SUCCESS")))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of (kind, source, lang, tokenizer, n_tokens, old_tokens); False if the id was committed before.

        kind is insert, delete or revise; a delete names the count it takes away, a revise the new and the old one.
        """
        if not re.fullmatch(r"[A-Za-z0-9.-]+", batch):
            raise ValueError("a batch id consists of letters, digits, dots and hyphens")
        if batch in self._list("batches") or batch in self._folded()[1]:
            return False
        new, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
        unknown = F.raise_error(F.concat(F.lit("unknown kind of change: "), F.coalesce("kind", F.lit("null"))))
        docs = F.when(F.col("kind") == "insert", 1).when(F.col("kind") == "delete", -1).when(F.col("kind") == "revise", 0).otherwise(unknown.cast("int"))
        tokens = F.when(F.col("kind") == "insert", new).when(F.col("kind") == "delete", -new).otherwise(new - old)
        summed = changes.groupBy(*KEYS).agg(F.sum(docs).cast("long").alias("n_docs"), F.sum(tokens).cast("long").alias("n_tokens"))
        summed.write.mode("overwrite").parquet(f"{self.path}/batches/{batch}")
        return True

    def _folded(self) -> tuple[str | None, list[str]]:
        """The latest snapshot, and the ids of the batches it holds."""
        kept = self._list("snapshots")
        if not kept:
            return None, []
        return kept[-1], [r["batch"] for r in self.spark.read.schema("batch string").parquet(f"{self.path}/folded/{kept[-1]}").collect()]

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs and n_tokens."""
        return self._summed(self._list("batches"))

    def _summed(self, batches: list[str]) -> DataFrame:
        """The latest snapshot with those of the batches that it does not hold."""
        snapshot, folded = self._folded()
        paths = [f"{self.path}/batches/{b}" for b in batches if b not in folded]
        paths += [f"{self.path}/snapshots/{snapshot}"] if snapshot else []
        rows = self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        summed = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return summed.where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> None:
        """Fold all committed batches into a new snapshot. The list of ids is written first, the totals last; batches that
        are committed meanwhile are in neither."""
        latest, folded = self._folded()
        batches = self._list("batches")
        ids = sorted({*folded, *batches})
        name = f"{int(latest or 0) + 1:08d}"
        self.spark.createDataFrame([(i,) for i in ids], "batch string").write.mode("overwrite").parquet(f"{self.path}/folded/{name}")
        self._summed(batches).write.mode("overwrite").parquet(f"{self.path}/snapshots/{name}")


def replayed(docs: DataFrame) -> DataFrame:
    """Totals after a history of batches derived from the documents, some of them delivered twice.

    Load all documents under the first version; count them anew under the second; revise the first counts of texts with
    digits, which are masked (each run of digits goes); delete the later copies of equal texts from both versions.
    """
    spark, text = docs.sparkSession, text_of(docs)
    first, second = VERSIONS
    path = scratch_path(spark, "rollup")
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), docs["lang"].cast("string").alias("lang"),
        count_tokens(text, first).alias("v1"), count_tokens(text, second).alias("v2"),
        F.when(text.rlike("[0-9]"), count_tokens(F.regexp_replace(text, "[0-9]+", ""), first)).alias("masked"),
        F.sha2(text, 256).alias("digest"),
    )
    rows.write.parquet(f"{path}/counts")
    rows = spark.read.schema(rows.schema).parquet(f"{path}/counts")
    # Written, so that the join can split a hot text.
    kept = written(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    copies = rows.join(kept.select("digest", "first"), "digest").where("doc_id > first")
    change = lambda df, kind, version, new, old=None: df.select(
        F.lit(kind).alias("kind"), "source", "lang", F.lit(version).alias("tokenizer"), F.col(new).alias("n_tokens"), (F.col(old) if old else F.lit(0)).alias("old_tokens")
    )
    current = copies.withColumn("v1", F.coalesce("masked", "v1"))
    rollup = Rollup(spark, path)
    rollup.commit("1-load", change(rows, "insert", first, "v1"))
    rollup.commit("2-upgrade", change(rows, "insert", second, "v2"))
    rollup.commit("2-upgrade", change(rows, "insert", second, "v2"))
    rollup.compact()
    rollup.commit("3-mask", change(rows.where("masked is not null"), "revise", first, "masked", "v1"))
    rollup.commit("4-copies", change(current, "delete", first, "v1").unionByName(change(current, "delete", second, "v2")))
    rollup.commit("1-load", change(rows, "insert", first, "v1"))
    rollup.commit("4-copies", change(current, "delete", first, "v1"))
    return rollup.totals()


SQL = f"""
WITH counts AS (SELECT doc_id, source, lang, text, len(regexp_extract_all(text, '{VERSIONS["signs_v2"]}')) AS v2,
  len(regexp_extract_all(regexp_replace(text, '[0-9]+', '', 'g'), '{VERSIONS["space_words_v1"]}')) AS v1
  FROM (SELECT * REPLACE (coalesce(text, '') AS text) FROM documents)),
kept AS (SELECT * FROM counts WHERE doc_id = (SELECT min(doc_id) FROM counts c WHERE c.text = counts.text))
SELECT source, lang, 'space_words_v1' AS tokenizer, count(*) AS n_docs, sum(v1)::BIGINT AS n_tokens FROM kept GROUP BY source, lang
UNION ALL SELECT source, lang, 'signs_v2', count(*), sum(v2)::BIGINT FROM kept GROUP BY source, lang"""
