"""Mixing sources to target weights: each source's budget of words is met by whole documents, with repeats.

Sources stand by code point, null last; their weights are WEIGHTS over and over. They share all words of the table by weight,
but no source gives more than MOST times its own words: what is above goes to the others by weight, until none is above.

A target of q whole rounds and a rest takes every document q times, and for the rest a subset of the source's documents:

1. Documents are counted by exact length. Each length gets its share of all but WINDOW words of the rest, rounded down, and the
   longest lengths are filled up until at most WINDOW words are missing.
2. For these a bounded knapsack over the lengths left (each as often as documents are left) finds the sum nearest to the
   budget, the smaller one on ties, by dynamic programming over all sums up to twice the budget.
3. Of each length, the documents that come first by the md5 of the seed and the row are taken.

A group of documents of one length may hold any share of the rows: it is ranked in hash buckets, and only where a length is
taken in part. The program for a source sees its distinct lengths only; k of them need k * k / 2 words, so there are few
(14 million for a source of 1e14 words), and its tables follow WINDOW or, if only longer texts are left, the longest text.

Null texts have no words; documents without words are never taken. Repeated rows count and are returned as often as they
stand, and rows that share an id are separate documents. Null ids stay null. An empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gable.llm.rows import text_of
from gable.llm.textio import SPACE, chunks, mix, texts_of
from gable.operators.spread import lookup_join, rank_by_hash, rank_by_order, running_totals
from gable.runtime import written

WEIGHTS = (1, 2, 3)
MOST = 3
WINDOW = 1 << 14


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, part (the source, never null), row (tells rows apart) and size (words) of each row."""
    source = docs["source"].cast("string")
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.when(source.isNull(), "0").otherwise(F.concat(F.lit("1"), source)).alias("part"),
        text_of(docs).alias("text"),
    )
    rows = rows.select("doc_id", "part", F.concat_ws("|", "doc_id", F.xxhash64("text")).alias("row"), "text")

    def run(batches):
        for batch in batches:
            found = [np.bincount(c.owner(c.spans(SPACE)[0]), minlength=c.n) for c in chunks(texts_of(batch.column("text")))]
            size = pa.array(np.concatenate(found) if found else np.zeros(0)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), batch.column("row"), size], ["doc_id", "part", "row", "size"])

    return rows.mapInArrow(run, "doc_id long, part string, row string, size long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """part, source_size and target of each source (part, source_size)."""
    # Null is part 0, behind all others.
    named = sources.withColumn("last", F.col("part") == "0")
    placed = rank_by_order(named, ["last", "part"], rank_col="place").drop("last")
    nth = F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int") + 1
    weighed = placed.withColumns({"weight": F.element_at(F.array(*map(F.lit, weights)), nth).cast("long"), "limit": most * F.col("source_size")})
    # Sources reach their limit in this order as the level rises; the first that does not sets the level.
    weighed = weighed.withColumn("reach", F.col("limit") / F.col("weight"))
    filled = written(running_totals(weighed, ["reach", "place"], ["limit", "weight", "source_size"]))
    left, by = F.col("source_size_total") - F.col("limit_before"), F.col("weight_total") - F.col("weight_before")
    below = F.col("limit") * by.cast("double") >= F.col("weight") * left.cast("double")
    first = filled.where(below).agg(F.min_by(F.struct(left.alias("left"), by.alias("by")), F.struct("reach", "place")).alias("x")).first()
    if first is None or first["x"] is None:
        return filled.select("part", "source_size", F.col("limit").cast("double").alias("target"))
    share = F.col("weight") * F.lit(first["x"]["left"]).cast("double") / F.lit(first["x"]["by"])
    return filled.select("part", "source_size", F.least(F.col("limit").cast("double"), share).alias("target"))


def budget_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = 0, window: int = WINDOW) -> np.ndarray:
    """How many documents of each length to take, at most counts, for a sum as near to budget as may be."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    taken = np.floor(counts * (max(0, budget - window) / total * (1 - 1e-12))).astype(np.int64)
    rest = budget - int((taken * lengths).sum())
    for i in np.argsort(-lengths, kind="stable").tolist():
        if rest <= window:
            break
        length = int(lengths[i])
        more = min(int(counts[i] - taken[i]), -(-(rest - window) // length), rest // length)
        taken[i] += more
        rest -= more * length
    # Beyond twice the rest, nothing is nearer than to take nothing.
    top = 2 * rest
    usable = np.flatnonzero((counts > taken) & (lengths <= top))
    usable = usable[np.argsort(mix(lengths[usable].astype(np.uint64) + np.uint64(seed)))]
    reached, by, steps = np.zeros(top + 1, bool), np.full(top + 1, -1, np.int64), []
    reached[0] = True
    for i in usable.tolist():
        length = int(lengths[i])
        left, part = min(int(counts[i] - taken[i]), top // length), 1
        while left and not reached[rest]:
            n = min(part, left)
            left, part = left - n, part * 2
            new = np.flatnonzero(reached[: top + 1 - n * length] & ~reached[n * length :]) + n * length
            reached[new] = True
            by[new] = len(steps)
            steps.append((i, n))
        if reached[rest]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - rest))])
    while at:
        i, n = steps[by[at]]
        taken[i] += n
        at -= n * int(lengths[i])
    return taken


def plan(rows: DataFrame, seed: int, weights: Sequence[int], most: int) -> DataFrame:
    """part, size, n, source_size, target, rounds and extra: of n documents of a length, all are taken ``rounds`` times
    and ``extra`` of them once more."""
    lengths = written(rows.groupBy("part", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = lengths.groupBy("part").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    wanted = written(targets(written(sources), weights, most))

    def run(of: pd.DataFrame) -> pd.DataFrame:
        of = of.sort_values("size", ignore_index=True)
        whole = int(of["source_size"].iloc[0])
        rounds, budget = divmod(int(np.floor(of["target"].iloc[0] + 0.5)), whole) if whole else (0, 0)
        extra = np.zeros(len(of), np.int64)
        some = of["size"].to_numpy() > 0
        if budget:
            extra[some] = budget_counts(of["size"].to_numpy()[some], of["n"].to_numpy()[some], budget, seed)
        return of.assign(rounds=rounds, extra=extra)

    kind = "part string, size long, n long, source_size long, target double, rounds long, extra long"
    return lengths.join(wanted, "part").select("part", "size", "n", "source_size", "target").groupBy("part").applyInPandas(run, kind)


def mixed(docs: DataFrame, seed: int = 0, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target and taken (words of it in the mix) of every row."""
    rows = written(measured(docs))
    placed = written(lookup_join(rows, written(plan(rows, seed, weights, most)), ["part", "size"], "inner", weight="n"))
    some = (F.col("extra") > 0) & (F.col("extra") < F.col("n"))
    ranked = rank_by_hash(placed.where(some), "row", seed, ["part", "size"])
    times = F.col("rounds") + F.when(F.col("rank") <= F.col("extra"), 1).otherwise(0)
    rest = placed.where(~some).withColumn("rank", F.lit(1))
    return ranked.unionByName(rest).select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"))
