"""Removal of repeated byte strings: what a string of WIDTH bytes covers that also starts anywhere else is cut out.

Every text is cut into stretches: runs of windows of WIDTH bytes that have the same smallest hash among their K-byte
grams, at the same place. Equal windows have equal smallest grams at equal offsets, so they meet under one gram hash.

1. Stretches are counted by gram (with map-side combine). A gram that occurs once has no repeat. If all stretches of a
   gram are equal, all their windows repeat. Both need no bytes.
2. Where stretches of a gram differ (at the edges of copied passages), one stretch of each kind goes, with its bytes, to
   a shard with all others of its gram. A shard is a suffix array by induced sorting with its permuted common prefixes:
   a window repeats if a neighbour in the array shares WIDTH bytes. Kinds that occur more than once repeat as a whole.
3. Grams with more than MAX_RECORDS kinds would make a shard too large; their windows are counted by two 64-bit hashes
   instead, spread over all tasks, with the same result.
4. Runs are gathered per text, merged, and cut out.

Positions are bytes of UTF-8; matches never cross texts. Null texts count as empty, texts of fewer than WIDTH bytes have
no windows. Repeated rows are places of their own, so they remove each other. Extra columns are ignored. Texts beyond
PIECE bytes are searched in overlapping pieces. What is collected per text is bounded by the text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gable.llm.rows import text_of
from gable.llm.suffixes import repeated_windows
from gable.llm.textio import Chunk, chunks, mix, powers, prefix_hash, span_hashes, texts_of
from gable.runtime import written

WIDTH, K = 200, 24
SHARD_BYTES, MAX_RECORDS = 1 << 19, 16_384
PIECE = 1 << 22
#: Low bits of a gram's hash that give way to its place in a chunk.
_PLACE = 24
_SECOND = np.uint64(0xA0761D6478BD642F)


def stretches(chunk: Chunk, width: int = WIDTH, k: int = K) -> tuple[np.ndarray, ...]:
    """Owner, start (in its text), number of windows, gram hash and content hash of each stretch of a chunk."""
    n = len(chunk.data)
    none = np.zeros(0, np.int64)
    if n <= width:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    prefix = prefix_hash(chunk.data)
    grams = mix((prefix[k:] - prefix[:-k]) * powers(n, True)[: n - k + 1])
    mask = np.uint64((1 << _PLACE) - 1)
    low = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    span, size = width - k + 1, 1
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[: n - width + 1], low[span - size :][: n - width + 1])
    inside = np.zeros(n + 1, np.int64)
    long = chunk.ends - chunk.begins >= width
    np.add.at(inside, chunk.begins[long], 1)
    np.add.at(inside, chunk.ends[long] - width + 1, -1)
    valid = np.cumsum(inside)[: len(low)] > 0
    # Texts are apart by a newline, so windows of different texts are never neighbours among the valid ones.
    at = np.flatnonzero(valid)
    if not len(at):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    new = np.concatenate(([True], (low[at][1:] != low[at][:-1]) | (np.diff(at) > 1)))
    first = at[new]
    count = np.diff(np.append(np.flatnonzero(new), len(at)))
    owner = chunk.owner(first)
    return owner, first - chunk.begins[owner], count, grams[(low[first] & mask).astype(np.int64)], span_hashes(prefix, first, first + count - 1 + width)


def _cut_pieces(texts: list[bytes], width: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts in pieces that overlap by width - 1 bytes, the text of each piece, and where it begins."""
    if max(map(len, texts), default=0) <= PIECE:
        return texts, np.arange(len(texts)), np.zeros(len(texts), np.int64)
    parts = [(t[b : b + PIECE + width - 1], i, b) for i, t in enumerate(texts) for b in range(0, max(1, len(t)), PIECE)]
    return [p for p, _, _ in parts], np.array([i for _, i, _ in parts]), np.array([b for _, _, b in parts], np.int64)


def _stretch_rows(rows: DataFrame, width: int) -> DataFrame:
    """row, gram, content, start and n (windows) of all stretches of (row, text)."""

    def run(batches):
        for batch in batches:
            pieces, of, begin = _cut_pieces(texts_of(batch.column("text")), width)
            for chunk in chunks(pieces):
                owner, start, count, gram, content = stretches(chunk, width)
                owner = owner + chunk.first
                columns = [gram.view(np.int64), content.view(np.int64), start + begin[owner], count.astype(np.int16)]
                yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(of[owner])), *map(pa.array, columns)], ["row", "gram", "content", "start", "n"])

    return rows.mapInArrow(run, "row long, gram long, content long, start long, n short")


def _records(texts: DataFrame, width: int) -> DataFrame:
    """gram, row, start, times and bytes of the stretches wanted of each text (row, text, wanted)."""

    def run(batches):
        for batch in batches:
            out = []
            for row, text, wanted in zip(batch.column("row").to_pylist(), texts_of(batch.column("text")), batch.column("wanted").to_pylist()):
                out += [(w["gram"], row, w["start"], w["times"], w["hot"], text[w["start"] : w["start"] + w["n"] - 1 + width]) for w in wanted]
                if len(out) > 5000:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    return texts.mapInArrow(run, "gram long, row long, start long, times long, hot boolean, bytes binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["gram", "row", "start", "times", "hot", "bytes"])


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge[0::2], edge[1::2]


def _shards(records: DataFrame, width: int) -> DataFrame:
    """row, start and end of the repeated bytes of stretches that occur once, among all stretches of their gram."""

    def search(shard: list[tuple]) -> pa.RecordBatch:
        out = []
        for (_, row, start, times, _), flags in zip(shard, repeated_windows([r[4] for r in shard], width)):
            if times == 1 and flags.any():
                out += [(row, start + int(a), start + int(b) - 1 + width) for a, b in zip(*_runs(flags))]
        columns = zip(*out) if out else [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["row", "start", "end"])

    def run(batches):
        shard, size, last = [], 0, None
        for batch in batches:
            for record in zip(*(batch.column(c).to_pylist() for c in ("gram", "row", "start", "times", "bytes"))):
                if record[0] != last and size >= SHARD_BYTES:
                    yield search(shard)
                    shard, size = [], 0
                last = record[0]
                shard.append(record)
                size += len(record[4])
        if shard:
            yield search(shard)

    return records.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "row long, start long, end long")


def _counted_windows(records: DataFrame, width: int) -> DataFrame:
    """The same for grams with too many stretches for a shard, by counting windows."""

    def run(batches):
        for batch in batches:
            for row, start, times, data in zip(*(batch.column(c).to_pylist() for c in ("row", "start", "times", "bytes"))):
                prefix = prefix_hash(np.frombuffer(data, np.uint8))
                at = np.arange(len(data) - width + 1)
                one = span_hashes(prefix, at, at + width)
                two = mix(one * _SECOND + prefix[at + width // 2] * powers(len(prefix), True)[at] - prefix[at] * powers(len(prefix), True)[at])
                arrays = [pa.array(np.full(len(at), x, np.int64)) for x in (row, times)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(at + start), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], ["row", "times", "start", "one", "two"])

    windows = records.mapInArrow(run, "row long, times long, start long, one long, two long")
    often = windows.groupBy("one", "two").agg(F.sum("times").alias("all")).where(F.col("all") > 1).select("one", "two")
    return windows.where("times = 1").join(often, ["one", "two"]).select("row", "start", (F.col("start") + width).alias("end"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of a union of spans."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def find_repeats(docs: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """The texts (row, doc_id, text), and the repeated spans (row, start, end; may overlap). Equal rows share a row id."""
    doc_id = docs["doc_id"].cast("long")
    texts = docs.select(F.xxhash64(doc_id, text_of(docs)).alias("row"), doc_id.alias("doc_id"), text_of(docs).alias("text"))
    every = _stretch_rows(texts.select("row", "text"), width)
    grams = every.groupBy("gram").agg(F.count(F.lit(1)).alias("all"), F.min("content").alias("low"), F.max("content").alias("high"))
    grams = grams.where(F.col("all") > 1).select("gram", (F.col("low") != F.col("high")).alias("mixed"))
    shared = written(every.join(grams, "gram"))
    end = (F.col("start") + F.col("n") - 1 + width).alias("end")

    mixed = shared.where("mixed")
    kinds = mixed.groupBy("gram", "content").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("row", "start", "n")).alias("at"))
    number = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).select(F.col("gram").alias("of"), (F.col("kinds") > MAX_RECORDS).alias("hot"))
    kinds = written(kinds.join(number, F.col("gram") == F.col("of")).select("gram", "content", "times", "at", "hot"))
    often = kinds.where("times > 1").select("gram", "content")
    whole = shared.where("not mixed").select("row", "start", end).unionByName(mixed.join(often, ["gram", "content"]).select("row", "start", end))

    wanted = kinds.groupBy(F.col("at.row").alias("row")).agg(F.collect_list(F.struct("gram", F.col("at.start").alias("start"), F.col("at.n").alias("n"), "times", "hot")).alias("wanted"))
    with_wanted = texts.select("row", "text").join(wanted, "row").dropDuplicates(["row"])
    records = written(_records(with_wanted, width))
    edges = _shards(records.where("not hot"), width).unionByName(_counted_windows(records.where("hot"), width))
    return texts, whole.unionByName(edges)


def remove_repeats(docs: DataFrame, width: int = WIDTH, with_text: bool = True) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, spans (array of start, end), kept_sha256 and, if asked for, kept (binary)."""
    texts, spans = find_repeats(docs, width)
    gathered = spans.groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = texts.join(gathered, "row", "left").select("doc_id", "text", "spans")
    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            ids, removed, sizes, hashes, kept_texts = batch.column("doc_id"), [], [], [], []
            texts = texts_of(batch.column("text"))
            for text, found in zip(texts, batch.column("spans").to_pylist()):
                runs = merged([(s["start"], s["end"]) for s in found or ()])
                kept, at = [], 0
                for a, b in runs:
                    kept.append(text[at:a])
                    at = b
                kept = b"".join([*kept, text[at:]])
                removed.append([{"start": a, "end": b} for a, b in runs])
                sizes.append(len(text) - len(kept))
                hashes.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept)
            arrays = [ids, pa.array([len(t) for t in texts], pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.list_(pair)), pa.array(hashes, pa.string())]
            arrays += [pa.array(kept_texts, pa.binary())] if with_text else []
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", *(["kept"] if with_text else [])])

    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string" + ", kept binary" * with_text
    return joined.mapInArrow(run, schema)
