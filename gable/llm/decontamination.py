"""Benchmark decontamination by template windows.

Texts become templates: numbers (digits, number words), units after a number, and names (capitalised words inside a
sentence; runs count once) turn into typed placeholders, all else into lower-case words. Runs of WINDOW template words of
documents and benchmark items are joined on their hash. So are, whatever they are made of, runs of WINDOW plain words (lower
case, nothing typed), since names are known by their capital only: a copy in other case is found by these. A document leaks
an item if its template windows, or those and the plain ones together, cover at least MIN_WINDOWS windows of the item (for
shorter items all but those at the first and last word, which may be typed otherwise next to other text). Alignments count only if their slots are consistent: the same
value in the item must mostly stand for the same value in the document, so that re-parameterised questions are caught
while texts that only share their form are not.

Document windows are first tested against a bit table of the benchmark's windows. The table has FILTER_BITS bits whatever
the size of the benchmark, and lets no match go; what passes is joined by Spark. Sets that are collected per document
and item are bounded by that item and that document.

Items of fewer than WINDOW words are searched by one window of all their plain words; those of fewer than MIN_WORDS must stand
as a sentence or a line of their own. Template windows need MIN_WORDS plain words. Null texts count as empty and match
nothing. Repeated rows of a document are one result, repeated items keep their ids apart (null is an id).
Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gable.llm.rows import row_key, text_of
from gable.llm.textio import NOT_ALNUM, Chunk, byte_class, chunks, gram_hashes, mix, prefix_hash, span_hashes, texts_of
from gable.runtime import written

WINDOW = 8
MIN_WORDS = 4
MIN_WINDOWS = 6
MIN_CONSISTENT = 0.8
FILTER_BITS = 1 << 23

# Number words and units.
NUMBER_WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split()
UNITS = "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce ounces pound pounds ml l liter liters litre litres gallon gallons s ms second seconds minute minutes hour hours day days week weeks month months year years dollar dollars cent cents euro euros percent degree degrees meter meters metre metres kilometer kilometers".split()
WORD, NUMBER, UNIT, NAME = 0, 1, 2, 3
TEMPLATE, PLAIN, SHORT = 0, 1, 2
PLACEHOLDERS = np.array([0, 0x1234567890ABCDE1, 0x1234567890ABCDE2, 0x1234567890ABCDE3], np.uint64)

_DIGIT = byte_class((0x30, 0x39))
_CAPITAL = byte_class((0x41, 0x5A))
_SMALL = byte_class((0x61, 0x7A), (0x80, 0xFF))
_BREAK = byte_class(*((ord(c), ord(c)) for c in ".!?:;\n"))


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer(("\n".join(words) + "\n").encode(), np.uint8)
    starts = np.concatenate(([0], np.flatnonzero(data[:-1] == 0x0A) + 1))
    return np.sort(span_hashes(prefix_hash(data), starts, np.flatnonzero(data == 0x0A)))


_NUMBERS, _UNITS = _hash_words(NUMBER_WORDS), _hash_words(UNITS)


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


@dataclass
class Words:
    """Hash, owner and begin of a sentence or line of each plain word, and which of them begin a template word; hash and slot
    value (0 for plain words) of each template word."""

    plain: np.ndarray
    owner: np.ndarray
    opens: np.ndarray
    kept: np.ndarray
    words: np.ndarray
    slots: np.ndarray


def read_words(chunk: Chunk) -> Words:
    data = chunk.data
    starts, ends = chunk.spans(NOT_ALNUM)
    if not len(starts):
        hashes, places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return Words(hashes, places, np.zeros(0, bool), places, hashes, hashes)
    prefix, owner = prefix_hash(chunk.lowered()), chunk.owner(starts)
    hashes = span_hashes(prefix, starts, ends)
    kind = np.zeros(len(starts), np.int8)
    first_of_text = np.concatenate(([True], owner[1:] != owner[:-1]))
    breaks = np.concatenate(([0], np.cumsum(_BREAK[data])))
    opens = first_of_text | np.concatenate(([True], breaks[starts[1:]] > breaks[ends[:-1]]))
    second = data[np.minimum(starts + 1, len(data) - 1)]
    two_byte = (data[starts] == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    after = data[np.minimum(starts + 1 + two_byte, len(data) - 1)]
    kind[(_CAPITAL[data[starts]] | two_byte) & _SMALL[after] & ~opens] = NAME
    kind[_DIGIT[data[starts]] | _among(hashes, _NUMBERS)] = NUMBER
    after_number = np.concatenate(([False], (kind[:-1] == NUMBER))) & ~first_of_text
    kind[after_number & (kind != NUMBER) & _among(hashes, _UNITS)] = UNIT
    goes_on = np.concatenate(([False], (kind[1:] == kind[:-1]) & ((kind[1:] == NUMBER) | (kind[1:] == NAME)))) & ~first_of_text
    kept = np.flatnonzero(~goes_on)
    last = np.concatenate((kept[1:], [len(starts)])) - 1
    values = span_hashes(prefix, starts[kept], ends[last])
    kind = kind[kept]
    words, slots = np.where(kind > 0, PLACEHOLDERS[kind], hashes[kept]), np.where(kind > 0, values | np.uint64(1), np.uint64(0))
    return Words(hashes, owner, opens, kept, words, slots)


def template(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, slot value (0 for plain words) and owner of each template word of a chunk."""
    found = read_words(chunk)
    return found.words, found.slots, found.owner[found.kept]


def _inside(owner: np.ndarray, k: int) -> np.ndarray:
    """Where k consecutive words of one text begin."""
    n = len(owner) - k + 1
    return np.flatnonzero(owner[k - 1 :] == owner[:n]) if n > 0 else np.zeros(0, np.int64)


def windows(chunk: Chunk, lengths: list[int] | None) -> tuple[np.ndarray, ...]:
    """Kind, hash, position in its text, the same in plain words, value of the slot that opens it and that closes it (or 0),
    whether it touches neither the first nor the last word, and owner of each window. SHORT windows are those of the given
    numbers of words or, without these, the texts of fewer than WINDOW words as a whole."""
    w = read_words(chunk)
    texts = np.arange(chunk.n + 1)
    begin = np.searchsorted(w.owner, texts)
    of = w.owner[w.kept]
    t_begin = np.searchsorted(of, texts)
    good = _inside(of, WINDOW)
    n_plain = np.concatenate(([0], np.cumsum(w.slots == 0)))
    good = good[n_plain[good + WINDOW] - n_plain[good] >= MIN_WORDS]
    owner, last = of[good], w.slots[good + WINDOW - 1]
    inner = (good > t_begin[owner]) & (good + WINDOW < t_begin[owner + 1])
    grams = gram_hashes(w.words, WINDOW)
    out = [(np.full(len(good), TEMPLATE), grams[good], good - t_begin[owner], w.kept[good] - begin[owner], w.slots[good], last, inner, owner)]

    def add(kind: int, k: int, at: np.ndarray) -> None:
        owner, none = w.owner[at], np.zeros(len(at), np.uint64)
        inner = (at > begin[owner]) & (at + k < begin[owner + 1])
        # Another hash than that of a template, and another one for each length.
        hashes = mix(gram_hashes(w.plain, k)[at] + np.uint64(k))
        out.append((np.full(len(at), kind), hashes, at - begin[owner], at - begin[owner], none, none, inner, owner))

    add(PLAIN, WINDOW, _inside(w.owner, WINDOW))
    for k in range(1, WINDOW) if lengths is None else lengths:
        at = _inside(w.owner, k)
        if lengths is None:
            size = np.diff(begin)[w.owner[at]]
            at = at[size == k]
        elif k < MIN_WORDS:
            ends = np.append(w.opens, True)
            at = at[w.opens[at] & ends[at + k]]
        add(SHORT, k, at)
    return tuple(np.concatenate(x) for x in zip(*out))


def _window_rows(rows: DataFrame, keys: dict[str, str], known: tuple[np.ndarray, list[int]] | None) -> DataFrame:
    """keys, kind, place, raw, gram, slot, last and inner of the windows of each row of (keys, text); given a bit table and the
    lengths of short items, only those in the table."""
    shared = None if known is None else rows.sparkSession.sparkContext.broadcast(known)
    names = list(keys)
    shift = np.uint64(64 - (FILTER_BITS.bit_length() - 1))

    def run(batches):
        for batch in batches:
            for chunk in chunks(texts_of(batch.column("text"))):
                found = windows(chunk, None if shared is None else shared.value[1])
                if shared is not None:
                    table, bits = shared.value[0], found[1] >> shift
                    hit = np.flatnonzero((table[(bits >> np.uint64(6)).astype(np.int64)] >> (bits & np.uint64(63))) & np.uint64(1))
                    found = [x[hit] for x in found]
                kind, grams, places, raw, slots, last, inner, owner = found
                of = pa.array(owner + chunk.first)
                arrays = [batch.column(k).take(of) for k in names]
                arrays += [pa.array(kind.astype(np.int32)), pa.array(places), pa.array(raw), *(pa.array(x.view(np.int64)) for x in (grams, slots, last)), pa.array(inner)]
                yield pa.RecordBatch.from_arrays(arrays, [*names, "kind", "place", "raw", "gram", "slot", "last", "inner"])

    schema = ", ".join(f"{k} {t}" for k, t in keys.items()) + ", kind int, place long, raw long, gram long, slot long, last long, inner boolean"
    return rows.select(*names, "text").mapInArrow(run, schema)


def bit_table(grams: DataFrame) -> np.ndarray:
    """FILTER_BITS bits, set where a window's leading bits point. At most FILTER_BITS / 64 rows reach the driver."""
    bits = FILTER_BITS.bit_length() - 1
    place = F.shiftrightunsigned("gram", 64 - bits)
    rows = grams.groupBy((F.shiftright(place, 6)).alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(gram, {64 - bits}) & 63 as int)))").alias("bits"))
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for word, value in rows.collect():
        table[word] = value
    return table.view(np.uint64)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, key (identity of the row), item_id, n_windows, item_windows, coverage, n_slots and consistency of each leak."""
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), text_of(benchmark).alias("text"))
    columns = {"place": "ipos", "raw": "iraw", "slot": "islot", "last": "ilast"}
    known = written(_window_rows(items, {"item_id": "long"}, None).withColumnsRenamed(columns))
    lengths = list(range(1, WINDOW)) if known.where(F.col("kind") == SHORT).limit(1).count() else []
    rows = docs.select(row_key(docs).alias("key"), text_of(docs).alias("text")).select("key.id", "key.hash", "text")
    found = _window_rows(rows, {"id": "long", "hash": "long"}, (bit_table(known), lengths)).drop("kind", "raw", "inner")
    both = found.join(known, "gram")
    slot = F.when(F.col("islot") != 0, F.struct("islot", "slot"))
    last = F.when(F.col("ilast") != 0, F.struct(F.col("ilast").alias("islot"), F.col("last").alias("slot")))
    aligned = both.groupBy("id", "hash", "item_id", "kind", (F.col("place") - F.col("ipos")).alias("diagonal")).agg(
        F.collect_set("iraw").alias("at"), F.collect_set(F.when(F.col("inner"), F.col("iraw"))).alias("inner_at"), F.array_union(F.collect_set(slot), F.collect_set(last)).alias("slots")
    )
    values = F.size(F.array_distinct(F.transform("slots", lambda s: s["islot"])))
    share = F.when(F.size("slots") > 0, values / F.size("slots")).otherwise(1.0)
    kept = aligned.withColumns({"n_slots": F.size("slots"), "consistency": share}).where(F.col("consistency") >= MIN_CONSISTENT)
    template, plain, short = (F.col("kind") == k for k in (TEMPLATE, PLAIN, SHORT))

    def number(flag: Column) -> Column:
        return F.coalesce(F.count_if(flag), F.lit(0))

    def distinct(at: str, flag: Column | None = None) -> Column:
        return F.size(F.array_distinct(F.flatten(F.collect_list(at if flag is None else F.when(flag, F.col(at)))))).cast("long")

    sizes = known.groupBy("item_id").agg(
        F.countDistinct("iraw").alias("item_windows"),
        number(template).alias("t_windows"), number(template & F.col("inner")).alias("t_inner"),
        number(plain).alias("p_windows"), number(plain & F.col("inner")).alias("p_inner"),
    )
    merged = kept.groupBy("id", "hash", "item_id").agg(
        distinct("at").alias("n_windows"),
        distinct("at", template).alias("t_n"), distinct("inner_at", template).alias("t_n_inner"),
        distinct("inner_at").alias("n_inner"), F.max(short).alias("whole"),
        F.max("n_slots").cast("long").alias("n_slots"),
        F.min("consistency").alias("consistency"),
    )
    sized = merged.join(sizes.withColumnRenamed("item_id", "of"), F.col("item_id").eqNullSafe(F.col("of")))

    def covered(n: str, n_inner: str, windows: str, inner: str) -> Column:
        few = (F.col(windows) <= MIN_WINDOWS) & (F.col(windows) > 0) & (F.col(n_inner) >= F.col(inner))
        return (F.col(n) >= MIN_WINDOWS) | (few & (F.col(n) > 0))

    enough = F.col("whole") | covered("t_n", "t_n_inner", "t_windows", "t_inner") | covered("n_windows", "n_inner", "p_windows", "p_inner")
    return sized.where(enough).select(
        F.col("id").alias("doc_id"), F.struct("id", "hash").alias("key"), "item_id", "n_windows", "item_windows",
        F.round(F.col("n_windows") / F.col("item_windows"), 6).alias("coverage"), "n_slots", "consistency",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with their columns, that leak no item."""
    bad = leaks(docs, benchmark).select(F.col("key.id").alias("bad_id"), F.col("key.hash").alias("bad_hash")).distinct()
    key = row_key(docs)
    return docs.join(bad, key["id"].eqNullSafe(bad["bad_id"]) & (key["hash"] == bad["bad_hash"]), "left_anti")
