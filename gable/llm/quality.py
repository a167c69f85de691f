"""Quality rules, and an n-gram likelihood ratio between a trusted target and the raw corpus.

Words are runs of bytes other than ASCII white space. Unigrams and bigrams are told apart by 64-bit hashes, each with
counts of its own. Two multinomials are estimated: one from all documents, one from the documents whose label says good quality. A text's
score is the mean, over its n-grams, of log p_target - log p_raw, so length does not matter. Its own n-grams are left
out of both counts, so that labelled and unlabelled texts are judged alike. Smoothing adds ALPHA to the target's counts
and as much, in proportion, to the raw ones: n-grams never seen elsewhere weigh nothing.
The score is compared with one threshold: every text is decided, and always the same way. Unless given, the threshold
is the one with the fewest errors on labelled texts that pass the rules (over SCORE_BINS score bins, the lowest on ties). Without both kinds of labels the score decides nothing and the rules alone count.

Null texts count as empty: no words, which fails the rules and scores 0. Rows are treated one by one: repeated rows are counted and
returned as often as they stand; labels that are null or contradict each other for one id count as good only if all of
them are good. Extra columns are ignored.

The counts stay distributed. The texts of a task make blocks of about BLOCK_BYTES. A block asks for each of its n-grams once, however
many of its texts hold it: the n-grams go, by the leading bits of their hash, to one of a number of shares that grows with
the corpus (PART_GRAMS n-grams each), are counted there, and the counts come back in the order they were asked for. Which texts
hold which n-grams goes straight to where the answers are read. Of a hash as many bits are kept as the number of n-grams has,
and SPARE_BITS more: at any size an n-gram shares its counts with another one at a probability below 2**-SPARE_BITS.
A task holds one block, or one share's n-grams, at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gable.llm.rows import text_of
from gable.llm.textio import SPACE, Chunk, byte_class, chunks, gram_hashes, mix, prefix_hash, span_hashes, texts_of
from gable.runtime import written

PART_GRAMS, MIN_PARTS, MAX_PARTS = 4_000_000, 8, 1 << 16
BLOCK_BYTES, SPARE_BITS, SLICE = 32 << 20, 16, 1 << 19
#: Ids of good texts are broadcast up to this number (8 bytes each); more are joined by a shuffle of the texts.
BROADCAST_IDS = 1 << 20
#: Sums of log ratios are whole multiples of 1 / UNIT, so that their order does not matter.
UNIT = float(1 << 28)
ALPHA = 2.0
#: Places of a block's n-grams, in the column share: the texts; and for each range of hashes (three numbers less for the next)
#: times, gaps between texts, numbers within texts.
TEXTS, TIMES, GAPS, OWN = -1, -2, -3, -4
SCORE_RANGE, SCORE_BINS = 8.0, 4096
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
# Symbols that the rules count.
SYMBOLS = byte_class(*((ord(c), ord(c)) for c in "#*$%&|<>"))
NEWLINE = byte_class((0x0A, 0x0A))


def _words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, owner and prefix hashes of the chunk's words."""
    prefix = prefix_hash(chunk.data)
    starts, ends = chunk.spans(SPACE)
    return span_hashes(prefix, starts, ends), chunk.owner(starts), prefix


def _grams(words: np.ndarray, owner: np.ndarray, width: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash (its leading bits), owner and number in it of every distinct unigram and bigram of each text, in the order of hashes."""
    same = owner[1:] == owner[:-1] if len(owner) > 1 else np.zeros(0, bool)
    pairs = gram_hashes(words, 2)[same] if len(owner) > 1 else np.zeros(0, np.uint64)
    hashes, of = np.concatenate((mix(words), mix(pairs))), np.concatenate((owner, owner[:-1][same] if len(owner) > 1 else owner[:0]))
    hashes >>= np.uint64(64 - width)
    order = np.lexsort((of, hashes))
    hashes, of = hashes[order], of[order]
    first = np.flatnonzero(np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])))[: len(hashes)])
    return hashes[first], of[first], np.diff(np.append(first, len(hashes)))


def measures(chunk: Chunk) -> dict[str, np.ndarray]:
    """The rules' figures of each text of a chunk."""
    n = chunk.n
    words, owner, prefix = _words(chunk)
    out = {"n_words": np.bincount(owner, minlength=n)}
    out["word_chars"] = chunk.count(((chunk.data & 0xC0) != 0x80) & ~SPACE[chunk.data])
    out["n_symbols"] = chunk.count(SYMBOLS[chunk.data])

    starts, ends = chunk.spans(NEWLINE)
    filled = np.concatenate(([0], np.cumsum(~SPACE[chunk.data], dtype=np.int64)))
    with_word = filled[ends] > filled[starts]
    line_owner = chunk.owner(starts[with_word])
    lines = span_hashes(prefix, starts[with_word], ends[with_word])
    order = np.lexsort((lines, line_owner))
    again = (lines[order][1:] == lines[order][:-1]) & (line_owner[order][1:] == line_owner[order][:-1])
    out["n_dup_lines"] = np.bincount(line_owner[order][1:][again], minlength=n)

    covered = np.zeros(len(words) + 1, np.int64)
    if len(words) > WINDOW:
        windows = gram_hashes(words, WINDOW)
        whole = np.flatnonzero(owner[WINDOW - 1 :] == owner[: len(windows)])
        keys = mix(windows[whole] + owner[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(covered, whole[twice], 1)
        np.add.at(covered, whole[twice] + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(owner, weights=np.cumsum(covered)[: len(words)] > 0, minlength=n).astype(np.int64)
    return out


def good_labels(labels: DataFrame) -> DataFrame:
    """id and good (1 or 0) of every labelled id."""
    flags = labels.select(labels["doc_id"].cast("long").alias("id"), labels["quality"].cast("int").alias("q"))
    return flags.where("id is not null and q is not null").groupBy("id").agg(F.min("q").alias("good"))


def _planes(values: np.ndarray) -> bytes:
    """Little-endian integers, byte by byte: first the lowest bytes of all, then the next (long runs of zeros compress)."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _from_planes(data: memoryview, n: int, kind: type) -> np.ndarray:
    return np.array(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, n).T, order="C").view(kind).ravel()


def _pack(head: list[int], *columns: np.ndarray | bytes) -> bytes:
    """Integers and columns of integers (by bytes, unless coded), compressed."""
    data = np.array(head, np.int64).tobytes() + b"".join(c if isinstance(c, bytes) else _planes(c) for c in columns)
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=6).compress(data, asbytes=True)


def _unpack(blob: bytes) -> memoryview:
    return memoryview(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True))


def _columns(data: memoryview, n: int, *kinds: type):
    """The first n values of each kind, one column after the other."""
    at = 0
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        yield _from_planes(data[at : at + size], n, kind)
        at += size


def _leading(values: np.ndarray) -> np.ndarray:
    """A byte for each integer from 0 to 2**53: itself below 8, else its size in bits and the two bits behind the first."""
    size = np.frexp(values.astype(np.float64))[1]
    return np.where(size < 4, values, 4 * size - 8 + (values >> np.maximum(size - 3, 0).astype(values.dtype)) % 4).astype(np.uint8)


def _left(leading: np.ndarray):
    """For each number of bits that leading bytes leave open: that number and where it is so, SLICE places at a time."""
    open_ = np.maximum(leading.astype(np.int64) // 4 - 1, 0)
    for bits in np.flatnonzero(np.bincount(open_)).tolist():
        where = np.flatnonzero(open_ == bits) if bits else ()
        for i in range(0, len(where), SLICE):
            yield bits, where[i : i + SLICE]


def _sized(values: np.ndarray) -> bytes:
    """Integers as their leading bytes, which compress, and as many bits as those leave open, which would not."""
    leading, out = _leading(values), []
    for bits, where in _left(leading):
        single = np.unpackbits(values[where].astype(">u8").view(np.uint8).reshape(-1, 8)[:, -((bits + 7) // 8) :], axis=1)
        out.append(np.packbits(single[:, -bits:]).tobytes())
    return leading.tobytes() + b"".join(out)


def _from_sized(data: memoryview, n: int) -> tuple[np.ndarray, int]:
    """The first n values, and how many bytes they take."""
    leading, at = np.frombuffer(data, np.uint8, n), n
    size = np.maximum(leading.astype(np.int64) // 4 + 2, 3)
    values = np.where(leading < 8, leading, (4 + leading % 4).astype(np.int64) << (size - 3))
    for bits, where in _left(leading):
        end = at + (bits * len(where) + 7) // 8
        single = np.unpackbits(np.frombuffer(data[at:end], np.uint8))[: bits * len(where)].reshape(-1, bits)
        wide = np.zeros((len(where), 64), np.uint8)
        wide[:, -bits:] = single
        values[where] |= np.packbits(wide, axis=1).view(">i8").ravel()
        at = end
    return values, at


def _counts(raw: np.ndarray, target: np.ndarray) -> bytes:
    """Two counts of each n-gram: a byte for both where they are small; of the others the second in the order of the first's size."""
    both = np.where((raw < 16) & (target < 15), raw * 16 + target, 255).astype(np.uint8)
    more = both == 255
    # A few bits each and without order: only the highest levels don't lose more by copying than they gain.
    first = pa.Codec("zstd", compression_level=19).compress(both.tobytes(), asbytes=True)
    return len(first).to_bytes(8, "little") + first + _sized(raw[more]) + _sized(target[more][np.argsort(_leading(raw[more]), kind="stable")])


def _from_counts(data: memoryview, n: int) -> tuple[np.ndarray, np.ndarray]:
    at = 8 + int.from_bytes(data[:8], "little")
    both = np.frombuffer(pa.decompress(data[8:at], n, codec="zstd", asbytes=True), np.uint8)
    raw, target = (both // 16).astype(np.int64), (both % 16).astype(np.int64)
    more = np.flatnonzero(both == 255)
    raw[more], used = _from_sized(data[at:], len(more))
    target[more[np.argsort(_leading(raw[more]), kind="stable")]] = _from_sized(data[at + used :], len(more))[0]
    return raw, target


def _groups(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))[: len(values)])


def _by_size(numbers: np.ndarray, others: np.ndarray | int = 0) -> np.ndarray:
    """An order that brings numbers of the same size (in bits) together, and of these others: what belongs to them compresses better."""
    size, other = (np.frexp(np.asarray(x, np.float64))[1].astype(np.int16) for x in (numbers, others))
    return np.argsort(size * 64 + other, kind="stable")


def _ask(hashes: np.ndarray, raw: np.ndarray, target: np.ndarray) -> bytes:
    """Hashes in order, with a block's own counts."""
    return _pack([len(hashes)], np.diff(hashes, prepend=np.uint64(0)), _counts(raw.astype(np.int64), target.astype(np.int64)))


def _asked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = _unpack(blob)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    (gaps,) = _columns(data[8:], n, np.uint64)
    return np.cumsum(gaps, dtype=np.uint64), np.stack(_from_counts(data[8 + 8 * n :], n), 1)


class _Block:
    """The n-grams of some texts."""

    def __init__(self, width: int) -> None:
        self.width, self.parts, self.keys, self.good, self.bytes = width, [], [], [], 0

    def add(self, chunk: Chunk, keys: np.ndarray, good: np.ndarray) -> None:
        words, owner, _ = _words(chunk)
        hashes, of, own = _grams(words, owner, self.width)
        self.parts.append((hashes, (of + sum(map(len, self.keys))).astype(np.uint32), own.astype(np.uint32)))
        self.keys.append(keys)
        self.good.append(good)
        self.bytes += len(chunk.data)

    def rows(self, number: int, shares: int):
        """target, block, share, data: to each share its n-grams, and to the block's number (negative) the places."""
        keys, good = np.concatenate(self.keys).astype(np.int64), np.concatenate(self.good).astype(np.uint8)
        longest = np.argsort(-sum(np.bincount(of, minlength=len(keys)) for _, of, _ in self.parts), kind="stable")
        keys, good, place = keys[longest], good[longest], np.empty(len(keys), np.uint32)
        place[longest] = np.arange(len(keys))
        yield number, number, TEXTS, _pack([len(keys)], keys, good)
        # A range of hashes after the other: what is sorted and packed at a time is about SLICE, or an eighth of the block.
        ranges = min(MIN_PARTS, 1 << (sum(len(h) for h, _, _ in self.parts) // SLICE).bit_length())
        cuts = np.arange(1, ranges, dtype=np.uint64) << np.uint64(self.width - (ranges.bit_length() - 1))
        bounds = [np.concatenate(([0], np.searchsorted(h, cuts), [len(h)])) for h, _, _ in self.parts]
        for i in range(ranges):
            hashes, of, own = (np.concatenate([p[c][e[i] : e[i + 1]] for p, e in zip(self.parts, bounds)]) for c in range(3))
            if not len(hashes):
                continue
            of = place[of]
            order = np.lexsort((of, hashes))
            hashes, of, own = hashes[order], of[order], own[order]
            first = _groups(hashes)
            hashes = hashes[first]
            raw, target = np.add.reduceat(own, first), np.add.reduceat(own * good[of], first)
            share = (hashes >> np.uint64(self.width - (shares.bit_length() - 1))).astype(np.int64)
            edges = np.append(_groups(share), len(share)).tolist()
            for a, b in zip(edges, edges[1:]):
                yield int(share[a]), number, int(share[a]), _ask(hashes[a:b], raw[a:b], target[a:b])
            del order, hashes, raw, target, share
            times, gaps = np.diff(np.append(first, len(of))).astype(np.uint32), np.diff(of, prepend=np.uint32(0))
            gaps[first] = of[first]
            by_size = _by_size(times)
            moved = times[by_size]
            begins = (np.cumsum(times, dtype=np.uint32) - times)[by_size] - (np.cumsum(moved, dtype=np.uint32) - moved)
            moved = np.repeat(begins, moved) + np.arange(len(own), dtype=np.uint32)
            yield number, number, TIMES - 3 * i, _pack([len(own), len(times)], times)
            yield number, number, GAPS - 3 * i, _pack([], _sized(gaps[moved]))
            yield number, number, OWN - 3 * i, _pack([], own[moved])


def _sums(places: dict[int, bytes], answers: list[bytes], ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, sum of log ratios and number of n-grams of a block's texts, from the places and the answers in the order of shares."""
    data = _unpack(places[TEXTS])
    docs = int(np.frombuffer(data, np.int64, 1)[0])
    keys, good = _columns(data[8:], docs, np.int64, np.uint8)
    total, number, coming = np.zeros(docs), np.zeros(docs), map(_unpack, answers)
    for i in range(0, 3 * MIN_PARTS, 3):
        if TIMES - i not in places:
            continue
        data = _unpack(places[TIMES - i])
        n, distinct = np.frombuffer(data, np.int64, 2).tolist()
        (times,) = _columns(data[16:], distinct, np.uint32)
        of = _from_sized(_unpack(places[GAPS - i]), n)[0].astype(np.uint32)
        (own,) = _columns(_unpack(places[OWN - i]), n, np.uint32)
        by_size = _by_size(times)
        times = times[by_size]
        first = np.cumsum(times, dtype=np.int64) - times
        starts = of[first]
        np.cumsum(of, dtype=np.uint32, out=of)
        of -= np.repeat(of[first] - starts, times)
        counts, asked, at = np.empty((distinct, 2), np.int64), np.empty((distinct, 2), np.int64), 0
        asked[by_size, 0], asked[by_size, 1] = np.add.reduceat(own, first), np.add.reduceat(own * good[of], first)
        while at < distinct:
            # A share lies in one range: a range's answers are whole.
            data = next(coming)
            size = int(np.frombuffer(data, np.int64, 1)[0])
            here = at + _by_size(*asked[at : at + size].T)
            counts[here, 0], counts[here, 1] = _from_counts(data[8:], size)
            at += size
        gram = np.repeat(by_size.astype(np.uint32), times)
        for a in range(0, n, SLICE):
            part, mine = of[a : a + SLICE], own[a : a + SLICE].astype(np.int64)
            raw, target = counts[gram[a : a + SLICE]].T
            value = np.log(target - mine * good[part] + ALPHA) - np.log((raw - mine) * ratio + ALPHA)
            # Whole numbers: their sums do not depend on the order, nor on the block.
            total += np.bincount(part, weights=np.rint(mine * value * UNIT), minlength=docs)
            number += np.bincount(part, weights=mine, minlength=docs)
    return keys, total.astype(np.int64), number.astype(np.int64)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["target", "block", "share", "data"])


ROWS = "target long, block long, share int, data binary"


def gram_rows(rows: DataFrame, shares: int, width: int) -> DataFrame:
    """The n-grams of rows (key, text, good), block by block: see _Block.rows. Blocks have negative numbers, shares do not."""

    def run(batches):
        block, number = _Block(width), -1 - (TaskContext.get().partitionId() << 32)
        for batch in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
            keys, good = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("key", "good"))
            for chunk in chunks(texts_of(batch.column("text"))):
                if block.bytes and block.bytes + len(chunk.data) > BLOCK_BYTES:
                    yield from (_batch([r]) for r in block.rows(number, shares))
                    block, number = _Block(width), number - 1
                block.add(chunk, keys[chunk.first : chunk.last], good[chunk.first : chunk.last])
        if block.bytes:
            yield from (_batch([r]) for r in block.rows(number, shares))

    return rows.select("key", "text", "good").mapInArrow(run, ROWS)


def _answers(asked: list[tuple[int, int, bytes]]):
    """For each question (block, share, data) of one share the counts over all of them, by the size of the block's own."""
    known, counts, waiting, size = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64), [], 0
    for i, (_, _, blob) in enumerate(asked):
        waiting.append(_asked(blob))
        size += len(waiting[-1][0])
        if size > max(1_000_000, len(known)) or i == len(asked) - 1:
            hashes = np.concatenate([known, *(h for h, _ in waiting)])
            order = np.argsort(hashes, kind="stable")
            first = _groups(hashes[order])
            counts = np.add.reduceat(np.concatenate([counts, *(c for _, c in waiting)])[order], first) if len(first) else counts
            known, waiting, size = hashes[order][first], [], 0
    for block, share, blob in asked:
        hashes, own = _asked(blob)
        raw, target = counts[np.searchsorted(known, hashes[_by_size(own[:, 0], own[:, 1])])].T
        yield _batch([(block, block, share, _pack([len(raw)], _counts(raw, target)))])


def mean_ratios(rows: DataFrame, n_raw: int, n_target: int) -> DataFrame:
    """key and score of each key of rows (key, text, good), given the numbers of n-grams of all texts and of the good ones.
    The score of a good text is computed without its own n-grams in the target, too."""
    shares = max(MIN_PARTS, min(MAX_PARTS, 1 << (n_raw // PART_GRAMS).bit_length()))
    width = min(64, n_raw.bit_length() + SPARE_BITS)
    ratio = n_target / n_raw

    def answer(batches):
        share, asked = None, []
        for batch in batches:
            # Places pass by: only questions are copied.
            asking = batch.filter(pc.greater_equal(batch.column("share"), 0))
            for block, number, data in zip(*(asking.column(c).to_pylist() for c in ("block", "share", "data"))):
                if number != share:
                    yield from _answers(asked)
                    share, asked = number, []
                asked.append((block, number, data))
        yield from _answers(asked)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        places = {share: data for share, data in zip(left["share"].to_pylist(), left["data"].to_pylist()) if share < 0}
        answers = [data for _, data in sorted(zip(right["share"].to_pylist(), right["data"].to_pylist()))]
        found = _sums(places, answers, ratio) if places else (np.zeros(0, np.int64),) * 3
        return pa.table(dict(zip(("key", "total", "size"), map(pa.array, found))))

    # One exchange carries questions and places; both readers of it find their rows by target, so it is used twice. As many tasks
    # as shares: the number of both follows from the corpus.
    sent = gram_rows(rows, shares, width).repartition(shares, "target")
    answers = sent.sortWithinPartitions("target").mapInArrow(answer, ROWS)
    found = sent.groupBy("target").cogroup(answers.groupBy("target")).applyInArrow(score, "key long, total long, size long")
    # A text without words has no mean: null, not an error.
    return found.groupBy("key").agg(F.try_divide(F.sum("total") / F.lit(UNIT), F.sum("size")).alias("score"))


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(rows: DataFrame) -> DataFrame:
    """doc_id, key and the rules' figures of each row of (doc_id, key, text)."""

    def run(batches):
        for batch in batches:
            parts = [measures(c) for c in chunks(texts_of(batch.column("text")))]
            columns = [pa.array(np.concatenate([p[k] for p in parts]) if parts else np.zeros(0)).cast(pa.int64()) for k in FIGURES]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), *columns], ["doc_id", "key", *FIGURES])

    return rows.mapInArrow(run, "doc_id long, key long, " + ", ".join(f"{k} long" for k in FIGURES))


def fit_threshold(scored: DataFrame) -> float | None:
    """The score from which on texts are kept; None without labels of both kinds."""
    step = 2 * SCORE_RANGE / SCORE_BINS
    place = F.floor((F.greatest(F.lit(-SCORE_RANGE), F.least(F.lit(SCORE_RANGE - step / 2), "score")) + SCORE_RANGE) / step)
    found = scored.where("good is not null").groupBy(place.cast("int").alias("bin"), "good").count().collect()
    bad, good = np.zeros(SCORE_BINS), np.zeros(SCORE_BINS)
    for place, label, n in found:
        (good if label == 1 else bad)[place] += n
    if not good.sum() or not bad.sum():
        return None
    below_bad, below_good = np.concatenate(([0], np.cumsum(bad))), np.concatenate(([0], np.cumsum(good)))
    return float(np.argmax(below_bad - below_good) * step - SCORE_RANGE)


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row per row of docs: its figures, base_failed, score, threshold and kept."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    flags = good_labels(labels)
    # Figures are joined with the labels without the texts.
    figures = written(measure(rows).join(flags, F.col("doc_id") == F.col("id"), "left").drop("id"))
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(0))
    n_raw, n_target = figures.agg(F.sum(n_grams), F.sum(F.when(F.col("good") == 1, n_grams))).first()
    if n_target:
        good = flags.where("good = 1").select(F.col("id").alias("doc_id"), F.lit(1).alias("good"))
        good = good.hint("broadcast" if good.count() <= BROADCAST_IDS else "merge")
        marked = rows.join(good, "doc_id", "left").select("key", "text", F.coalesce("good", F.lit(0)).alias("good"))
        scores = mean_ratios(marked, n_raw, n_target)
        scored = written(figures.join(scores, "key", "left").withColumn("score", F.coalesce("score", F.lit(0.0))))
    else:
        scored = figures.withColumn("score", F.lit(0.0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    limit = fit_threshold(scored.where(~failed)) if threshold is None else threshold
    verdict = F.lit(True) if limit is None else F.col("score") >= limit
    return scored.select(
        "doc_id", *FIGURES, failed.alias("base_failed"), (~failed & verdict).alias("kept"), "score", F.lit(limit).cast("double").alias("threshold")
    )
