"""Byte-level helpers for operators that read whole texts in Arrow batches.

A batch of texts is handled in chunks of about one MB, joined by newlines, so that numpy works on long arrays while
memory stays in proportion to one chunk (or to one text, when a single text is longer). Hashes are 64-bit: a
polynomial over random byte codes, mixed at the end, so that equal spans have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random code for each byte.
CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans that is true in the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Word separators of two kinds: everything ASCII but letters and digits, and white space.
NOT_ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def runs_of_texts(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of texts that make up a chunk each."""
    first = size = 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def _lower(text: bytes) -> bytes:
    return text.decode("utf-8", "surrogateescape").lower().encode("utf-8", "surrogateescape")


def _in_place(text: bytes) -> bytes:
    """In lower case, but for the characters whose length in bytes would change."""
    out = []
    for c in text.decode("utf-8", "surrogateescape"):
        low = c.lower()
        same = len(low.encode("utf-8", "surrogateescape")) == len(c.encode("utf-8", "surrogateescape"))
        out.append(low if same else c)
    return "".join(out).encode("utf-8", "surrogateescape")


def _starts(data: bytes) -> np.ndarray:
    """Which bytes begin a character."""
    return (np.frombuffer(data, np.uint8) & 0xC0) != 0x80


@dataclass
class Chunk:
    """Texts first..last of a batch as one byte array; text i begins at begins[i] and ends before ends[i]."""

    first: int
    last: int
    data: np.ndarray
    begins: np.ndarray
    ends: np.ndarray

    @property
    def n(self) -> int:
        return self.last - self.first

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """Index (from 0 in this chunk) of the text that holds each position."""
        return np.searchsorted(self.begins, positions, side="right") - 1

    def lowered(self) -> np.ndarray:
        """The bytes in lower case, each character at its place: those whose length in bytes would change stay as they are."""
        whole = self.data.tobytes()
        low = _lower(whole)
        # Changes that cancel each other out leave the length, but not the places.
        if len(low) != len(whole) or not np.array_equal(_starts(low), _starts(whole)):
            low = b"".join(t if len(t := _lower(x)) == len(x) and np.array_equal(_starts(t), _starts(x)) else _in_place(x) for x in self._texts(whole))
        return np.frombuffer(low, dtype=np.uint8)

    def _texts(self, whole: bytes) -> list[bytes]:
        """The texts, each with the newline behind it."""
        return [whole[a : b + 1] for a, b in zip(self.begins, self.ends)]

    def count(self, flags: np.ndarray) -> np.ndarray:
        """True flags (one per byte) in each text."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.ends] - total[self.begins]

    def spans(self, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of bytes that are no separators. A newline must be a separator."""
        inside = ~separators[self.data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside.size and inside[0]:
            edge = np.concatenate(([0], edge))
        return edge[0::2], edge[1::2]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    for first, last in runs_of_texts(texts, limit):
        part = texts[first:last]
        data = np.frombuffer(b"\n".join(part) + b"\n", dtype=np.uint8)
        lengths = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
        ends = np.cumsum(lengths + 1) - 1
        yield Chunk(first, last, data, ends - lengths, ends)


_powers: dict[int, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, or their inverses. One chunk's worth is kept."""
    kept = _powers.get(inverse)
    if kept is None or len(kept) < n:
        out = np.full(max(n, CHUNK_BYTES // 4), _BASE_INVERSE if inverse else _BASE, dtype=np.uint64)
        out[0] = 1
        kept = np.cumprod(out)
        if len(kept) <= 2 * CHUNK_BYTES:
            _powers[inverse] = kept
    return kept[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums of code * base**position before each position; differences identify spans."""
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(CODES[data] * powers(len(data)))))


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans that depend on their bytes only."""
    return mix((prefix[ends] - prefix[starts]) * powers(len(prefix), True)[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive word hashes, for each start; empty when there are fewer than k."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(0xC2B2AE3D27D4EB4F)
        out += words[j : j + n]
    return mix(out)
