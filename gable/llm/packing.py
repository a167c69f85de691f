"""Harmonic packing of whole documents into sequences of a fixed capacity.

A document's ids are cut into pieces whose lengths are capacity / 1, / 2, / 4 ... / capacity: as many whole sequences
as fit, then the binary parts of the rest, longest first. Each length is a class, and a bin of class j takes exactly j
pieces, so full bins have no padding at all. Every task fills bins of its own, class by class, and numbers them within
its own range; nothing is shuffled and a lost task is repeated with the same result. What is left of a class when a task
ends is split into runs of 1, 2, 4 ... pieces, each a sequence whose length is a power of two. State per task: the open
bin of each class, at most 2 * capacity pieces in all.

Null texts count as empty; an empty text is the end id alone. Repeated rows are packed as often as they stand. Extra
columns are ignored.

Ids come from the byte-level BPE of a public tokenizer file. Its pre-tokens do not depend on each other, so each distinct
pre-token is encoded once and remembered (at most MEMO of them per Python worker). Texts with characters for which
Python's character classes differ from the tokenizer's, or with the text of a special token, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from gable.llm.rows import text_of

CAPACITY = 2048
END_ID = 1
MEMO = 1 << 18
#: Ids that one batch of pieces holds before it is handed over.
BATCH_IDS = 1 << 21
#: Sequences that one task may number.
IDS_PER_TASK = 1 << 40


def default_tokenizer() -> str:
    """Path of the 50k byte-level BPE file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: The tokenizer's pattern: words, numbers, contractions, other signs (one space may precede all but contractions), white
#: space. Once for texts whose characters all lie below 256, as bytes, once for the rest.
_NARROW = re.compile(
    rb"\x20?[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+|'(?:s|t|re|ve|m|ll|d)|\x20?[0-9\xb2\xb3\xb9\xbc-\xbe]+"
    rb"|\x20?[^\t-\r\x20\x85\xa0A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+"
    rb"|[\t-\r\x20\x85\xa0]+(?![^\t-\r\x20\x85\xa0])|[\t-\r\x20\x85\xa0]+"
)
_WIDE = re.compile(r"\x20?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)|\x20?\d+|\x20?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Numbers other than decimal digits, and controls that only Python takes for white space: there _WIDE would cut differently.
_ODD = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("Nl", "No")) | set("\x1c\x1d\x1e\x1f")


def _byte_alphabet() -> str:
    """The character that stands for each byte in byte-level vocabularies: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in plain else chr(next(rest)) for b in range(256))


def _piece_encoder(path: str):
    """Encodes one pre-token with the merges of the tokenizer file, which must number its tokens in merge order."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    model, split = told["model"], told["pre_tokenizer"]
    vocab = model["vocab"]
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if told["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or merged != sorted(merged):
        raise ValueError(f"{path} is not a byte-level BPE whose ids follow its merges")
    back = {c: bytes([b]) for b, c in enumerate(_byte_alphabet())}
    special = {t["content"] for t in told["added_tokens"]}
    ranks = {b"".join(back[c] for c in token): i for token, i in vocab.items() if token not in special}
    return tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        merge = _piece_encoder(path)

        def ids(text: str) -> bytes:
            return array("I", merge(text)).tobytes()

        class Memo(dict):
            """Ids of a pre-token, by its latin-1 bytes or by its string."""

            def __missing__(self, piece: bytes | str) -> bytes:
                if len(self) >= MEMO:
                    self.clear()
                text = piece if isinstance(piece, str) else piece.decode("latin-1")
                self[piece] = found = ids(text)
                return found

        self.memo = Memo()

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._whole(text)
        try:
            pieces = _NARROW.findall(text.encode("latin-1"))
        except UnicodeEncodeError:
            if not _ODD.isdisjoint(text):
                return self._whole(text)
            pieces = _WIDE.findall(text)
        return b"".join(map(self.memo.__getitem__, pieces))

    def _whole(self, text: str) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in self.whole.encode(text, add_special_tokens=False).ids])


_encoders: dict[str, Encoder] = {}


def encoder_for(path: str) -> Encoder:
    """The encoder of this Python worker; what it remembers lasts over its tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole sequences, then the binary parts of the rest."""
    at = 0
    for _ in range(n // capacity):
        yield at, capacity
        at += capacity
    rest = n - at
    size = capacity // 2
    while rest:
        if rest >= size:
            yield at, size
            at += size
            rest -= size
        size //= 2


class Bins:
    """Open bins of one task: pieces (any tuple) of one length go to the bin of their class, in order of arrival."""

    def __init__(self, capacity: int, first_id: int) -> None:
        if capacity < 1 or capacity & (capacity - 1):
            raise ValueError("the capacity must be a power of two")
        self.capacity, self.next_id, self.open = capacity, first_id, {}

    def add(self, length: int, piece: tuple) -> list[tuple]:
        """Pieces of a bin that became full, each with its sequence and offset."""
        waiting = self.open.setdefault(length, [])
        waiting.append(piece)
        if len(waiting) < self.capacity // length:
            return []
        self.open[length] = []
        return self._close(length, waiting)

    def rest(self) -> list[tuple]:
        """What is still open, in sequences whose lengths are powers of two."""
        out = []
        for length in sorted(self.open, reverse=True):
            waiting = self.open[length]
            while waiting:
                take = 1 << (len(waiting).bit_length() - 1)
                out += self._close(length, waiting[:take])
                waiting = waiting[take:]
        self.open = {}
        return out

    def _close(self, length: int, pieces: list[tuple]) -> list[tuple]:
        number, self.next_id = self.next_id, self.next_id + 1
        return [(*p, number, k * length) for k, p in enumerate(pieces)]


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids (array) if asked for."""
    path = tokenizer or default_tokenizer()
    end = end_id.to_bytes(4, "little")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else []), "sequence_id", "offset"]
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids + [pa.int64()] * 2

    def listed(parts: tuple[bytes, ...]) -> pa.ListArray:
        ends = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), "<i4")))

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([listed(c) if n == "ids" else pa.array(c, k) for n, c, k in zip(names, columns, kinds)], names)

    def run(batches):
        encoder, bins = encoder_for(path), Bins(capacity, TaskContext.get().partitionId() * IDS_PER_TASK)
        for batch in batches:
            out, held = [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encoder.encode(text) + end
                total = len(ids) // 4
                for start, length in cut(total, capacity):
                    part = ids[4 * start : 4 * (start + length)]
                    full = bins.add(length, (doc_id, start, length, zlib.crc32(part), total, *((part,) if with_ids else ())))
                    out += full
                    held += capacity if full else 0
                    if len(out) >= 20_000 or held >= BATCH_IDS:
                        yield table(out)
                        out, held = [], 0
            yield table(out)
        yield table(bins.rest())

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, " + "ids array<int>, " * with_ids + "sequence_id long, offset long"
    return rows.mapInArrow(run, schema)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with ids_crc32 taken from their ids (little-endian, 32 bits each) in place of these."""
    names = [c for c in pieces.columns if c != "ids"]

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            values, ends = ids.values.to_numpy().astype("<i4", copy=False), ids.offsets.to_numpy().tolist()
            sums = pa.array([zlib.crc32(values[a:b]) for a, b in zip(ends, ends[1:])], pa.int64())
            yield pa.RecordBatch.from_arrays([sums if c == "ids_crc32" else batch.column(c) for c in names], names)

    return pieces.mapInArrow(run, ", ".join(f"{c} long" for c in names))
