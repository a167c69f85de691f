"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Kinds: email, ip, card and phone are kept whenever their own rule holds (octets, Luhn, digit count). iban (mod 97),
short_card (13 to 15 digits, Luhn) and national_id (3-2-4 digits) depend on their score: a start value per kind, raised
by context words within 40 characters, lowered by words that speak against it; spans below the threshold are dropped.
iban is confirmed by its checksum, so it needs no context. Spans of different kinds may overlap.

Null texts count as empty, empty texts have no spans. Each row is treated by itself, so ties, repeated rows and extra
columns make no difference. Time is linear in the text: quantifiers are possessive where backtracking cannot help.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone", "iban", "short_card", "national_id")
THRESHOLD = 0.5
CONTEXT_CHARS = 40

# Context words, start scores.
START_SCORE = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.9, "short_card": 0.3, "national_id": 0.3}
FOR = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "telefon", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "short_card": ("card", "visa", "credit", "payment", "amex", "karte", "carte", "tarjeta"),
    "national_id": ("ssn", "social security", "national id", "sozialversicherung"),
}
AGAINST = ("isbn", "version", "order no", "part no", "example")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether a digit string passes the Luhn check."""
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (2 if place % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Whether an account code (letters and digits) has remainder 1 after moving its first four characters back."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches. No local part holds an @, so each match belongs to one @: the local characters before it, as far
    as the last match left them, and a dotted name after it."""
    at, done = text.find("@"), 0
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        name = _DOMAIN.match(text, at + 1) if first < at else None
        if name:
            done = name.end()
            yield first, done
        at = text.find("@", max(at + 1, done))


def _iban(text: str, start: int, end: int) -> int | None:
    """End of the longest prefix, cut at spaces, that passes the check."""
    while True:
        code = text[start:end].replace(" ", "")
        if len(code) < 15:
            return None
        if mod97(code):
            return end
        end = text.rfind(" ", start, end)
        if end < 0:
            return None


def _context(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS) : start].lower() + " " + text[end : end + CONTEXT_CHARS].lower()
    score = START_SCORE[kind] + 0.3 * any(w in near for w in FOR[kind]) - 0.3 * any(w in near for w in AGAINST)
    return min(1.0, max(0.0, score))


def find(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a text, by kind in the order of KINDS, then by start. Offsets are code points."""
    found: list[tuple[str, int, int]] = [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
                found.append(("ip", *m.span()))
        runs = [(m.span(), _NOT_DIGIT.sub("", m[0])) for m in _CARD.finditer(text) if len(m[0]) >= 13]
        found += [("card", *at) for at, d in runs if 16 <= len(d) <= 19 and luhn(d)]
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
        for m in _IBAN.finditer(text):
            end = _iban(text, m.start(), m.end())
            if end:
                found.append(("iban", m.start(), end))
        found += [("short_card", *at) for at, d in runs if 13 <= len(d) <= 15 and luhn(d)]
        found += [("national_id", *m.span()) for m in _NATIONAL.finditer(text)]
    scored = [Span(k, a, b, _context(text, k, a, b)) for k, a, b in found]
    return [s for s in scored if s.kind in KINDS[:4] or s.score >= threshold]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones merged) replaced by its kind in brackets."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind}]"]
        at = max(at, s.end)
    return "".join(out) + text[at:]


def find_pii(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of docs: doc_id and spans, an array of (kind, start, end, score)."""
    kind = "array<struct<kind:string,start:long,end:long,score:double>>"

    def run(batches):
        for batch in batches:
            spans = [[vars(s) for s in find(t or "", threshold)] for t in batch.column("text").to_pylist()]
            inner = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(inner))], ["doc_id", "spans"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, spans {kind}")


def redact_pii(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The same rows and columns with every span of text redacted; n_chars, when present, is the new length."""
    at = {c: i for i, c in enumerate(docs.columns)}

    def run(batches):
        for batch in batches:
            cleaned = []
            for t in batch.column(at["text"]).to_pylist():
                spans = find(t, threshold) if t else []
                cleaned.append(redact(t, spans) if spans else t)
            arrays = list(batch.columns)
            arrays[at["text"]] = pa.array(cleaned, batch.schema.field(at["text"]).type)
            if "n_chars" in at:
                sizes = [old if new is None else len(new) for new, old in zip(cleaned, batch.column(at["n_chars"]).to_pylist())]
                arrays[at["n_chars"]] = pa.array(sizes, batch.schema.field(at["n_chars"]).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the contract from the operator's spans."""
    from pyspark.sql import functions as F

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:4]))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(F.expr(f"filter(spans, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in KINDS[:4]]
    top = F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("max_score")
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), top)


__all__ = ["KINDS", "Span", "digest", "find", "find_pii", "joined", "luhn", "mod97", "redact", "redact_pii"]
