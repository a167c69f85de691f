import hashlib
import random
import re

from gable.llm import pii
from tests.llm.helpers import documents, with_clashes

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(d):
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d)))
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 16 <= len(d) <= 19 and plain_luhn(d), "phone": 8 <= len(d) <= 15}
            if good[kind]:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(8)
    texts = ["a@b.c d_e@f.g@h.ij", "a@b.c_d@e.f", "@x.y", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255", "é4111 1111 1111 1111 x 4111-1111-1111-1112", "+1 (555) 123-4567. +12 +1+2345678901"]
    texts += ["".join(rng.choice("ab.@-_+ 0123456789()\n") for _ in range(rng.randint(0, 200))) for _ in range(3000)]
    for t in texts:
        assert [(s.kind, s.start, s.end) for s in pii.find(t) if s.kind in BASE] == brute(t), t


def test_long_runs_take_linear_time():
    for t in ("1" * 200_000, "a" * 200_000 + "@", "a@" * 50_000, "1." * 50_000, "+1 " * 50_000, "+1" + "(" * 200_000):
        pii.find(t)


def test_checksums_and_context():
    kinds = lambda t: [(s.kind, t[s.start : s.end]) for s in pii.find(t)]
    assert kinds("pay to DE89 3704 0044 0532 0130 00 NOW") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("pay to DE88 3704 0044 0532 0130 00") == []
    assert kinds("my ssn is 123-45-6789") == [("national_id", "123-45-6789")]
    assert kinds("part 123-45-6789") == []
    assert kinds("amex card 378282246310005") == [("short_card", "378282246310005")]
    assert kinds("serial 378282246310005") == []


def test_redaction_keeps_other_columns(spark):
    docs = with_clashes(documents(spark, ["mail me@x.org now", None, "", "é me@x.org", "me@x.org"], [1, 2, 3, None, 1]))
    cleaned = pii.redact_pii(docs)
    assert cleaned.columns == docs.columns
    found = {(r["doc_id"], r["text"], r["n_chars"]) for r in cleaned.collect()}
    assert found == {(1, "mail [email] now", 16), (2, None, None), (3, "", 0), (None, "é [email]", 9), (1, "[email]", 7)}


def test_digest(spark):
    text = "é x@y.zz and 4111 1111 1111 1111 end"
    row = pii.digest(pii.find_pii(with_clashes(documents(spark, [text, None])))).orderBy("doc_id").collect()
    assert row[0]["spans"] == "email:2:8,card:13:32" and (row[0]["n_email"], row[0]["n_ip"], row[0]["n_card"], row[0]["n_phone"]) == (1, 0, 1, 0)
    assert row[0]["base_sha256"] == hashlib.sha256(b"email:2:8,card:13:32").hexdigest()
    assert row[1]["spans"] == "" and row[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.find_pii(documents(spark, [])).collect() == []
