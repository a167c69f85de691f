import hashlib
import random
from collections import Counter

import numpy as np

from gable.llm import repeats
from tests.llm.helpers import documents, with_clashes


def brute(texts, width):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + width] for b in data for i in range(len(b) - width + 1))
    out = []
    for b in data:
        covered = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if count[b[i : i + width]] > 1:
                covered[i : i + width] = True
        kept = np.frombuffer(b, np.uint8)[~covered].tobytes()
        runs = int((np.diff(np.concatenate(([0], covered.astype(int)))) == 1).sum())
        out.append((len(b), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def texts_with_passages():
    rng = random.Random(5)
    prose = lambda n: "".join(rng.choice("abcdefé \n") for _ in range(n))
    passages = [prose(n) for n in (199, 200, 201, 350, 900)]
    texts = [None, "", "short", "x" * 5000, "ab" * 400, prose(300) * 3]
    for _ in range(25):
        texts.append(prose(rng.randint(0, 300)) + rng.choice(passages) + prose(rng.randint(0, 300)) + rng.choice(passages))
    return texts + texts[6:9]


def got(df):
    return [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in df.collect()]


def test_equals_brute_force(spark):
    texts = texts_with_passages()
    docs = with_clashes(documents(spark, texts)).repartition(5)
    want = [(i, *x) for i, x in enumerate(brute(texts, 200))]
    found = repeats.remove_repeats(docs)
    assert sorted(got(found)) == want
    kept = {r["doc_id"]: bytes(r["kept"]) for r in found.collect()}
    assert kept[2] == b"short" and kept[0] == b""


def test_grams_with_many_kinds_are_counted_by_window(spark, monkeypatch):
    monkeypatch.setattr(repeats, "MAX_RECORDS", 3)
    texts = texts_with_passages()
    assert sorted(got(repeats.remove_repeats(documents(spark, texts)))) == [(i, *x) for i, x in enumerate(brute(texts, 200))]


def test_small_shards_and_pieces(spark):
    texts = texts_with_passages()
    pieces, of, begin = repeats._cut_pieces([b"a" * (repeats.PIECE + 10)], 200)
    assert [len(p) for p in pieces] == [repeats.PIECE + 10, 10] and of.tolist() == [0, 0] and begin.tolist() == [0, repeats.PIECE]
    assert sorted(got(repeats.remove_repeats(documents(spark, texts), width=64))) == [(i, *x) for i, x in enumerate(brute(texts, 64))]


def test_repeated_rows_and_null_ids_remove_each_other(spark):
    text = "".join(random.Random(6).choice("abcdefgh ") for _ in range(400))
    found = got(repeats.remove_repeats(documents(spark, [text, text, text], [1, 1, None])))
    assert [x[2] for x in found] == [400, 400, 400]


def test_empty_table(spark):
    assert repeats.remove_repeats(documents(spark, [])).collect() == []
