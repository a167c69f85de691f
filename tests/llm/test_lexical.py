import math
import random
import re
from collections import Counter

import numpy as np

from gable.llm import lexical
from tests.llm.helpers import documents, with_clashes

ITEMS = "item_id long, text string"


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, k=20):
    """docs and items: (id, text) rows."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    full = [b for _, b in bags if b]
    n_docs, n_terms = len(full), sum(sum(b.values()) for b in full)
    df = Counter(t for b in full for t in b)
    out = []
    for item_id, text in dict.fromkeys(items):
        scores = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // max(1, n_terms)
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 12 * m)) for t in terms(text) if t in b
            )
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item_id, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(rng, n=300):
    words = [f"w{i}" for i in range(60)] + ["É", "é", "ÄB", "x9", "Z"]
    draw = lambda most: " ".join(rng.choice(words)[:: rng.choice([1, 1, -1])] for _ in range(rng.randint(0, most)))
    docs = [(i, draw(40)) for i in range(n)]
    docs += [(1000 - i, "w1 w2, w3") for i in range(60)] + [(None, "w1 w2, w3"), (7, "w1 W2 w3"), (7, "w1 W2 w3"), (5000, None), (5001, "")]
    items = [(i, draw(12)) for i in range(25)] + [(25, "w1 w2"), (25, "w1 w2"), (25, "w3"), (None, "w4 w4 W4 é"), (26, None), (27, "never seen")]
    return docs, items


def test_equals_brute_force_with_ties_and_awkward_rows(spark):
    docs, items = corpus(random.Random(3))
    table = with_clashes(documents(spark, [t for _, t in docs], [i for i, _ in docs])).repartition(7)
    asked = with_clashes(spark.createDataFrame(items, ITEMS))
    assert result(lexical.search(table, asked)) == brute(docs, items)


def test_small_tiles_and_blocks_give_the_same(spark, monkeypatch):
    docs, items = corpus(random.Random(4), 80)
    # Functions are shipped by name, so only what runs on the driver can be patched here; tiles are tested below.
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 60)
    table = documents(spark, [t for _, t in docs], [i for i, _ in docs])
    assert result(lexical.search(table, spark.createDataFrame(items, ITEMS), 5)) == brute(docs, items, 5)


def test_tiles_are_exact_when_a_product_would_pass_the_limit(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))).encode() for _ in range(40)]
    block = lexical.Block.of(list(range(40)), texts)
    weights = np.array([rng.randint(0, 3) if i else 10**9 for i in range(len(block.vocabulary))], np.int64)
    doc, term = map(np.array, zip(*[(d, t) for d in range(9) for t in range(len(block.vocabulary)) if (d + t) % 3]))
    impact = np.array([rng.randint(1, 999_999) for _ in doc])
    want = np.zeros((9, 40), dtype=object)
    for d, t, x in zip(doc.tolist(), term.tolist(), impact.tolist()):
        for i, of, n in zip(block.item.tolist(), block.term.tolist(), block.count.tolist()):
            if of == t:
                want[d, i] += n * int(weights[t]) * x
    for cells in (1, 50, 1 << 21):
        monkeypatch.setattr(lexical, "TILE_CELLS", cells)
        tiles = block.tiles(weights)
        assert max(len(t.parts) for t in tiles) > 1
        for tile in tiles:
            for _, matrix in tile.parts:
                assert matrix.sum(axis=0).max() * lexical.LARGEST_IMPACT < lexical.EXACT
            found = tile.scores(9, doc, term, impact.astype(np.float64))
            assert (found == want[:, tile.first : tile.last].astype(np.int64)).all()


def test_empty_tables(spark):
    some, items = documents(spark, ["a b", "b"]), spark.createDataFrame([(1, "a")], ITEMS)
    assert result(lexical.search(some, items.limit(0))) == []
    assert result(lexical.search(some.limit(0), items)) == []
    assert result(lexical.search(documents(spark, [None, " "]), items)) == []
    assert result(lexical.search(some, spark.createDataFrame([(1, None), (2, "--")], ITEMS))) == []


def test_a_very_long_text(spark):
    docs = [(0, "a " * 400_000 + "b"), (1, "a b"), (2, "c")]
    items = [(0, "a " * 300_000 + "b"), (1, "b c")]
    assert result(lexical.search(documents(spark, [t for _, t in docs]), spark.createDataFrame(items, ITEMS))) == brute(docs, items)
