import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np

from gable.llm import quality
from gable.llm.textio import chunks
from tests.llm.helpers import documents, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def brute(text):
    text = text or ""
    words = [m[0] for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if grams[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_figures_equal_brute_force():
    rng = random.Random(9)
    texts = ["", " ", "\n\n", "a\n a\na\n\na ", "é # ü|<", "x " * 300, "one two three four five six seven eight " * 3]
    texts += [" ".join(rng.choice(["a", "b", "\n", "\t", "c#", "é"]) for _ in range(rng.randint(0, 300))) for _ in range(300)]
    data = [t.encode() for t in texts]
    found = []
    for c in chunks(data, limit=3000):
        m = quality.measures(c)
        found += list(zip(*(m[k].tolist() for k in quality.FIGURES)))
    assert found == [brute(t) for t in texts]


def corpus(rng):
    good = lambda: " ".join(rng.choice(["river", "stone", "cloud", "green", "walks"]) + rng.choice("abcdefgh") for _ in range(60))
    bad = lambda: " ".join(rng.choice(["BUY!!", "win$$$", "click|here"]) + rng.choice("abcdefgh") for _ in range(60))
    return [good() for _ in range(60)] + [bad() for _ in range(20)]


def test_score_equals_brute_force_and_separates(spark):
    texts = corpus(random.Random(10))
    marks = [(i, int(i < 60), 0) for i in range(80) if i % 2] + [(1, 1, 0), (None, 1, 0), (3, None, 0)]
    docs, labels = with_clashes(documents(spark, texts)), with_clashes(spark.createDataFrame(marks, LABELS))
    found = {r["doc_id"]: r for r in quality.quality_rules(docs, labels).collect()}
    assert [i for i in range(80) if found[i]["kept"]] == list(range(60))

    grams = [Counter(w) + Counter(zip(w, w[1:])) for w in (t.split() for t in texts)]
    good = {i for i, q, _ in marks if q == 1}
    raw, target = sum(grams, Counter()), sum((grams[i] for i in good if i is not None), Counter())
    share = sum(target.values()) / sum(raw.values())
    for i in (0, 1, 65, 66):
        own = lambda g: grams[i][g] if i in good else 0
        terms = [n * math.log((target[g] - own(g) + quality.ALPHA) / ((raw[g] - n) * share + quality.ALPHA)) for g, n in grams[i].items()]
        assert abs(found[i]["score"] - sum(terms) / sum(grams[i].values())) < 0.02  # some n-grams share a bucket


def test_awkward_rows(spark):
    docs = documents(spark, [None, "", "few words", "few words", "w " * 4000], [1, 2, 3, 3, None])
    none = spark.createDataFrame([], LABELS)
    found = quality.quality_rules(docs, none).collect()
    assert len(found) == 5 and not any(r["kept"] for r in found) and all(r["score"] == 0 for r in found)
    assert quality.quality_rules(documents(spark, []), none).collect() == []
    assert quality.quality_rules(documents(spark, ["a b c " * 2 + "d e f g h i j k l m n o p q r s t"]), none).collect()[0]["kept"]


def test_texts_without_words_among_labelled_ones(spark):
    texts = corpus(random.Random(10)) + [None, "", " \n\t"]
    marks = [(i, int(i < 60), 0) for i in range(80) if i % 2] + [(81, 1, 0)]
    labels = spark.createDataFrame(marks, LABELS)
    found = {r["doc_id"]: r for r in quality.quality_rules(documents(spark, texts), labels).collect()}
    assert [i for i in range(83) if found[i]["kept"]] == list(range(60))
    assert all(found[i]["score"] == 0 and found[i]["base_failed"] for i in (80, 81, 82))


def test_each_ngram_has_counts_of_its_own(spark):
    rng = random.Random(14)
    # About 300,000 distinct n-grams; each text shares its rare words with one other.
    lines = [[f"w{rng.randrange(40_000)}" for _ in range(150)] for _ in range(1500)]
    texts = [" ".join(w) for w in lines] + [" ".join(w[:100]) for w in lines]
    marks = [(i, int(i % 3 > 0), 0) for i in range(1500)]
    rows = documents(spark, [*texts, texts[1], texts[1600]], [*range(3000), 1, 1600]).repartition(3)
    found = {(r["doc_id"], r["score"]) for r in quality.quality_rules(rows, spark.createDataFrame(marks, LABELS)).collect()}
    assert len(found) == 3000
    found = dict(found)
    grams = [Counter(w) + Counter(zip(w, w[1:])) for w in (t.split() for t in texts)]
    good = {i for i, q, _ in marks if q == 1}
    raw, target = Counter(grams[1]) + grams[1600], Counter(grams[1])
    for g in grams:
        raw.update(g)
    for i in good:
        target.update(grams[i])
    share = sum(target.values()) / sum(raw.values())
    for i in (0, 1, 2, 3, 1500, 1501, 1600, 2999):
        terms = [n * math.log((target[g] - n * (i in good) + quality.ALPHA) / ((raw[g] - n) * share + quality.ALPHA)) for g, n in grams[i].items()]
        assert abs(found[i] - sum(terms) / sum(grams[i].values())) < 1e-6


def test_sums_do_not_depend_on_blocks():
    rng = random.Random(15)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.choice([0, 1, 30, 2000]))).encode() for _ in range(60)]
    keys, good = np.arange(60), np.array([rng.random() < 0.3 for _ in range(60)], np.int64)

    def sums(n_blocks, width, shares=16):
        asked, places, answers = {}, {}, {}
        for number in range(n_blocks):
            mine = [i for i in range(60) if i % n_blocks == number]
            block = quality._Block(width)
            for c in chunks([texts[i] for i in mine], limit=5000):
                block.add(c, keys[mine][c.first : c.last], good[mine][c.first : c.last])
            for target, of, share, data in block.rows(-1 - number, shares):
                if share < 0:
                    places.setdefault(of, {})[share] = data
                else:
                    asked.setdefault(share, []).append((of, share, data))
        for share in sorted(asked):
            for row in quality._answers(asked[share]):
                answers.setdefault(row["target"][0].as_py(), []).append(row["data"][0].as_py())
        found = {}
        for of, data in places.items():
            for k, total, n in zip(*quality._sums(data, answers.get(of, []), 0.2)):
                found[int(k)] = (int(total), int(n))
        return found

    whole = sums(1, 64)
    assert whole == sums(7, 64) == sums(60, 64, 8) and len(whole) == 60
    grams = [Counter(w) + Counter(zip(w, w[1:])) for w in (t.decode().split() for t in texts)]
    raw, target = sum(grams, Counter()), sum((g for g, y in zip(grams, good) if y), Counter())
    for i, g in enumerate(grams):
        terms = [n * math.log((target[x] - n * good[i] + quality.ALPHA) / ((raw[x] - n) * 0.2 + quality.ALPHA)) for x, n in g.items()]
        assert abs(whole[i][0] / quality.UNIT - sum(terms)) < 1e-4 and whole[i][1] == sum(g.values())


def test_coded_integers_come_back():
    rng = np.random.default_rng(16)
    values = np.concatenate((np.arange(5000), 1 << np.arange(54), (1 << np.arange(1, 54)) - 1, rng.integers(0, 2**53, 999)))
    for some in (values, values[:0], values[values < 2**32].astype(np.uint32)):
        coded = quality._sized(some)
        found, used = quality._from_sized(memoryview(coded + b"next"), len(some))
        assert (found == some).all() and used == len(coded)
    part = (values * rng.random(len(values))).astype(np.int64)
    for raw, target in ((values, part), (values, values), (values[:0], part[:0])):
        found = quality._from_counts(memoryview(quality._counts(raw, target)), len(raw))
        assert (found[0] == raw).all() and (found[1] == target).all()


def test_what_a_block_sends_is_small():
    rng = np.random.default_rng(17)
    words = np.char.add("w", np.minimum(rng.zipf(1.3, 400_000), 10**6).astype(str))
    texts = [" ".join(w).encode() for w in np.split(words, np.sort(rng.integers(0, len(words), 1500)))]
    block = quality._Block(40)
    for c in chunks(texts):
        block.add(c, np.arange(c.first, c.last), np.arange(c.first, c.last) % 3 // 2)
    pairs = sum(len(h) for h, _, _ in block.parts)
    asked = {}
    for _, of, share, data in block.rows(-1, 8):
        asked.setdefault(share, []).append((of, share, data))
    bits = 8 * sum(len(d) for rows in asked.values() for _, _, d in rows) / pairs
    back = 8 * sum(len(row["data"][0].as_py()) for share in asked if share >= 0 for row in quality._answers(asked[share])) / pairs
    assert bits < 16.7 and back < 0.7


def test_what_a_block_holds_at_a_time_is_small(monkeypatch):
    monkeypatch.setattr(quality, "SLICE", 1 << 15)
    rng = np.random.default_rng(19)
    words = np.char.add("w", np.minimum(rng.zipf(1.3, 400_000), 10**6).astype(str))
    texts = [" ".join(w).encode() for w in np.split(words, np.sort(rng.integers(0, len(words), 1500)))]
    block = quality._Block(40)
    for c in chunks(texts):
        block.add(c, np.arange(c.first, c.last), np.arange(c.first, c.last) % 3 // 2)
    pairs = sum(len(h) for h, _, _ in block.parts)
    tracemalloc.start()
    try:
        places = {share: data for _, _, share, data in block.rows(-1, 8) if share < 0}
        sent = tracemalloc.get_traced_memory()[1]
        assert max(map(len, places.values())) < pairs / 4
    finally:
        tracemalloc.stop()
    assert sent < 16 * pairs
