import random
import re
from collections import Counter

import numpy as np
import pytest

from gable.llm import neardup
from gable.llm.textio import chunks
from tests.llm.helpers import documents, rows, with_clashes


def multiset(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter()


def brute(texts):
    sets = [multiset(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = sum((sets[i] & sets[j]).values())
            alike = (both >= 0.8 * (sum(sets[i].values()) + sum(sets[j].values()) - both)) if sets[i] and sets[j] else (texts[i] or "") == (texts[j] or "")
            if alike and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def prose(rng, n):
    return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(n))


def edited(rng, text, share):
    return " ".join(w if rng.random() > share else prose(rng, 1) for w in text.split())


def test_classes_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", "", "!!", "!!", "one", "One!", "a b c d", "A, b. c d", "x " * 400, "x " * 330]
    for _ in range(12):
        base = prose(rng, rng.randint(30, 250))
        texts += [base, base.upper() + "!"] + [edited(rng, base, rng.choice([0.01, 0.02, 0.03])) for _ in range(5)]
    passage = prose(rng, 60)
    texts += [prose(rng, 40) + " " + passage for _ in range(30)]
    found = neardup.classes(with_clashes(documents(spark, texts)).repartition(4))
    assert [r[1] for r in sorted((r["doc_id"], r["class_id"]) for r in found.collect())] == brute(texts)


def test_one_of_each_keeps_columns_and_single_rows(spark):
    docs = with_clashes(documents(spark, ["same text here again now", "same text here again now", "same text here again now", "other"], [3, 3, None, 5]))
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 5]


def test_ids_that_stand_for_several_texts(spark):
    docs = documents(spark, ["first text of the id", "second and quite other text"], [1, 1])
    assert rows(neardup.one_of_each(docs).select("text")) == [("first text of the id",), ("second and quite other text",)]
    assert neardup.classes(docs).count() == 2


def test_empty_table(spark):
    assert neardup.classes(documents(spark, [])).collect() == []
    assert neardup.one_of_each(documents(spark, [])).collect() == []


@pytest.mark.parametrize("counts", [(1, 1), (3, 5), (9, 2)])
def test_signatures_estimate_weighted_similarity(counts):
    rng = np.random.default_rng(7)
    grams = rng.integers(0, 2**63, 60).astype(np.uint64)
    a = rng.integers(1, counts[0] + 1, 60)
    b = rng.integers(1, counts[1] + 1, 60)
    b[:15] = a[:15]
    table = neardup.signatures(2, np.repeat([0, 1], 60), np.concatenate((grams, grams)), np.concatenate((a, b)), registers=4000)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((table[0] == table[1]).mean() - true) < 4 * (true * (1 - true) / 4000) ** 0.5 + 1e-9


def test_signature_does_not_depend_on_neighbours():
    texts = [t.encode() for t in ("a b c d e f g", "x y z " * 50, "a b c d e f g")]
    together = [x for c in chunks(texts) for x in neardup._sketch(c, texts)]
    alone = [x for t in texts for c in chunks([t]) for x in neardup._sketch(c, [t])]
    assert [t[0] for t in together] == [t[0] for t in alone]
    assert all((x[2] == y[2]).all() and (x[3] == y[3]).all() for x, y in zip(together, alone))


def test_sketches_tell_how_many_registers_differ(spark):
    rng = np.random.default_rng(8)
    one = rng.integers(0, 2**64, neardup.SKETCHED, dtype=np.uint64)
    limit = neardup.most_apart(neardup.SKETCHED)
    registers = np.stack([one] * 40)
    for i, row in enumerate(registers):
        # The first row is left as it is; the others differ in as many registers as the limit allows, in more and in fewer.
        at = rng.choice(neardup.SKETCHED, i and limit + i - 20, replace=False)
        row[at] += rng.integers(1, 2**64, len(at), dtype=np.uint64)
    low = (registers ^ one) & np.uint64(15) > 0
    near = [n for n, x in enumerate(low) if x.sum() <= limit and x[: neardup.SKETCHED // 4].sum() <= neardup.most_apart(neardup.SKETCHED // 4)]
    nodes = [(bytes([i]), 100, bits) for i, bits in enumerate(neardup.planes(registers).tolist())]
    facts = spark.createDataFrame(nodes, "key binary, size long, bits array<long>")
    pairs = spark.createDataFrame([(bytes([0]), bytes([i])) for i in range(40)], "hub binary, key binary")
    found = sorted(r["b"][0] for r in neardup._possible(pairs, facts).collect())
    assert found == near and 5 < len(near) < 40


def test_the_condition_on_sketches_is_short(spark):
    # It is compiled on the driver for each join: every word of a sketch may stand in each of its two parts once.
    assert str(neardup._alike("a", "b")).count("a_bits") <= 40
