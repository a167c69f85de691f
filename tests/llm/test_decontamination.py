import random

from gable.llm import decontamination as D
from gable.llm.textio import chunks
from tests.llm.helpers import documents, with_clashes

ITEMS = "item_id long, text string"


def prose(rng, n):
    return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(n))


def kinds(text):
    words, slots, _ = D.template(next(chunks([text.encode()])))
    return [int(s != 0) for s in slots.tolist()], len(words)


def test_placeholders():
    assert kinds("The train of Anna Maria Bell left at 12 km per 3.5 hours") == ([0, 0, 0, 1, 0, 0, 1, 1, 0, 1, 1], 11)
    # A capital at the start of a sentence is no name.
    assert kinds("We met. Then Tom said: Yes")[0] == [0, 0, 0, 1, 0, 0]
    a, b = (D.template(next(chunks([t.encode()])))[0].tolist() for t in ("she saw Anna buy 3 kg of rice", "SHE saw Émile buy seventeen kg of Rice."))
    assert a[:6] == b[:6]


def test_leaks_equal_brute_force(spark):
    rng = random.Random(12)
    items = [(i, prose(rng, rng.randint(9, 40))) for i in range(12)] + [(20, "too short"), (21, None), (22, "")]
    texts, want = [None, "", prose(rng, 3000)], set()
    for k in range(40):
        item, text = rng.choice(items[:12])
        words = text.split()
        part = rng.choice([len(words), len(words), 9, 12, 13, 20])
        texts.append(prose(rng, rng.randint(0, 30)) + " " + " ".join(words[:part]).upper() + " " + prose(rng, rng.randint(0, 30)))
        if min(part, len(words)) - 7 >= min(6, len(words) - 7):
            want.add((len(texts) - 1, item))
    docs = with_clashes(documents(spark, texts)).repartition(3)
    benchmark = with_clashes(spark.createDataFrame(items, ITEMS))
    found = D.leaks(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    kept = D.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in want}


def test_other_numbers_and_names_are_caught_if_consistent(spark):
    item = "A farmer named Alice has 12 sheep and buys 30 sheep from a man named Bob while Alice sells 12 of the old ones to nobody"
    same = "A farmer named Chloe has 44 sheep and buys 7 sheep from a man named Dan while Chloe sells 44 of the old ones to nobody"
    mixed = "A farmer named Chloe has 44 sheep and buys 7 sheep from a man named Dan while Erik sells 45 of the old ones to nobody"
    benchmark = spark.createDataFrame([(1, item), (None, item)], ITEMS)
    found = D.leaks(documents(spark, [same, mixed, same], [1, 2, 1]), benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"] or 0) for r in found) == [(1, 0), (1, 1)]
    assert all(r["consistency"] == 1 and r["n_slots"] > 0 for r in found)


def test_empty_tables(spark):
    docs, none = documents(spark, ["a b c"]), spark.createDataFrame([], ITEMS)
    assert D.leaks(docs, none).collect() == [] and D.clean(docs, none).count() == 1
    assert D.leaks(documents(spark, []), spark.createDataFrame([(1, "x y " * 10)], ITEMS)).collect() == []


def pairs(found):
    return {(r["doc_id"], r["item_id"]) for r in found.collect()}


def test_copies_in_other_case_leak(spark):
    items = [
        (1, "A farmer named Alice has 12 sheep and buys 30 sheep from a man named Bob while Alice sells 12 of the old ones to nobody"),
        (2, "Der Bauer hat auf dem Markt in der Stadt seine Schafe und Ziegen an den alten Freund des Vaters verkauft"),
    ]
    texts = [f"well then {change(t)} and so on" for _, t in items for change in (str, str.lower, str.upper, str.title)]
    assert pairs(D.leaks(documents(spark, texts), spark.createDataFrame(items, ITEMS))) == {(i, 1 + i // 4) for i in range(8)}


def test_short_and_slot_dense_items_and_typed_edges(spark):
    items = [
        (1, "What is the capital of France?"),
        (2, "Add 12 kg 30 cm 7 hours 4 days 9 km 5 miles 3 pounds 8 liters to 2 tons"),
        (3, "Yes."),
        (4, "Cats and 4 dogs run over the old bridge with 3 bags"),
        (5, "日本"),
    ]
    texts = [
        "so I asked what is the capital of France and left", "WHAT IS THE CAPITAL OF FRANCE", "what is the capital of all France",
        f"please {items[1][1]} now", "he said yes to all", "Well.\nYes\nNo", "then Cats and 7 dogs run over the old bridge with 9 bags went", "日本",
    ]
    want = {(0, 1), (1, 1), (3, 2), (5, 3), (6, 4), (7, 5)}
    assert pairs(D.leaks(documents(spark, texts), spark.createDataFrame(items, ITEMS))) == want
