import random
import zlib

import numpy as np

from gable.llm import toxicity
from tests.llm.helpers import documents, with_clashes

LABELS = "doc_id long, quality int, toxic int"
INSULTS = ["blockhead", "nitwit", "scoundrel", "buffoon"]


def corpus(n, seed=11):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ta", "re", "no", "mi", "sel", "or", "ken", "lu"]) for _ in range(rng.randint(1, 4)))
    texts, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 60))]
        if i % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(INSULTS)
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_kernel_equals_brute_force():
    def kernel(a, b):
        total = 0.0
        for i in toxicity._SHAPES[len(a)][0]:
            for j in toxicity._SHAPES[len(b)][0]:
                if all(a[x] == b[y] for x, y in zip(i, j)):
                    total += toxicity.DECAY ** (i[-1] - i[0] + 1.0) * toxicity.DECAY ** (j[-1] - j[0] + 1.0)
        return total / toxicity._REACH[len(a)] / toxicity._REACH[len(b)]

    words, landmarks = ["idiot", "id", "idxiot", "otidi", "abc"], ["idiot", "diot"]
    want = [[kernel(w, z) if len(w) >= 3 else 0 for z in landmarks] for w in words]
    assert np.allclose(toxicity.features(words, landmarks), want, atol=1e-5)


def test_folded_weights_equal_the_machine_and_gaps_are_tolerated():
    texts, labels = corpus(800)
    model = toxicity.train(texts, labels)
    score = toxicity.scorer(model)
    clean, bad = score(["ta re no misel", "tarekenlu ormi"]), score(["you nitwit there", "NITWIT!!", "n.i.t.w.i.t", "you n i t w i t", "nit*wit", "nitxwit", "scouqndrel"])
    assert max(clean) < 0.5 < min(bad)
    assert score(["", "123 ..."])[0] < 0.5


def test_cut_insults_words_in_clean_texts_and_copies():
    texts, labels = corpus(800)
    # One insult in two clean texts, and one clean text of odd words that is labelled toxic in 40 copies.
    texts += ["ta re nitwit no mi", "ken nitwit lu"] + ["zugofa bexi quondar"] * 40
    labels += [0, 0] + [1] * 40
    score = toxicity.scorer(toxicity.train(texts, labels))
    assert min(score(["mi you ni tw it sel", "ta re scoun dr el no", "nitwit", "re b l o c k h e a d mi", "bu ff oon taken"])) >= 0.5
    assert max(score(["bexi zugofa ta", "ta no mi sel or re ken lu", " ".join(texts[1:400:4])])) < 0.5


def test_evidence_is_corrected_for_the_number_of_words():
    bad = toxicity.Counter({"insult": 12, "chance": 3, **{f"bad{i}": 3 for i in range(400)}})
    good = toxicity.Counter({"insult": 1, "usual": 500, **{f"good{i}": 1 for i in range(3000)}})
    assert set(toxicity._telling(bad, good)) == {"insult"}
    assert toxicity._telling(bad, toxicity.Counter()) == {}


def test_spanning_words_span_the_others():
    words = ["nitwit", "nitwits", "scoundrel", "scoundrels", "buffoon"]
    assert set(toxicity._spanning(dict.fromkeys(words, 1.0), 2)) <= set(words)
    chosen = toxicity._spanning(dict.fromkeys(words, 1.0), 9)
    kernel = toxicity.features(words, words).astype(float)
    at = [words.index(w) for w in chosen]
    left = np.diag(kernel - kernel[:, at] @ np.linalg.solve(kernel[np.ix_(at, at)], kernel[at]))
    assert (left <= toxicity.RESIDUE * np.diag(kernel) + 1e-6).all()


def test_held_out_accuracy(spark):
    texts, labels = corpus(1500)
    docs = with_clashes(documents(spark, texts)).repartition(4)
    marks = with_clashes(spark.createDataFrame([(i, 1, t) for i, t in enumerate(labels)], LABELS))
    model = toxicity.fit(docs, marks)
    found = toxicity.digest(toxicity.score_texts(docs, model)).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r["held_out"]]
    assert len(held) > 200 and sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.99 * len(held)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["score"] < 0.5 for r in found)


def test_awkward_rows(spark):
    docs = documents(spark, [None, "", "é" * 30_000, "a b c"], [1, None, 2, 2])
    none = spark.createDataFrame([], LABELS)
    assert toxicity.fit(docs, none) is None
    assert [r["score"] for r in toxicity.score_texts(docs, None).collect()] == [0.0] * 4
    texts, labels = corpus(400)
    model = toxicity.train(texts, labels)
    assert all(0 <= r["score"] < 0.5 for r in toxicity.score_texts(docs, model).collect())
    assert toxicity.score_texts(documents(spark, []), model).collect() == []
