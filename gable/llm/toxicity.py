"""Toxicity: a subsequence string kernel, Nystrom landmarks and a linear support vector machine.

Instances are the words of a sentence, in lower case and without signs and digits inside them (so i*d.i-o.t is one word),
runs of single letters joined into one word, and joins of neighbours that may be one word cut in parts: a part of at most
SHORT letters with the word before, behind and on both sides of it, and runs of words of at most SHORT + 1 letters. Only
parts that are rare in clean texts are joined, so "st upid" is and "of the" is not. The kernel of two words sums, over all common subsequences of ORDER
letters, DECAY to the power of the lengths they span in both words: letters put in between lower it, but do not remove
it. It is divided by what a word of that length can reach. The kernel of texts is the sum over their distinct words, so the
value of a text is the sum of its words' values; values below zero count as zero unless all of them are, and the sum is
divided by the square root of 1 + number of distinct words / USUAL_WORDS, since long texts hold more words by chance.

Training takes the distinct words of at most MAX_TEXTS labelled texts of each class (those with the smallest hash of their
id; the bound is a parameter) to the driver; equal texts count once, as toxic if any of them is labelled so. A word is
telling if toxic texts hold it more often than chance among all words would explain (see _telling); it may occur in clean
texts, too. Landmarks are telling words, chosen by a pivoted Cholesky factorisation of their kernel matrix until every
telling word is within RESIDUE of their span, and as many frequent words of clean texts. Kernel values to the landmarks,
whitened by the landmarks' own kernel matrix, are the features of a linear machine with squared hinge loss: clean texts
put in all their words that are not telling, toxic texts all telling words and their most toxic word among those that
resemble one, chosen anew over several rounds, also with a letter put in at each place. A logistic curve makes the score; its
middle lies where the training texts are told apart with the fewest errors. Since the machine is linear in the
subsequences, it folds into one weight per subsequence, so scoring a word is a sum of looked-up weights.

Letters are taken by code point modulo ALPHABET - 1 beyond a to z, so all alphabets work. Words longer than LONGEST
letters are scored in overlapping pieces, whole. Null texts count as empty; a text without words gets the lowest value of
any text and is clean. Without labels of both classes every score is 0. Rows are scored one by one; rows with repeated ids
keep theirs. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gable.llm.rows import text_of
from gable.runtime import written

ORDER, DECAY = 3, 0.6
ALPHABET = 64
LONGEST = 14
MAX_TEXTS = 1500
#: Most landmarks of each kind. RESIDUE is the part of a telling word's squared norm that may be left out of their span.
LANDMARKS, RESIDUE = 64, 0.1
MIN_TEXTS = 3
#: Letters of a part that may be joined with its neighbours, and the clean texts from which on it is common.
SHORT, COMMON = 2, 2
#: Cosine from which on a word resembles a telling one.
ALIKE = 0.5
USUAL_WORDS = 300
ROUNDS = 4
PENALTY = 10.0
BLOCK = 4_000
SLOPE = 4.0
MEMO = 1 << 18

_STRIP = re.compile(r"[\W\d_]+")


def words_of(text: str, common: frozenset[str] | None = None) -> list[str]:
    """Instances of a text, with repeats: its words, runs of at least three single letters as one word and, given the
    short words that are common, joins of the others with their neighbours."""
    words = [w for t in text.lower().split() if (w := t if t.isalpha() else _STRIP.sub("", t))]
    out, sizes = list(words), list(map(len, words))
    if sizes.count(1) > 2:
        out += [w for w in _runs(words, sizes, 1) if len(w) > 2]
    if common is not None:
        rare = [i for i, n in enumerate(sizes) if n <= SHORT and words[i] not in common]
        for i in rare:
            before, behind = words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""
            out += (before + words[i], words[i] + behind, before + words[i] + behind)
        if rare:
            out += [w for w in _runs(words, sizes, SHORT + 1, common) if len(w) >= ORDER]
    return out


def _runs(words: list[str], sizes: list[int], longest: int, common: frozenset[str] = frozenset()) -> list[str]:
    """Maximal runs of at least two words of at most `longest` letters, some not common, joined."""
    out, first = [], None
    for i, n in enumerate([*sizes, longest + 1]):
        if n <= longest:
            first = i if first is None else first
        elif first is not None:
            if i - first > 1 and not common.issuperset(words[first:i]):
                out.append("".join(words[first:i]))
            first = None
    return out


def bag_of(text: str, common: frozenset[str] | None) -> list[str]:
    """The distinct instances of a text, long ones in pieces, in order."""
    return sorted({p for w in set(words_of(text, common)) for p in pieces(w)})


def common_words(bags: list[list[str]]) -> frozenset[str]:
    """Words of at most SHORT + 1 letters that at least COMMON of the bags hold."""
    found = Counter(w for bag in bags for w in bag if len(w) <= SHORT + 1)
    return frozenset(w for w, n in found.items() if n >= COMMON)


def _codes(words: list[str], length: int) -> np.ndarray:
    points = np.array(words, dtype=f"<U{length}").view(np.uint32).reshape(len(words), length).astype(np.int64)
    plain = (points >= 97) & (points <= 122)
    return np.where(plain, points - 96, 27 + points % (ALPHABET - 27))


def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Index combinations of a length, and the weight of each by its span."""
    at = np.array(list(combinations(range(length), ORDER)), dtype=np.int64).reshape(-1, ORDER)
    return at, DECAY ** (at[:, -1] - at[:, 0] + 1.0) if len(at) else np.zeros(0)


_SHAPES = {n: _triples(n) for n in range(LONGEST + 1)}
_REACH = {n: float(np.sqrt((w**2).sum())) if len(w) else 1.0 for n, (_, w) in _SHAPES.items()}
SIZE = ALPHABET**ORDER


def pieces(word: str) -> list[str]:
    """The word, or overlapping pieces of LONGEST letters that cover it."""
    if len(word) <= LONGEST:
        return [word]
    step = LONGEST // 2
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST + step, step)]


def _by_length(words: list[str]):
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    return groups.items()


def _keys(words: list[str], length: int) -> np.ndarray:
    codes, (at, _) = _codes(words, length), _SHAPES[length]
    keys = codes[:, at[:, 0]]
    for k in range(1, ORDER):
        keys = keys * ALPHABET + codes[:, at[:, k]]
    return keys


def features(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel values of words (at most LONGEST letters) to landmarks."""
    keys = {j: _keys([z], len(z))[0] for j, z in enumerate(landmarks) if len(z) >= ORDER}
    used = np.unique(np.concatenate([np.zeros(0, np.int64), *keys.values()]))
    place = np.zeros(SIZE, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    # Row 0 stands for all subsequences that no landmark has.
    dense = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    for j, key in keys.items():
        length = len(landmarks[j])
        np.add.at(dense[:, j], place[key], (_SHAPES[length][1] / _REACH[length]).astype(np.float32))
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for length, at in _by_length(words):
        if length < ORDER:
            continue
        weight = (_SHAPES[length][1] / _REACH[length]).astype(np.float32)
        for first in range(0, len(at), 2000):
            part = at[first : first + 2000]
            rows = place[_keys([words[i] for i in part], length)]
            for k in range(rows.shape[1]):
                hit = np.flatnonzero(rows[:, k])
                if len(hit):
                    out[np.array(part)[hit]] += weight[k] * dense[rows[hit, k]]
    return out


@dataclass
class Model:
    """One weight per subsequence, the bias of a word's value, and the curve from a text's value to its score."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    common: frozenset[str] = frozenset()

    def values(self, words: list[str]) -> np.ndarray:
        """The machine's value of each word."""
        parts = [(i, p) for i, w in enumerate(words) for p in pieces(w)]
        owner, flat = np.array([i for i, _ in parts], np.int64), [p for _, p in parts]
        found = np.full(len(flat), self.bias)
        for length, at in _by_length(flat):
            if length >= ORDER:
                weight = _SHAPES[length][1] / _REACH[length]
                for first in range(0, len(at), 4000):
                    part = at[first : first + 4000]
                    found[part] += self.weights[_keys([flat[i] for i in part], length)] @ weight
        out = np.full(len(words), -np.inf)
        np.maximum.at(out, owner, found)
        return out

    @staticmethod
    def value_of(values: list[float]) -> float:
        """The value of a text from those of its distinct words; without words the lowest."""
        top = max(values, default=-np.inf)
        return top if top < 0 else sum([v for v in values if v > 0]) / (1 + len(values) / USUAL_WORDS) ** 0.5

    def score(self, value: float) -> float:
        x = self.slope * value + self.shift if value > -np.inf else -50.0
        return float(1 / (1 + np.exp(-np.clip(x, -50, 50))))


def _machine(phi: np.ndarray, negative: np.ndarray, positive: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine with squared hinge loss, by Newton steps over blocks of rows: rows of phi with
    the given numbers are negative, each of weight 1."""
    size = phi.shape[1] + 1
    w, ridge = np.zeros(size), np.eye(size)
    ridge[-1, -1] = 1e-6

    def blocks():
        for first in range(0, len(negative), BLOCK):
            rows = phi[negative[first : first + BLOCK]]
            yield rows, -1.0, np.ones(len(rows))
        for first in range(0, len(positive), BLOCK):
            yield positive[first : first + BLOCK], 1.0, weight[first : first + BLOCK]

    for _ in range(30):
        left, right = ridge.copy(), np.zeros(size)
        for block, label, heavy in blocks():
            rows = np.hstack([block, np.ones((len(block), 1))])
            active = label * (rows @ w) < 1
            part = rows[active]
            left += PENALTY * part.T @ (heavy[active][:, None] * part)
            right += PENALTY * label * (part.T @ heavy[active])
        new = np.linalg.solve(left, right)
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w[:-1], float(w[-1])


def _shift(values: np.ndarray, y: np.ndarray) -> float:
    """Shift that puts the middle of the logistic curve of slope SLOPE where the fewest texts are on the wrong side (halfway
    between the texts next to that place; of several such places the highest)."""
    order = np.argsort(values)
    values, y = values[order], y[order]
    errors = np.concatenate(([0], np.cumsum(y > 0))) + (y < 0).sum() - np.concatenate(([0], np.cumsum(y < 0)))
    between = np.concatenate(([True], values[1:] > values[:-1], [True]))
    at = np.flatnonzero(between & (errors == errors[between].min()))[-1]
    low, high = values[at - 1] if at else values[0] - 1, values[at] if at < len(values) else values[-1] + 1
    return -SLOPE * float(low + high) / 2


def stretched(words: list[str]) -> list[str]:
    """The words with one letter put in, at each inner place."""
    return [w[:i] + "xzqj"[i % 4] + w[i:] for w in words for i in range(1, len(w)) if len(w) < LONGEST]


def _telling(bad: Counter, good: Counter) -> dict[str, float]:
    """Words that toxic texts hold too often, with the evidence for it.

    The evidence of a word in k toxic ones of its n texts is Chernoff's bound on the logarithm of the chance of that, if each
    of the n were toxic as often as any word's text is. It has to exceed the logarithm of the number of words that could
    reach it at all (Tarone's correction for many tests), so that about one word in all is taken for telling by chance.
    """
    share = sum(bad.values()) / (sum(bad.values()) + sum(good.values()))
    words = [w for w in sorted(bad) if len(w) >= ORDER and bad[w] >= MIN_TEXTS]
    if not words or not 0 < share < 1:
        return {}
    k = np.array([bad[w] for w in words], float)
    n = k + [good[w] for w in words]
    rate = k / n
    rest = np.where(rate < 1, (1 - rate) * np.log(np.maximum(1 - rate, 1e-300) / (1 - share)), 0.0)
    evidence = np.where(rate > share, n * (rate * np.log(rate / share) + rest), 0.0)
    reach = np.sort([(bad[w] + good[w]) * -np.log(share) for w in {**bad, **good} if len(w) >= ORDER])
    tests = 1
    while len(reach) - np.searchsorted(reach, np.log(tests)) > tests:
        tests *= 2
    return {w: e for w, e in zip(words, evidence.tolist()) if e > np.log(tests)}


def _spanning(gain: dict[str, float], most: int) -> list[str]:
    """Words whose kernel rows span those of all, by pivoted Cholesky; the pivot is the word with the largest product of its
    evidence and what is left of it, the first in order on ties."""
    words = sorted(gain)
    evidence = np.array([gain[w] for w in words])
    kernel = features(words, words).astype(np.float64)
    left, columns, chosen = np.diag(kernel).copy(), np.zeros((0, len(words))), []
    need = RESIDUE * left
    while len(chosen) < min(most, len(words)):
        at = int(np.argmax(np.where(left > need, left * evidence, -1.0)))
        if left[at] <= max(need[at], 1e-9):
            break
        column = (kernel[at] - columns[:, at] @ columns) / np.sqrt(left[at])
        columns, left = np.vstack((columns, column)), np.maximum(left - column**2, 0)
        chosen.append(words[at])
    return chosen


def train(texts: list[str], toxic: list[int]) -> Model | None:
    """A model from labelled texts; None without both classes or without any word that tells them apart."""
    common = common_words([bag_of(t, None) for t, label in zip(texts, toxic) if label != 1])
    return train_bags([tuple(bag_of(t, common)) for t in texts], toxic, common)


def train_bags(all_bags: list[tuple[str, ...]], toxic: list[int], common: frozenset[str]) -> Model | None:
    """A model from the distinct instances of labelled texts."""
    once: dict[tuple[str, ...], int] = {}
    for bag, label in zip(all_bags, toxic):
        once[bag] = max(once.get(bag, -1), 1 if label == 1 else -1)
    bags, y = list(once), np.array(list(once.values()))
    if not (y > 0).any() or not (y < 0).any():
        return None
    bad, good = Counter(), Counter()
    for bag, label in zip(bags, y):
        (bad if label > 0 else good).update(bag)
    gain = _telling(bad, good)
    telling = _spanning(gain, LANDMARKS)
    usual = [w for w in sorted(good, key=lambda w: (-good[w], w)) if len(w) >= ORDER and w not in gain][:LANDMARKS]
    if not telling or not usual:
        return None
    landmarks = telling + usual
    own = features(landmarks, landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2 + 1e-3 * np.eye(len(landmarks)))
    whiten = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T

    vocabulary = sorted({w for bag in bags for w in bag})
    place = {w: i for i, w in enumerate(vocabulary)}
    phi = features(vocabulary, landmarks)
    alike = phi[:, : len(telling)].max(axis=1) >= ALIKE
    for first in range(0, len(phi), BLOCK):
        phi[first : first + BLOCK] = phi[first : first + BLOCK] @ whiten
    members = [np.array([place[w] for w in bag], np.int64) for bag in bags]
    sure = np.array([w in gain for w in vocabulary])
    clean = np.array([good[w] > 0 for w in vocabulary]) & ~sure
    # The first witness of a toxic text is its most telling word, later the one with the highest value.
    value = np.array([gain.get(w, 0.0) for w in vocabulary])
    may = sure | (alike & ~clean)
    negative, w, bias = np.flatnonzero(clean), np.zeros(len(landmarks)), -1.0
    for _ in range(ROUNDS):
        found = [m[np.argmax(np.where(may[m], value[m], -np.inf))] for m, label in zip(members, y) if label > 0 and may[m].any()]
        positive = np.union1d(np.flatnonzero(sure), np.array([i for i in found if value[i] > 0], np.int64))
        more = (features(stretched([vocabulary[i] for i in positive]), landmarks) @ whiten).astype(np.float32)
        heavy = max(1.0, 0.02 * len(negative) / len(positive))
        w, bias = _machine(phi, negative, np.concatenate((phi[positive], more)), np.repeat([heavy, heavy / 20], [len(positive), len(more)]))
        value = phi @ w.astype(np.float32) + bias
    top = np.array([Model.value_of(value[m].tolist()) if len(m) else value.min() for m in members])
    table = np.zeros(SIZE)
    for z, c in zip(landmarks, whiten @ w):
        np.add.at(table, _keys([z], len(z))[0], c * _SHAPES[len(z)][1] / _REACH[len(z)])
    return Model(table, bias, SLOPE, _shift(top, y), common)


def scorer(model: Model | None) -> Callable[[list[str]], list[float]]:
    """Scores of texts; values of words are remembered, up to MEMO of them."""
    known: dict[str, float] = {}

    def run(texts: list[str]) -> list[float]:
        if model is None:
            return [0.0] * len(texts)
        bags = [set(words_of(t, model.common)) for t in texts]
        new = list({w for bag in bags for w in bag}.difference(known))
        if len(known) + len(new) > MEMO:
            known.clear()
            new = list({w for bag in bags for w in bag})
        known.update(zip(new, model.values(new).tolist()))
        value = known.__getitem__
        return [model.score(model.value_of(list(map(value, sorted(bag))))) for bag in bags]

    return run


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, max_texts: int = MAX_TEXTS) -> Model | None:
    """A model from labelled rows outside the held-out fold: at most max_texts of each class."""
    flags = labels.select(labels["doc_id"].cast("long").alias("id"), labels["toxic"].cast("int").alias("toxic"))
    flags = flags.where("id is not null and toxic in (0, 1)").where(~F.coalesce(held_out(F.col("id")), F.lit(True)))
    flags = flags.groupBy("id").agg(F.max("toxic").alias("toxic"))
    some = None
    for kind in (1, 0):
        part = flags.where(F.col("toxic") == kind).orderBy(F.md5(F.col("id").cast("string")), "id").limit(max_texts)
        some = part if some is None else some.unionByName(part)
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), text_of(docs).alias("text"))
    # At most two times max_texts ids: a side whose size is fixed.
    sample = written(rows.join(F.broadcast(some), "id").select("text", "toxic").distinct())
    common = common_words([bag for bag, label in _bags(sample, None) if label != 1])
    found = _bags(sample, common)
    return train_bags([bag for bag, _ in found], [label for _, label in found], common)


def _bags(sample: DataFrame, common: frozenset[str] | None) -> list[tuple[tuple[str, ...], int]]:
    """The distinct instances of each text of a bounded sample, in a fixed order; without joins only those that may be
    common. An instance is one object, however many texts hold it."""

    def run(batches):
        for batch in batches:
            bags = [bag_of(t, common) for t in batch.column("text").to_pylist()]
            if common is None:
                bags = [[w for w in bag if len(w) <= SHORT + 1] for bag in bags]
            yield pa.RecordBatch.from_arrays([pa.array(bags, pa.list_(pa.string())), batch.column("toxic")], ["bag", "toxic"])

    once: dict[str, str] = {}
    out = []
    for batch in sample.mapInArrow(run, "bag array<string>, toxic int").toArrow().to_batches(max_chunksize=100):
        bags = batch.column("bag").to_pylist()
        out += [(tuple(once.setdefault(w, w) for w in bag), label) for bag, label in zip(bags, batch.column("toxic").to_pylist())]
    return sorted(out)


def score_texts(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = scorer(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            scores = [s for i in range(0, len(texts), 500) for s in score(texts[i : i + 500])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model | None, limit: float = 0.5) -> DataFrame:
    """The rows of docs, with their columns, that score below the limit."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches):
        score = scorer(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            scores = [s for i in range(0, len(texts), 500) for s in score(texts[i : i + 500])]
            yield batch.filter(pa.array([s < limit for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def digest(scored: DataFrame) -> DataFrame:
    fold = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
