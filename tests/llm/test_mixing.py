import itertools
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from gable.llm import mixing
from tests.llm.helpers import DOCS, rows, with_clashes


def reshared(sizes, weights=(1, 2, 3), most=3):
    """Targets by rounds of resharing what is above the limits."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = Fraction(sum(sizes.values())), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        by = sum(weight[s] for s in order if s not in full)
        want = {s: Fraction(most * sizes[s]) if s in full else left * weight[s] / by for s in order}
        above = {s for s in order if want[s] > most * sizes[s]}
        if not above:
            return {s: float(w) for s, w in want.items()}
        full |= above


def table(spark, data):
    return with_clashes(spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in data], DOCS))


def test_counts_come_as_near_as_any_subset():
    rng = random.Random(1)
    for _ in range(300):
        lengths = np.array(sorted(rng.sample(range(1, 30), rng.randint(1, 5))))
        counts = np.array([rng.randint(1, 4) for _ in lengths])
        budget = rng.randint(1, int(lengths @ counts))
        taken = mixing.budget_counts(lengths, counts, budget, rng.randint(0, 9))
        assert (taken <= counts).all() and (taken >= 0).all()
        sums = {int(np.dot(c, lengths)) for c in itertools.product(*(range(n + 1) for n in counts))}
        assert abs(int(taken @ lengths) - budget) == min(abs(x - budget) for x in sums)
        # With a small window most documents are taken by share; what is left is met by the best subset of the rest.
        taken = mixing.budget_counts(lengths, counts, budget, window=5)
        assert (taken <= counts).all() and (taken >= 0).all() and abs(int(taken @ lengths) - budget) <= lengths.max()


def test_large_budgets_are_met_exactly():
    rng = np.random.default_rng(2)
    lengths = np.unique(rng.integers(1, 20_000, 3000))
    counts = rng.integers(1, 10**6, len(lengths))
    for share in (0.001, 0.37, 0.9999):
        budget = int(share * int(lengths @ counts))
        taken = mixing.budget_counts(lengths, counts, budget)
        assert int(taken @ lengths) == budget and (taken <= counts).all()
    long = np.array([10**6, 10**6 + 1])
    assert int(mixing.budget_counts(long, np.array([5, 5]), 2_000_001) @ long) == 2_000_001
    assert mixing.budget_counts(long, np.array([1, 1]), 400_000).tolist() == [0, 0]


def test_targets_equal_resharing(spark):
    rng = random.Random(3)
    for n in (1, 2, 7, 40):
        sizes = {(f"s{rng.randint(0, 10**6)}" if i else None): rng.choice([0, 1, 10, 1000, 10**6]) for i in range(n)}
        part = lambda s: "0" if s is None else "1" + s
        df = spark.createDataFrame([(part(s), x) for s, x in sizes.items()], "part string, source_size long")
        found = {r["part"]: r["target"] for r in mixing.targets(df).collect()}
        for s, w in reshared(sizes).items():
            assert abs(found[part(s)] - w) <= 1e-9 * max(1, w)


def corpus(rng):
    data = []
    for i in range(600):
        source = rng.choice(["hot"] * 6 + ["b", "", "Z", "é", "0", "10", None])
        data.append((i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 1, 5, 5, 5, 17, 60]))), source))
    return data + [(i, "same text of six words here", "hot") for i in range(600, 900)] + [(3, None, "b"), (None, "a\tb\x0bc\nd", None), (4, "x", "b"), (4, "x", "b")]


def check(data, found):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for i, t, s in data:
        sizes[s] += len((t or "").replace("\x0b", " ").split())
    source = {(i, len((t or "").replace("\x0b", " ").split())): s for i, t, s in data}
    want = reshared(sizes)
    assert len(found) == len(data)
    for r in found:
        s = source[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) <= 1e-9 * max(1, want[s])
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.5 or sizes[s] < 10, (s, taken[s], target[s])
    assert abs(sum(taken.values()) - sum(sizes.values())) <= len(sizes)


def test_mix_meets_targets_and_reruns_agree(spark):
    data = corpus(random.Random(4))
    first = mixing.mixed(table(spark, data).repartition(3)).collect()
    check(data, first)
    assert rows(mixing.mixed(table(spark, data).repartition(11, F.col("text")))) == sorted(map(tuple, first), key=repr)
    other = rows(mixing.mixed(table(spark, data), seed=1))
    assert other != sorted(map(tuple, first), key=repr)


def test_awkward_tables(spark):
    assert mixing.mixed(table(spark, [])).count() == 0
    empty = mixing.mixed(table(spark, [(1, None, "a"), (2, " \n", None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in empty] == [(0, 0.0, 0)] * 2
    one = mixing.mixed(table(spark, [(1, "a b c", None)])).collect()
    assert [(r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in one] == [(1, 3, 3, 3.0, 3)]
    long = [(0, "x " * 300_000, "a"), (1, "x y", "b")]
    assert rows(mixing.mixed(table(spark, long))) == [(0, 300_000, 300_000, 299_996.0, 300_000), (1, 2, 2, 6.0, 6)]
