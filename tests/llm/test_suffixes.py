import random
from collections import Counter

import numpy as np

from gable.llm.suffixes import _doubled, repeated_windows, suffix_array


def test_suffix_array_equals_sorting():
    rng = random.Random(1)
    for _ in range(200):
        t = np.array([rng.randint(1, rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(0, 60))] + [0])
        want = sorted(range(len(t)), key=lambda i: t[i:].tolist())
        assert suffix_array(t).tolist() == want
        assert _doubled(t).tolist() == want


def test_repeated_windows_equal_counting():
    rng = random.Random(2)
    for _ in range(100):
        records = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        width = rng.choice([2, 3, 5])
        count = Counter(r[i : i + width] for r in records for i in range(len(r) - width + 1))
        got = repeated_windows(records, width)
        assert [g.tolist() for g in got] == [[count[r[i : i + width]] > 1 for i in range(len(r) - width + 1)] for r in records]


def test_many_names_are_ordered_by_doubling():
    t = np.append(np.random.default_rng(3).integers(1, 250, 30_000), 0)
    t[10_000:20_000] = t[:10_000]
    sa = suffix_array(t)
    data = t.astype(np.uint8).tobytes()
    assert all(data[a:] < data[b:] for a, b in zip(sa[:-1:97], sa[1::97]))
    assert sorted(sa.tolist()) == list(range(len(t)))
