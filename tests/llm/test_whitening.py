import math
import random

import numpy as np

from gable.llm import whitening
from tests.llm.helpers import with_clashes

KIND = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return with_clashes(spark.createDataFrame([(i, v, 0) for i, v in rows], KIND))


def brute(rows, k=32):
    """Exact sums, then the eigenvectors of the covariance in long doubles."""
    f32 = lambda c: None if c is None else float(np.float32(c))
    kept = [(i, [math.floor(64 * f32(c)) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(f32(c)) for c in v)]
    n, d = len(kept), len(kept[0][1])
    sums = [sum(v[j] for _, v in kept) for j in range(d)]
    far = [[n * v[j] - sums[j] for j in range(d)] for _, v in kept]
    a = np.array(far, dtype=object) / n
    cov = np.array((a.T @ a) / n, np.float64)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return [i for i, _ in kept], [sum(x * x for x in row) for row in far], np.array(a, np.float64) @ vectors / np.sqrt(values), values / np.trace(cov)


def collected(df, k):
    got = sorted(df.collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0, r["component"]))
    return got, np.array([r["whitened"] for r in got]).reshape(-1, k)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    spread = rng.normal(size=(12, 12)) * np.geomspace(1, 40, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(500, 12)) @ spread)]
    bad = [(900, None), (901, [1.0] * 11 + [None]), (902, [1.0] * 11 + [float("nan")]), (903, [float("inf")] + [0.0] * 11), (904, []), (905, [1.0, 2.0])]
    df = whitening.whiten(table(spark, rows + bad).repartition(5))
    got, white = collected(df, 12)
    ids, far, want, share = brute(rows)
    assert [r["vec_id"] for r in got[::12]] == ids and [r["deviation"] for r in got[::12]] == far
    assert {r["n"] for r in got} == {500} and [r["component"] for r in got[:12]] == list(range(1, 13))
    assert np.abs(white * np.sign((white * want).sum(axis=0)) - want).max() < 1e-9
    assert np.allclose([r["explained"] for r in got[:12]], share, rtol=1e-9)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9
    assert np.abs(white.T @ white / 500 - np.eye(12)).max() < 1e-9


def test_ill_conditioned_and_dependent_dimensions(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 6)) * [1e5, 1e4, 1, 1, 0.5, 0.2]
    whole = np.floor(64 * base.astype(np.float32)) / 64
    rows = [(i, [*v, v[0], 3.0]) for i, v in enumerate(whole.tolist())]  # one repeated, one constant dimension
    got, white = collected(whitening.whiten(table(spark, rows)), 6)
    assert len(got) == 300 * 6 and got[0]["identity_error"] < 1e-8
    assert abs(sum(r["explained"] for r in got[:6]) - 1) < 1e-12


def test_more_than_32_dimensions_and_repeated_rows(spark):
    rng = random.Random(3)
    rows = [(i % 150 if i % 7 else None, [rng.gauss(0, 5) for _ in range(40)]) for i in range(200)]
    rows += rows[:20]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 220 * 32 and {r["component"] for r in got} == set(range(1, 33)) and {r["n"] for r in got} == {220}
    _, far, _, share = brute(rows)
    assert sorted(r["deviation"] for r in got if r["component"] == 1) == sorted(far)
    assert np.allclose(sorted({r["explained"] for r in got}), sorted(share), rtol=1e-9)


def test_tables_without_variance(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, [1e30, 0.0])]):
        df = whitening.whiten(table(spark, rows))
        assert df.columns == whitening.NAMES and df.count() == 0
    few = whitening.whiten(table(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(4)])).collect()
    assert {r["component"] for r in few} == {1} and abs(few[0]["explained"] - 1) < 1e-12


def test_deviations_beyond_64_bits_are_null():
    centre = whitening.Centre(3, np.array([0, 0]), np.array([1, -1]))
    x = np.array([[5, 2], [1 << 50, 0]])
    assert centre.deviation(x).to_pylist() == [14**2 + 7**2, None]
    assert centre.deviation(x[:1]).to_pylist() == [14**2 + 7**2]
