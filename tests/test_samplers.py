import numpy as np
import pytest
from pyspark.sql import functions as F

from gable.operators import samplers as S
from gable.operators import splits
from gable.operators import kdtree, knn
from gable.operators.knn import knn_join


def brute(q, t, k, exclude_self=False):
    out = {}
    for i, x in q.items():
        d = sorted((float(np.sqrt(((np.array(x) - np.array(y)) ** 2).sum())), j) for j, y in t.items() if not (exclude_self and i == j))
        out[i] = [j for _, j in d[:k]]
    return out


def clustered(n, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 3)) * 10
    return {i: [float(v) for v in centres[i % 5] + rng.normal(size=3)] for i in range(n)}


@pytest.mark.parametrize("options", [{}, {"chunk_rows": 40, "cell_rows": 20}, {"chunk_rows": 7, "cell_rows": 400}])
def test_knn_join_is_exact(spark, options):
    t, q = clustered(400), {1000 + i: x for i, x in clustered(60, 1).items()}
    t.update({400 + i: t[0] for i in range(50)})  # a hot spot of identical rows
    frame = lambda d: spark.createDataFrame([(i, *x) for i, x in d.items()], "id long, a double, b double, c double")
    rows = knn_join(frame(q), frame(t), 4, "id", "id", ["a", "b", "c"], **options).orderBy("id", "nn").collect()
    got = {}
    for r in rows:
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == brute(q, t, 4)


def test_knn_join_excludes_the_row_itself(spark):
    t = clustered(150)
    df = spark.createDataFrame([(i, x) for i, x in t.items()], "id long, v array<double>")
    rows = knn_join(df, df, 3, "id", "id", "v", exclude_self=True, chunk_rows=30, cell_rows=20).orderBy("id", "nn").collect()
    got = {}
    for r in rows:
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == brute(t, t, 3, True)


def test_knn_join_with_few_train_rows(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0)], "id long, a double")
    assert knn_join(df, df, 5, "id", "id", ["a"]).count() == 4
    assert knn_join(df, df.limit(0), 5, "id", "id", ["a"]).count() == 0


@pytest.mark.parametrize("sizes,cut", [({0: 400, 1: 100}, {}), ({0: 401, 1: 100}, {0: 400}), ({0: 1000, 1: 99}, {}), ({0: 900, 1: 120}, {0: 480})])
def test_balanced_goals(sizes, cut):
    # The class of 99 rows has a share under a tenth, so it is left alone.
    assert S.BalancedClassificationSampler().goals(sizes) == cut


@pytest.mark.parametrize("bad", [{"balanced_ratio": 0}, {"min_samples": 0}, {"min_percentage": 0}, {"min_percentage": 0.6}])
def test_sampler_arguments(bad):
    with pytest.raises(ValueError):
        S.BalancedClassificationSampler(**bad)


def test_under_sampling_counts(spark):
    df = spark.range(300).withColumn("c", F.when(F.col("id") < 200, "a").when(F.col("id") < 260, "b").otherwise("c"))
    for replacement in (False, True):
        out = S.RandomUnderSampler(replacement, 1).fit_resample(df, "c", "id")
        assert {r["c"]: r["count"] for r in out.groupBy("c").count().collect()} == {"a": 40, "b": 40, "c": 40}
        assert replacement or out.distinct().count() == 120


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(x), float(y), int(i % 6 == 0)) for i, (x, y) in enumerate(rng.normal(size=(120, 2)))]
    return spark.createDataFrame(rows, "id long, x double, y double, c int")


def test_smote_points_lie_between_rows_of_the_class(points):
    out = S.SMOTE(3).fit_resample(points, "c", "id", ["x", "y"])
    counts = {r["c"]: r["count"] for r in out.groupBy("c").count().collect()}
    assert counts == {0: 100, 1: 100} and out.select("id").distinct().count() == 200
    old = {r["id"]: (r["x"], r["y"]) for r in points.filter("c = 1").collect()}
    near = brute(old, old, 3, True)
    for r in out.filter("synthetic").collect():
        p = np.array([r["x"], r["y"]])
        ok = any(
            abs(np.linalg.norm(p - old[i]) + np.linalg.norm(p - old[j]) - np.linalg.norm(np.array(old[i]) - old[j])) < 1e-9
            for i in old for j in near[i]
        )
        assert ok


def test_tomek_links_against_brute_force(points):
    rows = {r["id"]: (r["x"], r["y"]) for r in points.collect()}
    classes = {r["id"]: r["c"] for r in points.collect()}
    near = {i: n[0] for i, n in brute(rows, rows, 1, True).items()}
    want = {i for i, j in near.items() if near[j] == i and classes[i] != classes[j]}
    assert {r["id"] for r in S.tomek_links(points, "c", "id", ["x", "y"]).collect()} == want and want
    out = S.SMOTETomek(3).fit_resample(points, "c", "id", ["x", "y"])
    assert S.tomek_links(out, "c", "id", ["x", "y"]).count() < 20


def test_smotenc(points):
    df = points.withColumn("k", F.when(F.col("x") > 0, "p").otherwise("n"))
    out = S.SMOTENC(["k"], 3).fit_resample(df, "c", "id", ["x", "y", "k"])
    assert out.filter("synthetic").count() == 80 and out.filter("k IS NULL").count() == 0
    for bad in ([], ["nope"]):
        with pytest.raises(ValueError):
            S.SMOTENC(bad).fit_resample(df, "c", "id", ["x", "y", "k"])
    with pytest.raises(ValueError):
        S.SMOTENC(["k"]).fit_resample(df, "c", "id", ["k"])


def test_kmeans_smote_balances(points):
    out = S.KMeansSMOTE(2, n_clusters=3).fit_resample(points, "c", "id", ["x", "y"])
    assert {r["c"]: r["count"] for r in out.groupBy("c").count().collect()} == {0: 100, 1: 100}


def test_samplers_need_numbers_without_nulls(points):
    with pytest.raises(ValueError):
        S.SMOTE().fit_resample(points.withColumn("x", F.col("x").cast("string")), "c", "id", ["x", "y"])
    with pytest.raises(ValueError):
        S.SMOTE().fit_resample(points.withColumn("x", F.when(F.col("x") > 0, F.col("x"))), "c", "id", ["x", "y"])


def test_resampling_leaves_test_rows_alone(points):
    out = S.resampled_split(points, S.RandomUnderSampler(), "c", "id", test_size=0.25)
    assert out.filter("split = 'test'").count() == 30
    folds = S.resampled_folds(points, S.RandomUnderSampler(), "c", "id", k=3)
    assert folds.filter("split = 'test'").count() == 120


def test_splits(spark):
    df = spark.range(101).withColumn("c", F.col("id") % 3)
    out = splits.split_data(df, "regression", "id")
    assert out.filter("split = 'test'").count() == 21
    ordered = splits.split_data(df, "time series regression", "id")
    assert {r["id"] for r in ordered.filter("split = 'test'").collect()} == set(range(80, 101))
    folds = splits.k_fold(df, "id", 4, ["c"]).groupBy("c", "fold").count().collect()
    assert {r["count"] for r in folds} <= {8, 9} and len(folds) == 12
    for call in (
        lambda: splits.split_data(df, "nonsense", "id"),
        lambda: splits.training_validation_split(df, "id", stratify="c"),
        lambda: splits.k_fold(df, "id", 1),
        lambda: splits.time_series_split(df, ["id"], n_splits=10, max_delay=9, gap=9),
    ):
        with pytest.raises(ValueError):
            call()
    assert splits.training_validation_split(df, "id", train_size=0.9).filter("split = 'test'").count() == 11


def test_tree_cells_hold_few_rows_and_every_near_cell_is_found():
    rng = np.random.default_rng(3)
    x = np.concatenate((rng.normal(size=(3000, 3)) ** 3, np.repeat([[1.0, 2.0, 3.0]], 500, axis=0)))
    tree = kdtree.Tree()
    tree.extend(0, kdtree.grown(x, len(x), 50))
    cell = tree.place(x)
    sizes = dict(zip(*np.unique(cell, return_counts=True)))
    assert sorted(n for n in sizes.values())[-2] <= 50  # but for the equal rows
    q, limit = rng.normal(size=(40, 3)) * 2, rng.uniform(0, 3, 40)
    row, near = tree.within(q, limit)
    found = set(zip(row.tolist(), near.tolist()))
    distance = np.sqrt(((q[:, None] - x[None]) ** 2).sum(axis=2))
    assert {(i, int(cell[j])) for i, j in zip(*np.nonzero(distance <= limit[:, None]))} <= found
    homes = tree.homes(sizes, 120)
    assert all(c in homes[c] and sum(sizes[x] for x in homes[c]) >= 120 for c in sizes)


def test_codes_that_differ_add_to_the_distance(spark):
    rng = np.random.default_rng(4)
    data = [(i, [float(rng.integers(0, 9)) / 2, float(rng.normal())], [int(rng.integers(0, 3)), int(rng.integers(0, 2))]) for i in range(300)]
    df = spark.createDataFrame(data, "id long, v array<double>, c array<long>")
    got = {}
    for r in knn_join(df, df, 4, "id", "id", "v", exclude_self=True, cell_rows=25, codes="c", mismatch=0.3).orderBy("id", "nn").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    for i, v, c in data[::7]:
        far = lambda j: np.sqrt(np.square(np.subtract(v, data[j][1])).sum() + 0.3 * sum(a != b for a, b in zip(c, data[j][2])))
        assert got[i] == sorted((j for j in range(300) if j != i), key=lambda j: (far(j), j))[:4]


def test_knn_join_sends_no_task_more_than_a_few_of_many_equal_rows(spark, monkeypatch):
    # 40 places with 50 rows each: only the smallest keys of a place can be neighbours, and its queries share one search.
    df = spark.range(2000).select("id", F.array((F.col("id") % 40).cast("double"), F.lit(0.0)).alias("v"))
    seen, search = [], knn._search

    def counted(q, t, *rest):
        seen.append((q.count(), t.count()))
        return search(q, t, *rest)

    monkeypatch.setattr(knn, "_search", counted)
    rows = knn_join(df, df, 2, "id", "id", "v", exclude_self=True).collect()
    assert seen == [(40, 120)] and len(rows) == 4000
    got = {(r["id"], r["nn"]): (r["neighbour"], r["distance"]) for r in rows}
    assert got[(7, 1)] == (47, 0.0) and got[(7, 2)] == (87, 0.0)
    assert got[(1967, 1)] == (7, 0.0) and got[(1967, 2)] == (47, 0.0)


def test_queries_that_reach_everything_move_once_per_region(spark):
    rng = np.random.default_rng(8)
    data = [(i, [float(x) for x in rng.normal(size=24)]) for i in range(600)]
    x = np.array([v for _, v in data])
    tree = kdtree.Tree()
    tree.extend(0, kdtree.grown(x, len(x), 20))
    sizes = dict(zip(*(c.tolist() for c in np.unique(tree.place(x), return_counts=True))))
    region, top = tree.regions(sizes, 200)
    row, part = tree.within(x, np.full(len(x), 1e6), top)
    assert len(sizes) > 20 and top.sum() <= 8 and len(row) == len(x) * top.sum()
    assert all(sum(n for c, n in sizes.items() if region[c] == r) <= 200 for r in set(part.tolist()))
    df = spark.createDataFrame(data, "id long, v array<double>")
    got = {}
    for r in knn_join(df, df, 5, "id", "id", "v", exclude_self=True, chunk_rows=200, cell_rows=20).orderBy("id", "nn").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == brute(dict(data), dict(data), 5, True)


def test_nearest_rows_far_from_the_origin_and_at_limits():
    rng = np.random.default_rng(3)
    none = np.empty((0, 0))
    for shift, scale in ((0.0, 1.0), (1e9, 1e-3), (0.0, 1e160)):
        a, b = shift + scale * rng.normal(size=(30, 5)), shift + scale * rng.normal(size=(80, 5))
        with np.errstate(over="ignore", invalid="ignore"):
            distance = np.sqrt(sum((x[:, None] - y) ** 2 for x, y in zip(a.T, b.T)))
            whole = knn.nearest_rows(a, b, 4, none, none, 0.0)
        order = np.argsort(distance, axis=1, kind="stable")[:, :4]
        if scale > 1e100:  # no finite square distance
            assert not len(whole[0])
            continue
        assert whole[1].reshape(30, 4).tolist() == order.tolist()
        limit = np.sort(distance, axis=1)[:, 2]
        for bounded in (
            knn.nearest_rows(a, b, 4, none, none, 0.0, limit),
            knn._nearest_in_cells(a, b, 4, none, none, 0.0, limit, np.arange(80) % 7),
        ):
            assert bounded[1].reshape(30, 3).tolist() == order[:, :3].tolist()


def test_rows_without_finite_numbers_are_no_neighbours(spark):
    data = [(1, [0.0]), (2, [-0.0]), (3, [None]), (4, [float("nan")]), (5, [float("inf")]), (6, None), (7, [2.0])]
    df = spark.createDataFrame(data, "id long, v array<double>")
    got = {(r["id"], r["neighbour"]) for r in knn_join(df, df, 2, "id", "id", "v", exclude_self=True).collect()}
    assert got == {(1, 2), (1, 7), (2, 1), (2, 7), (7, 1), (7, 2)}
