import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from gable.operators import models as M
from gable.operators import splits
from gable.operators.metrics import regression_scores


@pytest.fixture(scope="module")
def homes(spark):
    rng = np.random.default_rng(5)
    data = [(i, float(a), float(r), float(1000 * a + 5000 * r + 300 * (a > 60) * a + rng.normal() * 500)) for i, (a, r) in enumerate(zip(rng.uniform(20, 120, 400), rng.integers(1, 7, 400)))]
    df = spark.createDataFrame(data, "unit_indx long, area double, rooms double, price double")
    return splits.split_by_key(df, "unit_indx", 0.25).persist()


X = ["area", "rooms"]


def parts(homes):
    return homes.filter("split = 'train'"), homes.filter("split = 'test'")


def mae(df, p):
    return regression_scores(df, "price", p, ["MAE"]).first()["mae"]


def test_models_beat_the_mean(homes, tmp_path):
    train, test = parts(homes)
    baseline = mae(M.MeanBaseline(label="price").fit(train).transform(test), "prediction")
    trees = M.tree_regressor(X, "price", n_estimators=5, max_depth=3, learning_rate=0.5).fit(train)
    for model in (trees, M.knn_regressor(X, "price").fit(train), M.linear_regressor(X, "price").fit(train)):
        assert mae(model.transform(test), "prediction") < baseline / 3
    trees.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert mae(again.transform(test), "prediction") == mae(trees.transform(test), "prediction")


def test_knn_zero_distance_decides(spark):
    train = spark.createDataFrame([(1, 0.0, 10.0), (2, 0.0, 20.0), (3, 1.0, 90.0)], "unit_indx long, a double, y double")
    model = M.knn_regressor(["a"], "y", n_neighbors=3).fit(train)
    test = spark.createDataFrame([(7, 0.0), (8, 0.5)], "unit_indx long, a double")
    got = {r["unit_indx"]: r["prediction"] for r in model.transform(test).collect()}
    assert got == {7: 15.0, 8: pytest.approx(40.0)}
    plain = M.knn_regressor(["a"], "y", n_neighbors=3, weights="uniform").fit(train)
    assert plain.transform(test).filter("unit_indx = 7").first()["prediction"] == 40.0
    with pytest.raises(ValueError):
        M.knn_regressor(["a"], "y", weights="other")


def test_blend_and_stack(homes):
    train, test = parts(homes)
    bases = {
        "trees": M.tree_regressor(X, "price", "trees", n_estimators=3, max_depth=3, learning_rate=0.5),
        "near": M.knn_regressor(X, "price", "near"),
        "linear": M.linear_regressor(X, "price", "linear"),
    }
    blend = M.Blend(bases, M.linear_regressor(list(bases), "price", "avm"), "unit_indx").fit(train)
    out = blend.transform(test)
    assert set(out.columns) >= {"trees", "near", "linear", "avm"} and out.count() == test.count()
    stack = M.stacked_regressor(bases, "price", "unit_indx", prediction="avm")
    oof = stack.out_of_fold(train)
    assert oof.count() == train.count() == oof.select("unit_indx").distinct().count()
    stacked = stack.fit(train).transform(test)
    base = mae(M.MeanBaseline(label="price").fit(train).transform(test), "prediction")
    assert mae(out, "avm") < base / 3 and mae(stacked, "avm") < base / 3
    for bad in ({}, {"b": M.MeanBaseline(label="price")}):
        with pytest.raises(ValueError):
            M.stacked_regressor(bad, "price", "unit_indx")
    with pytest.raises(ValueError):
        M.Blend(bases, None, "unit_indx", mode="other")


def test_out_of_fold_does_not_see_the_row(homes):
    train, _ = parts(homes)
    near = {"near": M.knn_regressor(X, "price", "near", n_neighbors=1)}
    oof = M.stacked_regressor(near, "price", "unit_indx").out_of_fold(train)
    assert oof.filter(F.col("near") == F.col("price")).count() == 0
    seen = M.Blend(near, M.linear_regressor(["near"], "price", "avm"), "unit_indx").fit(train).transform(train)
    assert seen.filter(F.col("near") == F.col("price")).count() == train.count()


def test_search_prefers_the_better_model(homes):
    train, _ = parts(homes)
    forest = M.RandomForestRegressor(featuresCol="f", labelCol="price", seed=0)
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    chain = Pipeline(stages=[VectorAssembler(inputCols=X, outputCol="f"), forest])
    points = M.random_grid({forest.maxDepth: [1, 6], forest.numTrees: [5]}, trials=5)
    assert len(points) == 2
    best, trials = M.search(train, chain, points, "MdAPE", "price")
    rows = trials.collect()
    assert rows[0]["metric"] < rows[1]["metric"] and "maxDepth=6" in rows[0]["parameters"]
    assert best.stages[-1].getOrDefault("maxDepth") == 6
    # Tree splits look at sampled rows, so a linear model tells whether the folds are the same.
    line = M.LinearRegression(featuresCol="f", labelCol="price")
    chain, points = Pipeline(stages=[VectorAssembler(inputCols=X, outputCol="f"), line]), [{line.fitIntercept: True}, {line.fitIntercept: False}]
    folded = train.withColumn("part", F.pmod(F.xxhash64("unit_indx"), F.lit(3)))
    for options in ({"key": "unit_indx"}, {"fold_col": "part"}, {}):
        a, b = (M.search(df, chain, points, "MAE", "price", **options)[1].collect() for df in (folded.coalesce(1), folded.repartition(5)))
        assert [r["trial"] for r in a] == [r["trial"] for r in b]
        assert [r["metric"] for r in a] == pytest.approx([r["metric"] for r in b], rel=1e-9)


def test_explanations(spark, homes):
    train, _ = parts(homes)
    fitted = M.linear_regressor(X, "price").fit(train)
    table = M.feature_importance(spark, fitted).collect()
    assert [r["feature"] for r in table] == ["rooms", "area"]
    assert [r["feature"] for r in M.feature_importance(spark, fitted, 3000).collect()] == ["rooms"]
    grid = M.quantile_grid(train, "area", 5)
    pd = {r["value"]: r["mean_prediction"] for r in M.partial_dependence(fitted, train, "area", grid).collect()}
    assert sorted(pd) == grid and list(np.diff([pd[g] for g in grid]) > 0) == [True] * (len(grid) - 1)
    assert M.partitioned_predict(fitted, train, 4).rdd.getNumPartitions() == 4


def test_time_series(spark):
    df = spark.createDataFrame([(i, float(i % 5), 2.0 * i) for i in range(60)], "t int, x double, y double")
    model = M.TimeSeriesRegressor(lambda c, y: M.linear_regressor(c, y), ["t"], "y", features=["x"], gap=1, max_delay=2).fit(df)
    out = {r["t"]: r["prediction"] for r in model.transform(df).collect()}
    assert out[0] is None and out[1] is None and out[30] == pytest.approx(62.0, abs=1e-3)
    last = {r["t"]: r["prediction"] for r in M.last_value_baseline(df, ["t"], "y").collect()}
    assert last[0] is None and last[10] == 18.0


def test_knn_saves_and_loads_with_its_rows(spark, tmp_path):
    df = spark.range(60).selectExpr("id", "id % 7 * 1.0 AS x", "id * 0.5 AS z", "id * 3.0 AS y")
    model = M.KNeighborsRegressor(features=["x", "z"], label="y", key="id", n_neighbors=3).fit(df.filter("id >= 10"))
    model.write().overwrite().save(str(tmp_path / "knn"))
    again = type(model).load(str(tmp_path / "knn"))
    rows = df.filter("id < 10")
    assert sorted(map(tuple, again.transform(rows).collect())) == sorted(map(tuple, model.transform(rows).collect()))


def test_a_chain_of_comparables_and_blend_is_saved_and_loaded(homes, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel

    from gable.operators.comparables import Comparables

    train, test = parts(homes)
    train, test = (df.withColumn("town", F.pmod("unit_indx", F.lit(7)).cast("string")) for df in (train, test))
    columns = [*X, *[f"{X[0]}_minus_{op}" for op in ("mean", "median")], "price__mean"]
    bases = {
        "trees": M.tree_regressor(columns, "price", "trees", n_estimators=2, max_depth=2, learning_rate=0.5),
        "near": M.knn_regressor(X, "price", "near"),
        "linear": M.linear_regressor(columns, "price", "linear"),
    }
    blend = M.Blend(bases, M.linear_regressor(list(bases), "price", "avm"), "unit_indx", mode="out_of_fold", folds=2)
    chain = Pipeline(stages=[Comparables(keys=["town"], features=X[:1], price="price", ops=["mean", "median"]), blend])
    chain.write().save(str(tmp_path / "chain"))
    fitted = Pipeline.load(str(tmp_path / "chain")).fit(train)
    fitted.write().save(str(tmp_path / "fitted"))
    again = PipelineModel.load(str(tmp_path / "fitted"))
    score = lambda m: {r["unit_indx"]: r["avm"] for r in m.transform(test).collect()}
    assert score(again) == score(fitted) and len(score(again)) == test.count()
    copied = fitted.copy()
    assert copied.stages[1].parts is not fitted.stages[1].parts and score(copied) == score(fitted)
    with pytest.raises(ValueError):
        Comparables(ops=["mode"])


def test_a_time_series_regressor_is_saved_unfitted(spark, tmp_path):
    df = spark.createDataFrame([(t, float(t % 5), float(3 * ((t - 1) % 5) + 1)) for t in range(60)], "t int, x double, y double")
    stage = M.TimeSeriesRegressor(M.linear_regressor, ["t"], "y", features=["x"], gap=1, max_delay=2)
    stage.write().save(str(tmp_path / "series"))
    loaded = M.TimeSeriesRegressor.load(str(tmp_path / "series"))
    assert loaded.fit(df).transform(df).orderBy("t").collect() == stage.fit(df).transform(df).orderBy("t").collect()
