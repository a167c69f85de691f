import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from gable.operators import chain as C
from gable.operators import encode, impute, reduce, select, text, timeseries
from gable.operators.dates import DateTimeFeaturizer


@pytest.fixture(scope="module")
def rows(spark):
    data = [(1, 1.0, 3, "a", True, None), (2, None, 5, "b", None, None), (3, 4.0, None, None, False, None), (4, 4.0, 3, "b", True, None)]
    return spark.createDataFrame(data, "unit_indx int, x double, n int, s string, f boolean, never string")


def test_imputer(rows):
    out = impute.Imputer().fit(rows).transform(rows)
    assert out.columns == ["unit_indx", "x", "n", "s", "f"]
    got = {r["unit_indx"]: r for r in out.collect()}
    assert got[2]["x"] == 3.0 and got[3]["n"] == pytest.approx(11 / 3) and got[3]["s"] == "b" and got[2]["f"] is True
    assert dict(out.dtypes)["n"] == "double"
    for bad in ({"numeric_strategy": "max"}, {"categorical_strategy": "mean"}):
        with pytest.raises(ValueError):
            impute.Imputer(**bad)
    with pytest.raises(TypeError):
        impute.Imputer(nonsense=1)


def test_simple_imputer(rows):
    got = {r["unit_indx"]: r for r in impute.SimpleImputer().fit(rows).transform(rows).collect()}
    assert got[2]["x"] == 4.0 and got[3]["n"] == 3
    constant = impute.SimpleImputer(strategy="constant").fit(rows.drop("f")).transform(rows.drop("f"))
    got = {r["unit_indx"]: r for r in constant.collect()}
    assert got[2]["x"] == 0.0 and got[3]["s"] == "missing_value"
    flags = rows.select("f")
    assert impute.SimpleImputer().fit(flags).transform(flags).filter("f IS NULL").count() == 1
    with pytest.raises(ValueError):
        impute.SimpleImputer(strategy="mean").fit(rows)


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (1, "b"), (2, "a"), (2, "a"), (10, "c")], "n int, s string")
    assert impute.column_modes(df, ["n", "s"]) == {"n": 1, "s": "a"}


def test_per_column_imputer(rows):
    stage = impute.PerColumnImputer(impute_strategies={"x": {"impute_strategy": "median"}, "s": {"impute_strategy": "constant", "fill_value": "?"}})
    got = {r["unit_indx"]: r for r in stage.fit(rows).transform(rows).collect()}
    assert got[2]["x"] == 4.0 and got[3]["s"] == "?" and got[3]["n"] == 3
    with pytest.raises(ValueError):
        impute.PerColumnImputer(impute_strategies=[1]).fit(rows)


def test_one_hot(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("c",), (None,)], "s string")
    model = encode.OneHotEncoder(top_n=2).fit(df)
    assert model.get_feature_names() == ["s_a", "s_b"] and model.categories_of("s") == ["a", "b"]
    new = spark.createDataFrame([("z",), (None,), ("b",)], "s string")
    assert [tuple(r) for r in model.transform(new).collect()] == [(0.0, 0.0), (0.0, 0.0), (0.0, 1.0)]
    assert encode.OneHotEncoder(top_n=2, drop="first").fit(df).get_feature_names() == ["s_b"]
    assert encode.OneHotEncoder(top_n=2, drop="if_binary").fit(df).get_feature_names() == ["s_b"]
    assert encode.OneHotEncoder(top_n=None, drop="if_binary").fit(df).get_feature_names() == ["s_a", "s_b", "s_c"]
    assert "s_nan" in encode.OneHotEncoder(handle_missing="as_category").fit(df).get_feature_names()
    given = encode.OneHotEncoder(categories=[["x", "b"]], features_to_encode=["s"]).fit(df)
    assert given.get_feature_names() == ["s_x", "s_b"]
    strict = encode.OneHotEncoder(top_n=2, handle_unknown="error").fit(df)
    with pytest.raises(Exception, match="unknown category"):
        strict.transform(new).collect()
    for bad in ({"top_n": 3, "categories": [["a"]]}, {"handle_unknown": "x"}, {"handle_missing": "x"}, {"drop": "x"}):
        with pytest.raises(ValueError):
            encode.OneHotEncoder(**bad)
    with pytest.raises(ValueError):
        model.categories_of("t")


def test_target_encoder(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), (None, 2.0)], "s string, y double")
    model = encode.TargetEncoder(cols=["s"], target="y").fit(df)
    w = 1 / (1 + np.exp(-1))
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (4, None)], "i int, s string")
    got = {r["i"]: r["s"] for r in model.transform(new).collect()}
    assert got[1] == pytest.approx(4 * (1 - w) + 2 * w)
    assert got[2] == got[3] == got[4] == 4.0
    blank = encode.TargetEncoder(cols=["s"], target="y", handle_unknown="return_nan", handle_missing="return_nan").fit(df)
    got = {r["i"]: r["s"] for r in blank.transform(new).collect()}
    assert got[3] is None and got[4] is None and got[2] == 4.0
    strict = encode.TargetEncoder(cols=["s"], target="y", handle_unknown="error").fit(df)
    with pytest.raises(Exception, match="unknown value in s"):
        strict.transform(new).collect()
    model.write().overwrite().save(str(tmp_path / "te"))
    again = encode.TargetEncoderModel.load(str(tmp_path / "te"))
    assert sorted(map(str, again.transform(new).collect())) == sorted(map(str, model.transform(new).collect()))
    with pytest.raises(ValueError):
        encode.TargetEncoder(smoothing=0)


def test_scaler_keeps_constant_columns_finite(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    assert [tuple(r) for r in reduce.StandardScaler().fit(df).transform(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_date_parts(spark):
    df = spark.sql("SELECT timestamp_ntz'2021-01-03 13:05:00' AS t")
    assert DateTimeFeaturizer().transform(df).first().asDict() == {"t_year": 2021, "t_month": 0, "t_day_of_week": 0, "t_hour": 13}
    assert DateTimeFeaturizer().get_feature_names(["t"])["t_month"]["December"] == 11
    with pytest.raises(ValueError):
        DateTimeFeaturizer(features_to_extract=["minute"])


def test_delays(spark):
    df = spark.createDataFrame([(i, float(i), "xyx"[i % 3]) for i in range(5)], "t int, y double, s string")
    stage = timeseries.DelayedFeatureTransformer(order=["t"], features=["s"], target="y", max_delay=2, gap=1)
    out = {r["t"]: r for r in stage.transform(df).collect()}
    assert [out[t]["y_delay_0"] for t in range(5)] == [0, 1, 2, 3, 4]
    assert out[4]["y_delay_2"] == 2.0 and out[2]["s_delay_1"] == 1.0 and out[0]["s_delay_1"] is None
    assert "y_delay_0" not in timeseries.DelayedFeatureTransformer(order=["t"], target="y", gap=0).shifts()
    with pytest.raises(ValueError):
        timeseries.DelayedFeatureTransformer(features=["s"]).transform(df)


def test_detrend(spark):
    y = [3 + 2 * i - 0.1 * i * i + (i % 3) for i in range(40)]
    df = spark.createDataFrame(list(enumerate(y)), "t int, y double")
    model = timeseries.PolynomialDetrender(target="y", order=["t"], degree=2).fit(df)
    got = np.array([r["y"] for r in model.transform(df).orderBy("t").collect()])
    want = np.array(y) - np.polyval(np.polyfit(range(40), y, 2), range(40))
    assert np.allclose(got, want)
    back = [r["y"] for r in model.inverse_transform(model.transform(df)).orderBy("t").collect()]
    assert np.allclose(back, y)
    with pytest.raises(TypeError):
        timeseries.PolynomialDetrender(degree=1.5)
    with pytest.raises(ValueError):
        timeseries.PolynomialDetrender(order=["t"]).fit(df)


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(120, 4)) @ np.diag([5, 2, 1, 0.1])
    label = (x[:, 1] > 0).astype(int)
    x[:, 2] += 3 * label
    return x, label, spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, label)], "a double, b double, c double, d double, y int")


def test_pca_matches_numpy(cloud):
    x, _, df = cloud
    model = reduce.PCA(n_components=3, columns=list("abcd")).fit(df)
    got = np.array([[r[f"component_{i}"] for i in range(3)] for r in model.transform(df).collect()])
    centred = x - x.mean(0)
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose(np.var(got, axis=0, ddof=1), values[:3])
    assert np.allclose(model.learned["explained_variance_ratio"], values[:3] / values.sum())
    directions = np.array(model.learned["components"])
    assert np.allclose(directions @ directions.T, np.eye(3)) and np.allclose(got, centred @ directions.T)
    few = reduce.PCA(variance=0.8, columns=list("abcd")).fit(df)
    assert len(few.learned["components"]) == np.searchsorted(np.cumsum(values / values.sum()), 0.8) + 1
    with pytest.raises(ValueError):
        reduce.PCA().fit(df.withColumn("a", F.when(F.col("a") > 0, F.col("a"))))


def test_lda_separates_classes(cloud):
    x, label, df = cloud
    model = reduce.LinearDiscriminantAnalysis(target="y", columns=list("abcd")).fit(df)
    rows = model.transform(df).collect()
    got = np.array([r["component_0"] for r in rows])
    ratio = (got[label == 0].mean() - got[label == 1].mean()) ** 2 / (got[label == 0].var() + got[label == 1].var())
    best = max((x[label == 0, j].mean() - x[label == 1, j].mean()) ** 2 / (x[label == 0, j].var() + x[label == 1, j].var()) for j in range(4))
    assert ratio > best
    with pytest.raises(ValueError):
        reduce.LinearDiscriminantAnalysis(target="y", columns=list("abcd"), n_components=5).fit(df)


def test_lsa_matches_dense_svd(spark, tmp_path):
    docs = ["big red house with garden", "small red flat", "big house, big garden", "flat near station", "garden flat with red door", ""]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, t string")
    model = text.LSA(text_columns=["t"], key="id", iterations=30).fit(df)
    import re

    words = [re.findall(r"\b\w\w+\b", d.lower()) for d in docs]
    vocabulary = sorted({w for d in words for w in d})
    tf = np.array([[d.count(w) for w in vocabulary] for d in words], dtype=float)
    weighted = tf * (np.log((1 + len(docs)) / (1 + (tf > 0).sum(0))) + 1)
    norms = np.linalg.norm(weighted, axis=1, keepdims=True)
    unit = np.divide(weighted, norms, where=norms > 0, out=np.zeros_like(weighted))
    u, s, vt = np.linalg.svd(unit)
    got = {r["id"]: (r["LSA(t)[0]"], r["LSA(t)[1]"]) for r in model.transform(df).collect()}
    projected = np.array([got[i] for i in range(len(docs))])
    assert np.allclose(model.learned["singular_values"], s[:2], atol=1e-6)
    assert np.allclose(np.abs(projected), np.abs(unit @ vt[:2].T), atol=1e-4)
    model.write().save(str(tmp_path / "lsa"))
    again = text.LSAModel.load(str(tmp_path / "lsa")).transform(df)
    assert again.count() == len(docs)


def test_text_stats(spark):
    df = spark.createDataFrame([("A dog, a cat!",), ("",), ("...",), (None,)], "t string")
    got = text.TextFeaturizer(text_columns=["t"]).transform(df).collect()
    assert got[0][0] == 0.75 and got[0][1] == 2.0
    assert all(r[0] == 0 and r[1] == 0 for r in got[1:])
    with pytest.warns(RuntimeWarning):
        text.check_text_columns(df, ["t", "u"])
    with pytest.raises(AttributeError):
        text.check_text_columns(df, ["u"])


def test_selectors(spark):
    rng = np.random.default_rng(1)
    data = [(float(a), float(b), float(c), float(3 * a + 0.01 * b), int(a > 0)) for a, b, c in rng.normal(size=(200, 3))]
    df = spark.createDataFrame(data, "a double, b double, c double, y double, k int")
    model = select.RFRegressorSelectFromModel(columns=["a", "b", "c"], target="y", number_features=3).fit(df)
    assert model.get_names() == ["a"] and model.transform(df).columns == ["a", "y", "k"]
    cls = select.RFClassifierSelectFromModel(columns=["a", "b", "c"], target="k", threshold="mean").fit(df)
    assert cls.get_names() == ["a"]
    with pytest.raises(ValueError):
        select.importance_table(spark, ["a"], [1.0], -1)
    ranked = select.importance_table(spark, ["a", "b", "c"], [0.1, -0.5, 0.2], 0.15)
    assert [r["feature"] for r in ranked.collect()] == ["b", "c"]
    with pytest.raises(ValueError):
        select.DFSTransformer(index="nope").transform(df)


def test_chain_saves_and_loads(spark, rows, tmp_path):
    df = rows.withColumn("price", F.col("unit_indx") * 10.0)
    fitted = C.build_chain(df, "price", LinearRegression(labelCol="price", regParam=0.1), linear=True).fit(df)
    fitted.write().overwrite().save(str(tmp_path / "chain"))
    again = PipelineModel.load(str(tmp_path / "chain"))
    want = [r["prediction"] for r in fitted.transform(df).orderBy("unit_indx").collect()]
    assert [r["prediction"] for r in again.transform(df).orderBy("unit_indx").collect()] == pytest.approx(want)
    plain = C.features_only(fitted).transform(df)
    assert "prediction" not in plain.columns and "never" not in plain.columns
    assert C.provenance(again)["s"] == ["s_a", "s_b"]


def test_unfitted_stage_saves(tmp_path):
    stage = Pipeline(stages=[impute.Imputer(numeric_strategy="median")])
    stage.write().overwrite().save(str(tmp_path / "p"))
    assert Pipeline.load(str(tmp_path / "p")).getStages()[0].opt("numeric_strategy") == "median"


def test_lsa_moves_no_entries_and_is_the_same_in_any_chunks(spark, monkeypatch):
    words = ["tree", "house", "garden", "door", "red", "green", "lake", "town", "hill", "road", "wood", "stone"]
    rng = np.random.default_rng(6)
    docs = [(i, " ".join(rng.choice(words, int(rng.integers(1, 30))))) for i in range(90)]
    # Null, empty and repeated rows of one key: the latter are one text.
    df = spark.createDataFrame([*docs, (90, None), (91, ""), (92, "door"), (92, "lake lake")], "id long, t string")

    def scores():
        model = text.LSA(text_columns=["t"], key="id").fit(df)
        rows = model.transform(df).collect()
        other = model.transform(df.filter("id >= 0"))  # split anew
        assert np.allclose(sorted(tuple(r) for r in other.collect()), sorted(tuple(r) for r in rows))
        assert len(rows) == 94 and model.terms.count() == len(words)
        return model.learned["singular_values"], sorted(tuple(r) for r in rows)

    one = scores()
    for name, value in (("CHUNK_TEXTS", 20), ("BLOCK_TERMS", 5), ("_PIECE_TEXTS", 7)):
        monkeypatch.setattr(text, name, value)
    packed = text._packed(text._corpus(df, ["t"], "id"), 94).collect()
    chunks = {r["chunk"] for r in packed}
    assert len(chunks) == 5 and sum(r["terms"] is not None for r in packed) == 5
    assert sorted(int(i[2:]) for r in packed for i in r["ids"] or []) == [*range(90), 92]
    many = scores()
    assert np.allclose(one[0], many[0]) and np.allclose(one[1], many[1], atol=1e-9)
    assert one[1][-1] == one[1][-2] and [r[1:] for r in one[1] if r[0] in (90, 91)] == [(0.0, 0.0)] * 2
