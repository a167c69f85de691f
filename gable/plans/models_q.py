"""Queries for regression models, blending and prediction tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gable.operators import models as M
from gable.operators import splits
from gable.operators.metrics import regression_scores
from gable.operators.relational import fill_nulls
from gable.operators.select import importance_table
from gable.plans.property_view import UNITS_SQL, table, units, with_sql
from gable.plans.registry import query
from gable.runtime import scratch_path

FILL = {"area": -1.0, "floor_level": 0.0}
FEATURES = ["area", "heated_rooms", "floor_level"]
_FILLED = f"{UNITS_SQL}, filled AS (SELECT unit_indx, price_p, coalesce(area, -1.0) AS area FROM units)"


def _rows(spark, sf_dir):
    rows = units(spark, sf_dir).select("unit_indx", "price_p", *FEATURES)
    return fill_nulls(rows, FILL)


@query(
    "linear_fit",
    "H1 H6",
    with_sql(
        _FILLED,
        """SELECT unit_indx, round((SELECT regr_intercept(price_p, area) FROM filled) + (SELECT regr_slope(price_p, area) FROM filled) * area, 3)
        AS prediction FROM filled""",
    ),
)
def linear_fit(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    fitted = M.fit_cached(M.linear_regressor(["area"], "price_p"), rows)
    return fitted.transform(rows).select("unit_indx", F.round("prediction", 3).alias("prediction"))


@query(
    "linear_importance",
    "H7 G6 G8",
    with_sql(_FILLED, "SELECT 'area' AS feature, round(regr_slope(price_p, area), 6) AS importance FROM filled"),
)
def linear_importance(spark, sf_dir):
    fitted = M.fit_cached(M.linear_regressor(["area"], "price_p"), _rows(spark, sf_dir))
    out = M.feature_importance(spark, fitted, threshold=0.0)
    return out.select("feature", F.round("importance", 6).alias("importance"))


@query(
    "partitioned_predict",
    "H11 A11",
    with_sql(
        _FILLED,
        """SELECT unit_indx, round((SELECT regr_intercept(price_p, area) FROM filled) + (SELECT regr_slope(price_p, area) FROM filled) * area, 3)
        AS avm FROM filled""",
    ),
)
def partitioned_predict(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    fitted = M.fit_cached(M.linear_regressor(["area"], "price_p", prediction="avm"), rows)
    return M.partitioned_predict(fitted, rows, 8, "unit_indx").select("unit_indx", F.round("avm", 3).alias("avm"))


@query(
    "model_round_trip",
    "A12 H6 B15",
    with_sql(
        _FILLED,
        """SELECT unit_indx, round((SELECT regr_intercept(price_p, area) FROM filled) + (SELECT regr_slope(price_p, area) FROM filled) * area, 3)
        AS prediction FROM filled""",
    ),
)
def model_round_trip(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    path = scratch_path(spark, "model")
    M.fit_cached(M.linear_regressor(["area"], "price_p"), rows).write().save(path)
    return PipelineModel.load(path).transform(rows).select("unit_indx", F.round("prediction", 3).alias("prediction"))


@query(
    "partial_dependence",
    "H12",
    with_sql(
        _FILLED,
        """SELECT CAST(g AS DOUBLE) AS value, round(regr_intercept(price_p, area) + regr_slope(price_p, area) * g, 3) AS mean_prediction
        FROM filled, (SELECT unnest([10, 50, 100, 200]) AS g) GROUP BY g""",
    ),
)
def partial_dependence(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    fitted = M.fit_cached(M.linear_regressor(["area"], "price_p"), rows)
    out = M.partial_dependence(fitted, rows, "area", [10, 50, 100, 200])
    return out.withColumn("mean_prediction", F.round("mean_prediction", 3))


@query("mean_baseline", "H8", with_sql(UNITS_SQL, "SELECT unit_indx, round((SELECT avg(price_p) FROM units), 4) AS prediction FROM units"))
def mean_baseline(spark, sf_dir):
    rows = units(spark, sf_dir).select("unit_indx", "price_p")
    out = M.MeanBaseline(label="price_p").fit(rows).transform(rows)
    return out.select("unit_indx", F.round("prediction", 4).alias("prediction"))


@query(
    "last_value_baseline",
    "H8 G2",
    "SELECT event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prediction FROM events",
)
def last_value_baseline(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    out = M.last_value_baseline(
        rows, ["ts", "event_id"], "value", ["user_id"]
    )
    return out.select("event_id", "value", "prediction")


@query(
    "lead_target",
    "G3 H9",
    "SELECT event_id, lead(value, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS future FROM events",
)
def lead_target(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return M.shifted(rows, ["ts", "event_id"], {"future": ("value", -2)}, ["user_id"]).select("event_id", "future")


@query(
    "ts_regression",
    "H9",
    """WITH f AS (SELECT event_id, value, lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS future FROM events),
    m AS (SELECT regr_slope(future, value) AS a, regr_intercept(future, value) AS b FROM f)
    SELECT event_id, round(b + a * value, 5) AS prediction FROM f, m""",
)
def ts_regression(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    model = M.TimeSeriesRegressor(
        lambda cols, label: M.linear_regressor(cols, label), ["ts", "event_id"], "value", series=["user_id"],
        gap=1, max_delay=0,
    )
    out = model.fit(rows).transform(rows)
    return out.select("event_id", F.round("prediction", 5).alias("prediction"))


@query(
    "ts_regression_delays",
    "H9 A12",
    """WITH f AS (SELECT event_id, value AS a, lag(value) OVER w AS b, lead(value) OVER w AS y FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    c AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay,
      covar_pop(b, y) AS byy FROM f WHERE a IS NOT NULL AND b IS NOT NULL AND y IS NOT NULL),
    m AS (SELECT (ay * bb - byy * ab) / (aa * bb - ab * ab) AS p, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS q, ma, mb, my FROM c)
    SELECT event_id, round(my + p * (a - ma) + q * (b - mb), 5) AS prediction FROM f, m""",
)
def ts_regression_delays(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    model = M.TimeSeriesRegressor(M.linear_regressor, ["ts", "event_id"], "value", series=["user_id"], gap=1, max_delay=1).fit(rows)
    path = scratch_path(spark, "series")
    model.write().save(path)
    out = M.TimeSeriesModel.load(path).transform(rows)
    return out.select("event_id", F.round("prediction", 5).alias("prediction"))


@query(
    "knn_predict",
    "H3",
    """WITH s AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('0|' || CAST(vec_id AS VARCHAR)), vec_id)
      <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM embeddings),
    d AS (SELECT q.vec_id, t.vec_id AS nb, t.label, list_distance(CAST(q.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])) AS dist
      FROM s q JOIN s t ON q.split = 'test' AND t.split = 'train'),
    k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, nb) <= 5)
    SELECT vec_id, round(CASE WHEN min(dist) = 0 THEN avg(CASE WHEN dist = 0 THEN label END)
      ELSE sum(label / dist) / sum(1 / dist) END, 6) AS prediction FROM k GROUP BY vec_id""",
)
def knn_predict(spark, sf_dir):
    rows = splits.split_by_key(table(spark, sf_dir, "embeddings"), "vec_id", 0.2)
    model = M.KNeighborsRegressor(features="embedding", label="label", key="vec_id").fit(rows.filter("split = 'train'"))
    out = model.transform(rows.filter("split = 'test'"))
    return out.select("vec_id", F.round("prediction", 6).alias("prediction"))


@query(
    "knn_property",
    "H3",
    with_sql(
        UNITS_SQL,
        """SELECT unit_indx, price_p, round(CASE WHEN min(dist) = 0 THEN avg(CASE WHEN dist = 0 THEN y END)
      ELSE sum(y / dist) / sum(1 / dist) END, 4) AS prediction
    FROM (
      SELECT q.unit_indx, q.price_p, t.price_p AS y, sqrt((q.a - t.a) * (q.a - t.a) + (q.r - t.r) * (q.r - t.r) + (q.f - t.f) * (q.f - t.f)) AS dist
      FROM split_rows q JOIN split_rows t ON NOT q.train AND t.train
      QUALIFY row_number() OVER (PARTITION BY q.unit_indx ORDER BY dist, t.unit_indx) <= 5
    ) GROUP BY unit_indx, price_p""".replace(
            "split_rows",
            """(SELECT unit_indx, price_p, coalesce(area, -1.0) AS a, heated_rooms AS r, coalesce(floor_level, 0.0) AS f,
          row_number() OVER (ORDER BY md5('0|' || unit_indx), unit_indx) > ceil(0.2 * count(*) OVER ()) AS train FROM units)""",
        ),
    ),
)
def knn_property(spark, sf_dir):
    rows = splits.split_by_key(_rows(spark, sf_dir), "unit_indx", 0.2)
    model = M.knn_regressor(FEATURES, "price_p").fit(rows.filter("split = 'train'"))
    out = model.transform(rows.filter("split = 'test'"))
    return out.select("unit_indx", "price_p", F.round("prediction", 4).alias("prediction"))


@query("gbt_predict", "H2 H7")
def gbt_predict(spark, sf_dir):
    rows = splits.split_by_key(_rows(spark, sf_dir), "unit_indx", 0.2)
    trees = M.tree_regressor(FEATURES, "price_p", n_estimators=8, max_depth=4, learning_rate=0.3)
    fitted = M.fit_cached(trees, rows.filter("split = 'train'"))
    return fitted.transform(rows.filter("split = 'test'")).select("unit_indx", "price_p", "prediction")


def _bases():
    return {
        "trees": M.tree_regressor(FEATURES, "price_p", "trees", n_estimators=4, max_depth=4, learning_rate=0.3),
        "forest": M.forest_regressor(FEATURES, "price_p", "forest", n_estimators=8),
        "linear": M.linear_regressor(FEATURES, "price_p", "linear"),
    }


@query("blend_predict", "H4 E6")
def blend_predict(spark, sf_dir):
    rows = splits.split_by_key(_rows(spark, sf_dir), "unit_indx", 0.2)
    blend = M.Blend(_bases(), M.linear_regressor(list(_bases()), "price_p", "avm"), "unit_indx", mode="in_sample")
    return blend.fit(rows.filter("split = 'train'")).transform(rows.filter("split = 'test'"))


@query("stacked_oof", "H5 I6")
def stacked_oof(spark, sf_dir):
    rows = splits.split_by_key(_rows(spark, sf_dir), "unit_indx", 0.2)
    bases = {n: b for n, b in _bases().items() if n != "forest"}
    stacked = M.stacked_regressor(bases, "price_p", "unit_indx", prediction="avm")
    return stacked.fit(rows.filter("split = 'train'")).transform(rows.filter("split = 'test'"))


@query("search_best", "H10 G5")
def search_best(spark, sf_dir):
    forest = M.RandomForestRegressor(featuresCol="features", labelCol="price_p", seed=0)
    chain = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest])
    points = M.random_grid({forest.maxDepth: [2, 4, 6], forest.numTrees: [4, 8]}, trials=3, seed=1)
    _, trials = M.search(_rows(spark, sf_dir), chain, points, "MdAPE", "price_p", key="unit_indx")
    return trials


@query("model_scores", "H2 H8 J42")
def model_scores(spark, sf_dir):
    rows = splits.split_by_key(_rows(spark, sf_dir), "unit_indx", 0.2)
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    base = M.MeanBaseline(label="price_p", prediction="baseline").fit(train)
    fitted = M.fit_cached(M.forest_regressor(FEATURES, "price_p", "avm"), train)
    scored = base.transform(fitted.transform(test))
    out = None
    for name in ("avm", "baseline"):
        one = regression_scores(scored, "price_p", name, ["MAPE", "MdAPE", "MAE", "R2"])
        one = one.select(F.lit(name).alias("model"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("class_probabilities", "H14 J39")
def class_probabilities(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", F.log1p("n_chars").alias("size"))
    rows = VectorAssembler(inputCols=["size"], outputCol="features").transform(table(spark, sf_dir, "labels").join(documents, "doc_id"))
    fitted = LogisticRegression(labelCol="quality", maxIter=20).fit(rows)
    proba = vector_to_array("probability")[1]
    return fitted.transform(rows).select("doc_id", "quality", proba.alias("proba"), (proba > 0.5).cast("int").alias("decision"))


@query(
    "importance_ranking",
    "G6 G8",
    with_sql(
        f"{UNITS_SQL}, c AS (SELECT corr(price_p, coalesce(area, -1.0)) AS area, corr(price_p, heated_rooms) AS heated_rooms FROM units)",
        """SELECT feature, round(importance, 6) AS importance FROM (SELECT 'area' AS feature, area AS importance FROM c
        UNION ALL SELECT 'heated_rooms', heated_rooms FROM c) WHERE abs(importance) >= 0.000001""",
    ),
)
def importance_ranking(spark, sf_dir):
    row = _rows(spark, sf_dir).agg(F.corr("price_p", "area").alias("area"), F.corr("price_p", "heated_rooms").alias("heated_rooms")).first()
    out = importance_table(spark, ["area", "heated_rooms"], [row["area"], row["heated_rooms"]], 0.000001)
    return out.select("feature", F.round("importance", 6).alias("importance"))
