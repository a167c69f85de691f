"""Queries for the fitted feature stages."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from gable.functions import domain as D
from gable.operators import chain as C
from gable.operators import encode, impute, reduce, select, text, timeseries
from gable.operators.dates import DateTimeFeaturizer
from gable.operators.profile import literal_rows
from gable.plans.property_view import UNITS_SQL, table, units, with_sql
from gable.plans.registry import query


def _round(df, digits=6):
    return df.withColumns({f"`{c}`" if "(" in c else c: F.round(F.col(f"`{c}`"), digits) for c, t in df.dtypes if t == "double"})


# ---- imputation -------------------------------------------------------------------------------------
_MODE = "(SELECT {c} FROM units WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
_COLS = ["unit_indx", "area", "rooms", "floor_level", "floor_label"]


def _impute_sql(numeric, categorical):
    def fill(c):
        return {"mode": _MODE.format(c=c)}.get(numeric, f"(SELECT {numeric}({c}) FROM units)") if numeric != "zero" else "0"

    cast = "CAST({c} AS DOUBLE)" if numeric in ("avg", "median") else "{c}"
    parts = [f"coalesce({cast.format(c=c)}, {fill(c)})" for c in ("area", "rooms", "floor_level")]
    if numeric in ("avg", "median"):
        parts = [f"round({p}, 6)" for p in parts]
    label = _MODE.format(c="floor_label") if categorical == "mode" else "'missing_value'"
    return with_sql(
        UNITS_SQL,
        f"SELECT unit_indx, {parts[0]} AS area, {parts[1]} AS rooms, {parts[2]} AS floor_level, "
        f"coalesce(floor_label, {label}) AS floor_label FROM units",
    )


def _imputed(spark, sf_dir, stage):
    rows = units(spark, sf_dir).select(*_COLS).withColumn("never", F.lit(None).cast("double"))
    return _round(stage.fit(rows).transform(rows))


@query("impute_mean", "D1", _impute_sql("avg", "mode"))
def impute_mean(spark, sf_dir):
    return _imputed(spark, sf_dir, impute.Imputer(numeric_strategy="mean"))


@query("impute_median", "D1", _impute_sql("median", "constant"))
def impute_median(spark, sf_dir):
    stage = impute.Imputer(
        numeric_strategy="median", categorical_strategy="constant"
    )
    return _imputed(spark, sf_dir, stage)


@query("impute_mode", "D2", _impute_sql("mode", "mode"))
def impute_mode(spark, sf_dir):
    return _imputed(spark, sf_dir, impute.SimpleImputer(strategy="most_frequent"))


@query("impute_constant", "D2", _impute_sql("zero", "constant"))
def impute_constant(spark, sf_dir):
    return _imputed(spark, sf_dir, impute.SimpleImputer(strategy="constant"))


@query(
    "impute_per_column",
    "D3",
    with_sql(
        UNITS_SQL,
        f"""SELECT unit_indx, round(coalesce(area, (SELECT median(area) FROM units)), 6) AS area, coalesce(rooms, 7) AS rooms,
        coalesce(floor_level, {_MODE.format(c='floor_level')}) AS floor_level,
        coalesce(floor_label, 'none') AS floor_label FROM units""",
    ),
)
def impute_per_column(spark, sf_dir):
    strategies = {
        "area": {"impute_strategy": "median"},
        "rooms": {"impute_strategy": "constant", "fill_value": 7},
        "floor_label": {"impute_strategy": "constant", "fill_value": "none"},
    }
    stage = impute.PerColumnImputer(impute_strategies=strategies)
    return _imputed(spark, sf_dir, stage)


# ---- encoding -----------------------------------------------------------------------------------------
_TOP = "top AS (SELECT p_brand AS category FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 10)"


def _one_hot(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return rows, encode.OneHotEncoder(top_n=10, features_to_encode=["p_brand"]).fit(rows)


@query(
    "onehot_topn",
    "D4 G4",
    with_sql(
        _TOP,
        """SELECT p_partkey, 'p_brand_' || category AS feature, CASE WHEN p_brand = category THEN 1.0::DOUBLE ELSE 0.0 END AS value
        FROM part, top""",
    ),
)
def onehot_topn(spark, sf_dir):
    rows, model = _one_hot(spark, sf_dir)
    return model.transform(rows).unpivot("p_partkey", model.get_feature_names(), "feature", "value")


@query("onehot_categories", "D5", with_sql(_TOP, "SELECT 'p_brand' AS feature, category FROM top"))
def onehot_categories(spark, sf_dir):
    _, model = _one_hot(spark, sf_dir)
    return literal_rows(spark, [("p_brand", c) for c in model.categories_of("p_brand")], ["feature", "category"])


@query(
    "target_encode",
    "D6",
    with_sql(
        UNITS_SQL
        + """, stats AS (SELECT postcode, count(*) AS n, avg(price_p) AS m FROM units GROUP BY postcode),
        prior AS (SELECT avg(price_p) AS p FROM units),
        enc AS (SELECT postcode, CASE WHEN n = 1 THEN p ELSE p * (1 - 1 / (1 + exp(-(n - 1) / 10.0::DOUBLE)))
          + m * (1 / (1 + exp(-(n - 1) / 10.0::DOUBLE))) END AS e FROM stats, prior)""",
        "SELECT unit_indx, round(e, 4) AS postcode FROM units u JOIN enc ON u.postcode = enc.postcode",
    ),
)
def target_encode(spark, sf_dir):
    rows = units(spark, sf_dir).select("unit_indx", "postcode", "price_p")
    stage = encode.TargetEncoder(
        cols=["postcode"], target="price_p", smoothing=10.0
    )
    return stage.fit(rows).transform(rows).select("unit_indx", F.round("postcode", 4).alias("postcode"))


@query(
    "standard_scale",
    "D7",
    with_sql(
        UNITS_SQL,
        """SELECT unit_indx, round((area - avg(area) OVER ()) / stddev_pop(area) OVER (), 6) AS area,
        round((price_p - avg(price_p) OVER ()) / stddev_pop(price_p) OVER (), 6) AS price_p FROM units""",
    ),
)
def standard_scale(spark, sf_dir):
    rows = units(spark, sf_dir).select("unit_indx", "area", "price_p")
    return _round(reduce.StandardScaler(columns=["area", "price_p"]).fit(rows).transform(rows))


@query(
    "date_parts",
    "D8",
    """SELECT event_id, year(ts)::INTEGER AS ts_year, (month(ts) - 1)::INTEGER AS ts_month,
    dayofweek(ts)::INTEGER AS ts_day_of_week, hour(ts)::INTEGER AS ts_hour
    FROM events""",
)
def date_parts(spark, sf_dir):
    return DateTimeFeaturizer().transform(table(spark, sf_dir, "events").select("event_id", "ts"))


# ---- time series ----------------------------------------------------------------------------------------
@query(
    "lag_features",
    "D9 G2",
    """WITH codes AS (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) - 1 AS DOUBLE) AS code
      FROM (SELECT DISTINCT event_type FROM events))
    SELECT event_id, user_id, ts, value, e.event_type,
    lag(value, 1) OVER w AS value_delay_1, lag(value, 2) OVER w AS value_delay_2,
    lag(code, 1) OVER w AS event_type_delay_1, lag(code, 2) OVER w AS event_type_delay_2
    FROM events e JOIN codes c ON e.event_type = c.event_type WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def lag_features(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", "event_type")
    stage = timeseries.DelayedFeatureTransformer(
        order=["ts", "event_id"],
        series=["user_id"],
        features=["value", "event_type"],
    )
    return stage.transform(rows)


@query(
    "lag_whole_table",
    "D9 G2 G3",
    """SELECT event_id, lag(value, 1) OVER w AS earlier, lag(value, 3) OVER w AS much_earlier, lead(value, 2) OVER w AS later
    FROM events WINDOW w AS (ORDER BY ts, event_id)""",
)
def lag_whole_table(spark, sf_dir):
    # One series of all rows: always cut into chunks of positions, as a series too long for a task is.
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    shifts = {"earlier": ("value", 1), "much_earlier": ("value", 3), "later": ("value", -2)}
    out = timeseries.shifted(rows, ["ts", "event_id"], shifts, chunk_rows=1000)
    return out.select("event_id", *shifts)


@query(
    "detrend_deg1",
    "D10",
    """WITH p AS (SELECT event_id, value, row_number() OVER (ORDER BY ts, event_id) - 1 AS t FROM events)
    SELECT event_id, round(value - (regr_intercept(value, t) OVER () + regr_slope(value, t) OVER () * t), 6) AS value FROM p"""
    .replace("regr_intercept(value, t) OVER ()", "(SELECT regr_intercept(value, t) FROM p)")
    .replace("regr_slope(value, t) OVER ()", "(SELECT regr_slope(value, t) FROM p)"),
)
def detrend_deg1(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    model = timeseries.PolynomialDetrender(target="value", order=["ts", "event_id"]).fit(rows)
    return _round(model.transform(rows).select("event_id", "value"))


_DEG2 = """WITH p AS (SELECT event_id, value AS y, (row_number() OVER (ORDER BY ts, event_id) - 1) / CAST(count(*) OVER () - 1 AS DOUBLE) AS u
  FROM events),
s AS (SELECT CAST(count(*) AS DOUBLE) AS s0, sum(u) AS s1, sum(u*u) AS s2, sum(u*u*u) AS s3, sum(u*u*u*u) AS s4,
  sum(y) AS v0, sum(u*y) AS v1, sum(u*u*y) AS v2 FROM p),
d AS (SELECT *, s0*(s2*s4-s3*s3) - s1*(s1*s4-s3*s2) + s2*(s1*s3-s2*s2) AS det FROM s),
c AS (SELECT (v0*(s2*s4-s3*s3) - s1*(v1*s4-s3*v2) + s2*(v1*s3-s2*v2)) / det AS a0,
  (s0*(v1*s4-v2*s3) - v0*(s1*s4-s3*s2) + s2*(s1*v2-v1*s2)) / det AS a1,
  (s0*(s2*v2-s3*v1) - s1*(s1*v2-v1*s2) + v0*(s1*s3-s2*s2)) / det AS a2 FROM d)
SELECT event_id, round(y - (a0 + a1*u + a2*u*u), 4) AS value FROM p, c"""


@query("detrend_deg2", "D10", _DEG2)
def detrend_deg2(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    model = timeseries.PolynomialDetrender(target="value", order=["ts", "event_id"], degree=2).fit(rows)
    return _round(model.transform(rows).select("event_id", "value"), 4)


@query("detrend_inverse", "D10", "SELECT event_id, round(value, 6) AS value FROM events")
def detrend_inverse(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    model = timeseries.PolynomialDetrender(target="value", order=["ts", "event_id"], degree=3).fit(rows)
    return _round(model.inverse_transform(model.transform(rows)).select("event_id", "value"))


# ---- text -------------------------------------------------------------------------------------------------
_PUNCT = D.PUNCTUATION.replace("'", "''")
_WORDS = f"[x for x in regexp_split_to_array(lower(translate(text, '{_PUNCT}', '')), '\\s+') if length(x) > 0]"


@query(
    "text_stats",
    "D14 D15 C15",
    f"""WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents)
    SELECT doc_id, round(CASE WHEN len(ws) = 0 THEN 0.0 ELSE CAST(list_unique(ws) AS DOUBLE) / len(ws) END, 9) AS "DIVERSITY_SCORE(text)",
    round(CASE WHEN len(ws) = 0 THEN 0.0 ELSE CAST(list_sum([length(x) for x in ws]) AS DOUBLE) / len(ws) END, 9)
      AS "MEAN_CHARACTERS_PER_WORD(text)" FROM w""",
)
def text_stats(spark, sf_dir):
    rows = text.TextFeaturizer(text_columns=["text"]).transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", *[F.round(F.col(f"`{c}`"), 9).alias(c) for c in rows.columns if c != "doc_id"]
    )


# A small lexicon of words that the documents use, with whole-number scores: their sums are exact in any order.
_LEXICON = [("the", 1), ("of", -1), ("and", 2), ("in", -3), ("to", 4), ("le", -5), ("und", 6), ("de", -7)]


@query(
    "text_polarity",
    "D14",
    f"""WITH lexicon AS (SELECT * FROM (VALUES {', '.join(f"('{w}', {s}::DOUBLE)" for w, s in _LEXICON)}) t(word, score)),
    w AS (SELECT doc_id, unnest({_WORDS}) AS word FROM documents),
    p AS (SELECT doc_id, avg(score) AS polarity FROM w JOIN lexicon USING (word) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(polarity, 0.0::DOUBLE) AS polarity FROM documents d LEFT JOIN p ON d.doc_id = p.doc_id""",
)
def text_polarity(spark, sf_dir):
    lexicon = literal_rows(spark, _LEXICON, ["word", "score"])
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    # A word occurs at most once per document after counting, so no key exceeds the number of documents.
    return text.polarity(rows, "doc_id", "text", lexicon)


@query("lsa", "D13")
def lsa(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.LSA(text_columns=["text"], key="doc_id").fit(rows).transform(rows)


@query(
    "auto_features",
    "D16",
    """SELECT event_id, user_id, value, day(ts)::INTEGER AS "DAY(ts)", month(ts)::INTEGER AS "MONTH(ts)", (isodow(ts) - 1)::INTEGER AS "WEEKDAY(ts)",
    year(ts)::INTEGER AS "YEAR(ts)", length(props)::INTEGER AS "NUM_CHARACTERS(props)", len(string_split(props, ' '))::INTEGER AS "NUM_WORDS(props)",
    round(2 * 3958.7613 * asin(sqrt(pow(sin(radians(51.5 - lat) / 2), 2)
      + cos(radians(lat)) * cos(radians(51.5)) * pow(sin(radians(-0.12 - lon) / 2), 2))), 6) AS "HAVERSINE(lat, home_lat)"
    FROM (SELECT *, 51.0 + user_id / 100.0::DOUBLE AS lat, -0.5 + user_id / 200.0::DOUBLE AS lon FROM events)""",
)
def auto_features(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts", "props").withColumns(
        {
            "lat": 51.0 + F.col("user_id") / 100.0,
            "lon": -0.5 + F.col("user_id") / 200.0,
            "home_lat": F.lit(51.5),
            "home_lon": F.lit(-0.12),
        }
    )
    stage = select.DFSTransformer(
        index="event_id", text_columns=["props"], places=[["lat", "lon"], ["home_lat", "home_lon"]]
    )
    out = stage.transform(rows).drop("lat", "lon", "home_lat", "home_lon")
    return out.withColumn("HAVERSINE(lat, home_lat)", F.round(F.col("`HAVERSINE(lat, home_lat)`"), 6))


# ---- reduction and selection -----------------------------------------------------------------------------------
def _vectors(spark, sf_dir):
    return reduce.spread_array(table(spark, sf_dir, "embeddings"), "embedding", 64, "e")


_E64 = [f"e{i}" for i in range(64)]


@query("pca", "D11")
def pca(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    return reduce.PCA(variance=0.95, columns=_E64).fit(rows).transform(rows)


@query("lda", "D12")
def lda(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    return reduce.LinearDiscriminantAnalysis(n_components=3, target="label", columns=_E64).fit(rows).transform(rows)


def _model_rows(spark, sf_dir):
    return units(spark, sf_dir).select("unit_indx", "price_p", "area", "heated_rooms", "floor_level", "property_type").na.fill(0.0)


@query("rf_select_reg", "D17 D19")
def rf_select_reg(spark, sf_dir):
    rows = _model_rows(spark, sf_dir)
    stage = select.RFRegressorSelectFromModel(
        columns=["area", "heated_rooms", "floor_level"], target="price_p", number_features=4
    )
    return stage.fit(rows).transform(rows)


@query("rf_select_cls", "D18 D19")
def rf_select_cls(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    stage = select.RFClassifierSelectFromModel(columns=_E64, target="label", threshold="mean")
    return stage.fit(rows).transform(rows)


# ---- chains ------------------------------------------------------------------------------------------------------
def _chain(spark, sf_dir):
    rows = units(spark, sf_dir).select("unit_indx", "price_p", "area", "floor_level", "sold_at", "property_type")
    estimator = LinearRegression(labelCol="price_p", solver="normal")
    return rows, C.build_chain(rows, "price_p", estimator).fit(rows)


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "chain_features",
    "D21 D23 H6",
    with_sql(
        UNITS_SQL,
        "SELECT unit_indx, price_p, round(coalesce(area, (SELECT avg(area) FROM units)), 6) AS area, "
        "round(coalesce(floor_level, (SELECT avg(floor_level) FROM units)), 6) AS floor_level, "
        "year(sold_at)::INTEGER AS sold_at_year, (month(sold_at) - 1)::INTEGER AS sold_at_month, "
        "dayofweek(sold_at)::INTEGER AS sold_at_day_of_week, hour(sold_at)::INTEGER AS sold_at_hour, "
        + ", ".join(f"CASE WHEN property_type = '{s}' THEN 1.0::DOUBLE ELSE 0.0 END AS property_type_{s}" for s in _SEGMENTS)
        + " FROM units",
    ),
)
def chain_features(spark, sf_dir):
    rows, fitted = _chain(spark, sf_dir)
    return _round(C.features_only(fitted).transform(rows).drop("features"))


@query(
    "feature_provenance",
    "D22",
    with_sql(
        UNITS_SQL,
        """SELECT 'property_type' AS source, 'property_type_' || property_type AS derived FROM (SELECT DISTINCT property_type FROM units)
        UNION ALL SELECT 'sold_at', 'sold_at_' || unnest(['year', 'month', 'day_of_week', 'hour'])
        UNION ALL SELECT * FROM (VALUES ('area', 'area'), ('floor_level', 'floor_level')) t(a, b)""",
    ),
)
def feature_provenance(spark, sf_dir):
    _, fitted = _chain(spark, sf_dir)
    return C.provenance_table(spark, fitted)
