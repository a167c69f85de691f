"""Queries for metrics, on the group-mean valuation and on deterministic class scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from gable.operators import metrics as M
from gable.operators.models import MeanBaseline
from gable.plans.property_view import VALUED_SQL, table, valued_units, with_sql
from gable.plans.registry import query

_APE = "abs((price_p - avm) / price_p)"


def _round(df, digits):
    """Round columns by the given digits (6 where a column is not named)."""
    return df.withColumns({c: F.round(c, digits.get(c, 6)) for c, t in df.dtypes if t == "double"})


_REGRESSION_SQL = f"""SELECT round(avg({_APE}) * 100, 6) AS mape, round(median({_APE}) * 100, 6) AS mdape,
  round(avg({_APE}) * 100, 6) AS mean_absolute_percentage_error, round(avg(abs(price_p - avm)), 4) AS mae,
  round(avg(pow(price_p - avm, 2)), 0) AS mse, round(sqrt(avg(pow(price_p - avm, 2))), 4) AS root_mean_squared_error,
  round(median(abs(price_p - avm)), 4) AS medianae, round(max(abs(price_p - avm)), 4) AS maxerror,
  round(avg(pow(ln(1 + price_p) - ln(1 + avm), 2)), 6) AS mean_squared_log_error,
  round(sqrt(avg(pow(ln(1 + price_p) - ln(1 + avm), 2))), 6) AS root_mean_squared_log_error,
  round(1 - avg(pow(price_p - avm, 2)) / var_pop(price_p), 6) AS r2,
  round(1 - var_pop(price_p - avm) / var_pop(price_p), 6) AS expvariance"""


@query(
    "metric_regression_all",
    "J1 J2 J3 J4 J5 J6 J7 J8 J9 J10 J11 J12 J42 J43 J44",
    with_sql(VALUED_SQL, f"{_REGRESSION_SQL} FROM valued"),
)
def metric_regression_all(spark, sf_dir):
    names = [m.name for m in M.core_metrics("time series regression")]
    scores, _ = M.score(valued_units(spark, sf_dir), "price_p", "avm", names)
    return _round(scores, {"mae": 4, "mse": 0, "root_mean_squared_error": 4, "medianae": 4, "maxerror": 4})


@query(
    "metric_regression_by_key",
    "J42",
    with_sql(VALUED_SQL, f"""SELECT key, round(avg({_APE}) * 100, 6) AS mape, round(median({_APE}) * 100, 6) AS mdape,
    round(avg(abs(price_p - avm)), 4) AS mae FROM valued GROUP BY key"""),
)
def metric_regression_by_key(spark, sf_dir):
    rows = valued_units(spark, sf_dir)
    scores = M.regression_scores(rows, "price_p", "avm", ["MAPE", "MdAPE", "MAE"], ["key"])
    return _round(scores, {"mae": 4})


@query(
    "metric_violations",
    "J44",
    with_sql(
        VALUED_SQL,
        """SELECT count(*) AS n_rows, count(*) - count(price_p) AS bad_truth, count(*) - count(area) AS bad_prediction,
        0::BIGINT AS outside_unit, count(*) FILTER (price_p = 0) AS zero_truth,
        count(*) FILTER (price_p < 0 OR area < 0) AS negative FROM valued""",
    ),
)
def metric_violations(spark, sf_dir):
    return M.violations(valued_units(spark, sf_dir), "price_p", "area")


_DIFF = """CASE WHEN {s} IS NULL OR {b} IS NULL THEN NULL WHEN abs({b} - {s}) < 1e-10 THEN 0.0
  WHEN ({b} - {s}) {worse} 0 THEN -100 * abs({change}) ELSE 100 * abs({change}) END"""


def _diff(s, b, worse, bounded):
    change = f"({b} - {s})" if bounded else f"(({b} - {s}) / {b})"
    return _DIFF.format(s=s, b=b, worse=worse, change=change)


@query(
    "percent_difference",
    "J41 H8",
    with_sql(
        VALUED_SQL
        + f""", based AS (SELECT *, (SELECT avg(price_p) FROM units) AS base FROM valued),
        s AS (SELECT avg({_APE}) * 100 AS mape, avg(abs((price_p - base) / price_p)) * 100 AS mape_base,
          avg(abs(price_p - avm)) AS mae, avg(abs(price_p - base)) AS mae_base FROM based)""",
        f"""SELECT round({_diff('mape', 'mape_base', '<', False)}, 6) AS mape_change,
        round({_diff('mae', 'mae_base', '<', True)}, 2) AS mae_change FROM s""",
    ),
)
def percent_difference(spark, sf_dir):
    rows = valued_units(spark, sf_dir)
    rows = MeanBaseline(label="price_p", prediction="base").fit(rows).transform(rows)
    ours, theirs = (M.regression_aggregates("price_p", p) for p in ("avm", "base"))
    both = rows.agg(
        *[ours[m].alias(m) for m in ("mape", "mae")], *[theirs[m].alias(f"{m}_base") for m in ("mape", "mae")]
    )
    return both.select(
        F.round(M.percent_difference("MAPE", F.col("mape"), F.col("mape_base")), 6).alias("mape_change"),
        F.round(M.percent_difference("MAE", F.col("mae"), F.col("mae_base")), 2).alias("mae_change"),
    )


_BAND_CASES = " UNION ALL ".join(
    f"SELECT '{label}' AS band, {lo} AS lo, {hi} AS hi"
    for label, lo, hi in zip(
        M.BAND_LABELS,
        ["-1e18", *[str(k * M.BAND_STEP) for k in range(1, 9)]],
        [*[str(k * M.BAND_STEP) for k in range(1, 9)], "1e18"],
    )
)
_WITHIN = ", ".join(
    f"round(avg(CASE WHEN abs((avm - price_p) / price_p) < {x / 100} THEN 1.0 ELSE 0.0 END), 6) AS within_{x}" for x in M.ERROR_LIMITS
)


@query(
    "price_bands",
    "J45",
    with_sql(
        f"{VALUED_SQL}, bands AS ({_BAND_CASES})",
        f"""SELECT band, count(*) AS n, {_WITHIN} FROM valued JOIN bands ON price_p BETWEEN lo AND hi
        GROUP BY band HAVING count(*) > 5""",
    ),
)
def price_bands(spark, sf_dir):
    return _round(M.accuracy_by_price_band(valued_units(spark, sf_dir), "price_p", "avm"), {})


@query(
    "misvalued",
    "J46",
    with_sql(
        VALUED_SQL,
        """SELECT unit_indx, round((avm - price_p) / price_p, 9) AS percent_error,
        abs((avm - price_p) / price_p) < 0.2 AS well_valued, abs((avm - price_p) / price_p) >= 0.2 AS badly_valued,
        (avm - price_p) / price_p < -0.2 AS undervalued, (avm - price_p) / price_p > 0.2 AS overvalued FROM valued""",
    ),
)
def misvalued(spark, sf_dir):
    rows = M.misvaluation(valued_units(spark, sf_dir), "price_p", "avm")
    return rows.select(
        "unit_indx", F.round("percent_error", 9).alias("percent_error"), "well_valued", "badly_valued", "undervalued", "overvalued"
    )


@query(
    "prediction_outliers",
    "H13",
    with_sql(VALUED_SQL, "SELECT unit_indx, price_p, round(avm, 4) AS avm, abs(avm - price_p) >= 50000 AS outlier FROM valued"),
)
def prediction_outliers(spark, sf_dir):
    rows = M.prediction_vs_actual(valued_units(spark, sf_dir), "price_p", "avm", 50000)
    return rows.select("unit_indx", "price_p", F.round("avm", 4).alias("avm"), "outlier")


# ---- binary: quality of a document, scored by its length ---------------------------------------------------
_BINARY_SQL = """scored AS (SELECT d.doc_id, quality AS y, CAST(n_chars AS DOUBLE) / (n_chars + 1000) AS score, n_chars AS amount,
  CASE WHEN CAST(n_chars AS DOUBLE) / (n_chars + 1000) > 0.5 THEN 1 ELSE 0 END AS d
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
cells AS (SELECT CAST(count(*) FILTER (y = 1 AND d = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (y = 0 AND d = 1) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (y = 1 AND d = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (y = 0 AND d = 0) AS DOUBLE) AS tn FROM scored)"""


def _scored(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    rows = table(spark, sf_dir, "labels").join(documents, "doc_id")
    score = F.col("n_chars").cast("double") / (F.col("n_chars") + 1000)
    rows = rows.select("doc_id", F.col("quality").alias("y"), score.alias("score"), F.col("n_chars").alias("amount"))
    return rows.withColumn("d", M.decide("score"))


@query(
    "metric_binary_all",
    "J13 J15 J17 J21 J25 J33 J35 J39",
    with_sql(
        _BINARY_SQL,
        """SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy_binary,
        round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy_binary,
        round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(tp / (tp + fp), 6) AS "precision", round(tp / (tp + fn), 6) AS recall,
        round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS mcc_binary,
        (SELECT round(avg(-ln(CASE WHEN y = 1 THEN score ELSE 1 - score END)), 6) FROM scored) AS log_loss_binary FROM cells""",
    ),
)
def metric_binary_all(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    M.validate(rows, "y", "score", proba=True)
    return _round(M.binary_scores(rows, "y", "d", "score"), {})


@query(
    "metric_auc",
    "J29",
    with_sql(
        _BINARY_SQL,
        """SELECT round((sum(CASE WHEN y = 1 THEN r END) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0)
        / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)), 6) AS auc, count(*) FILTER (y = 1) AS n_positive FROM (
        SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored)""",
    ),
)
def metric_auc(spark, sf_dir):
    return _round(M.auc(_scored(spark, sf_dir), "y", "score"), {})


@query(
    "fraud_cost",
    "J37",
    with_sql(
        _BINARY_SQL,
        """SELECT round((coalesce(sum(CASE WHEN y = 1 AND score * amount <= 1000 THEN amount END), 0)
        + coalesce(sum(CASE WHEN y = 0 AND score * amount > 1000 THEN amount END), 0) * 0.01) / sum(amount), 6) AS fraud_cost
        FROM scored""",
    ),
)
def fraud_cost(spark, sf_dir):
    rows = _scored(spark, sf_dir).withColumn("d", M.decide_by_amount("score", "amount", 1000))
    return _round(M.fraud_cost(rows, "y", "d", "amount"), {})


@query("lead_score", "J38", with_sql(_BINARY_SQL, "SELECT round((tp - fp) / (tp + fp + fn + tn), 6) AS lead_scoring FROM cells"))
def lead_score(spark, sf_dir):
    return _round(M.lead_score(_scored(spark, sf_dir), "y", "d"), {})


_SWEEP_SQL = """sweep AS (SELECT t.score AS threshold,
  CAST((SELECT count(*) FILTER (y = 1 AND score > t.score) FROM scored) AS DOUBLE) AS tp,
  CAST((SELECT count(*) FILTER (y = 0 AND score > t.score) FROM scored) AS DOUBLE) AS fp,
  CAST((SELECT count(*) FILTER (y = 1 AND score <= t.score) FROM scored) AS DOUBLE) AS fn FROM (SELECT DISTINCT score FROM scored) t)"""


@query(
    "threshold_sweep",
    "J40",
    with_sql(
        f"{_BINARY_SQL}, {_SWEEP_SQL}",
        """SELECT round(threshold, 9) AS threshold, round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS value
        FROM sweep ORDER BY CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END DESC, threshold LIMIT 1""",
    ),
)
def threshold_sweep(spark, sf_dir):
    best = M.optimize_threshold(_scored(spark, sf_dir), "y", "score", "F1")
    return best.select(F.round("threshold", 9).alias("threshold"), F.round("value", 6).alias("value"))


# ---- multiclass: label of a vector, scored by ten sums over its elements ----------------------------------------
# Ten class scores from the whole vector: every tenth element, whatever its length.
_E = [f"list_sum(list_transform(embedding[{i}:len(embedding):10], lambda x: CAST(x AS DOUBLE) + 1))" for i in range(1, 11)]
_TOTAL = "(" + " + ".join(_E) + ")"
_MULTI_SQL = f"""scored AS (SELECT vec_id, label AS y, [{', '.join(f'{e} / {_TOTAL}' for e in _E)}] AS probs FROM embeddings),
decided AS (SELECT vec_id, y, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS d, probs FROM scored),
classes AS (SELECT label, sum(hit) AS hit, sum(support) AS support, sum(predicted) AS predicted FROM (
  SELECT y AS label, CASE WHEN y = d THEN 1.0::DOUBLE ELSE 0 END AS hit, 1.0::DOUBLE AS support, 0.0::DOUBLE AS predicted FROM decided
  UNION ALL SELECT d, 0, 0, 1 FROM decided) GROUP BY label),
per AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END AS p, CASE WHEN support = 0 THEN 0 ELSE hit / support END AS r,
  2 * hit / (support + predicted) AS f FROM classes)"""


def _classified(spark, sf_dir):
    every = lambda i: F.filter("embedding", lambda x, place: place % 10 == i)
    e = [F.aggregate(every(i), F.lit(0.0), lambda total, x: total + (x.cast("double") + 1)) for i in range(10)]
    total = sum(e[1:], e[0])
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").alias("y"), F.array(*[x / total for x in e]).alias("probs")
    )
    best = F.array_position("probs", F.array_max("probs")) - 1
    return rows.withColumn("d", best.cast("int"))


@query(
    "metric_multiclass_all",
    "J14 J16 J18 J19 J20 J22 J23 J24 J26 J27 J28 J36",
    with_sql(
        _MULTI_SQL,
        """SELECT round(sum(hit) / sum(support), 6) AS accuracy_multiclass,
        round(avg(CASE WHEN support > 0 THEN r END), 6) AS balanced_accuracy_multiclass,
        round(sum(hit) / sum(support), 6) AS precision_micro, round(avg(p), 6) AS precision_macro,
        round(sum(p * support) / sum(support), 6) AS precision_weighted,
        round(sum(hit) / sum(support), 6) AS recall_micro, round(avg(r), 6) AS recall_macro,
        round(sum(r * support) / sum(support), 6) AS recall_weighted,
        round(sum(hit) / sum(support), 6) AS f1_micro, round(avg(f), 6) AS f1_macro,
        round(sum(f * support) / sum(support), 6) AS f1_weighted,
        round((sum(hit) * sum(support) - sum(support * predicted)) / sqrt((pow(sum(support), 2) - sum(predicted * predicted))
          * (pow(sum(support), 2) - sum(support * support))), 6) AS mcc_multiclass FROM per""",
    ),
)
def metric_multiclass_all(spark, sf_dir):
    return _round(M.multiclass_scores(_classified(spark, sf_dir), "y", "d"), {})


@query(
    "metric_logloss",
    "J34",
    with_sql(_MULTI_SQL, "SELECT round(avg(-ln(probs[y + 1])), 6) AS log_loss_multiclass FROM scored"),
)
def metric_logloss(spark, sf_dir):
    return _round(M.log_loss_multiclass(_classified(spark, sf_dir), "y", "probs"), {})


_AUC_OF = """(sum(CASE WHEN hit = 1 THEN r END) - count(*) FILTER (hit = 1) * (count(*) FILTER (hit = 1) + 1) / 2.0)
  / (count(*) FILTER (hit = 1) * count(*) FILTER (hit = 0))"""


@query(
    "metric_auc_multiclass",
    "J30 J31 J32",
    with_sql(
        _MULTI_SQL
        + f""", long AS (SELECT c, CASE WHEN y = c THEN 1 ELSE 0 END AS hit, probs[c + 1] AS s
          FROM scored, (SELECT unnest(range(10)) AS c)),
        each AS (SELECT c, {_AUC_OF} AS a, count(*) FILTER (hit = 1) AS n FROM (SELECT c, hit,
          rank() OVER (PARTITION BY c ORDER BY s) + (count(*) OVER (PARTITION BY c, s) - 1) / 2.0 AS r FROM long) GROUP BY c)""",
        f"""SELECT round(avg(a), 6) AS auc_macro, round(sum(a * n) / sum(n), 6) AS auc_weighted,
        (SELECT round({_AUC_OF}, 6) FROM (SELECT hit, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r
          FROM long)) AS auc_micro FROM each""",
    ),
)
def metric_auc_multiclass(spark, sf_dir):
    return _round(M.auc_multiclass(_classified(spark, sf_dir), "y", "probs"), {})


@query(
    "best_row",
    "G5",
    with_sql(VALUED_SQL, f"""SELECT key, round(median({_APE}) * 100, 6) AS mdape FROM valued GROUP BY key ORDER BY mdape, key LIMIT 1"""),
)
def best_row(spark, sf_dir):
    rows = valued_units(spark, sf_dir)
    scores = M.regression_scores(rows, "price_p", "avm", ["MdAPE"], ["key"])
    return _round(scores, {}).orderBy("mdape", "key").limit(1)
