"""Queries for valuation intervals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gable.operators import valuation as V
from gable.plans.property_view import VALUED_SQL, valued_units, with_sql
from gable.plans.registry import query

_ERR = f"""{VALUED_SQL}, errors AS (SELECT key, count(*) AS n_comparables, quantile_cont((avm - price_p) / price_p, (1 - 0.68) / 2) AS lo,
  quantile_cont((avm - price_p) / price_p, 0.68 + (1 - 0.68) / 2) AS hi FROM valued GROUP BY key),
intervals AS (SELECT key, n_comparables, CASE WHEN n_comparables >= 15 AND lo < 0 AND hi > 0 THEN lo END AS lo,
  CASE WHEN n_comparables >= 15 AND lo < 0 AND hi > 0 THEN hi END AS hi FROM errors)"""
_BOUNDS = f"""{_ERR}, raw AS (SELECT unit_indx, v.key, avm, round_even(avm + avm * lo, 0) AS avm_lower,
  round_even(avm + avm * hi, 0) AS avm_upper FROM valued v JOIN intervals i ON v.key = i.key),
bounds AS (SELECT *, CASE WHEN avm - avm_lower > avm_upper - avm THEN avm - avm_lower ELSE avm_upper - avm END AS fsd FROM raw)"""


def _rows(spark, sf_dir):
    return valued_units(spark, sf_dir).select("unit_indx", "key", "price_p", "avm")


@query("interval_by_key", "K1 K2 F10 E5", with_sql(_ERR, "SELECT key, n_comparables, round(lo, 9) AS lo, round(hi, 9) AS hi FROM intervals"))
def interval_by_key(spark, sf_dir):
    out = V.interval_by_key(_rows(spark, sf_dir), "key", "price_p", "avm")
    return out.withColumns({"lo": F.round("lo", 9), "hi": F.round("hi", 9)})


@query(
    "interval_sampled",
    "K2 B17",
    f"""WITH {VALUED_SQL}, sizes AS (SELECT key, count(*) AS n_comparables FROM valued GROUP BY key),
  draws AS (SELECT key, n_comparables, unnest(range(1, 3 * least(round(n_comparables * 0.5), 100)::BIGINT + 1)) AS draw FROM sizes),
  picks AS (SELECT key, ('0x' || substr(md5('1|' || key || '|' || draw), 1, 13))::BIGINT % n_comparables + 1 AS rank FROM draws),
  ranked AS (SELECT key, (avm - price_p) / price_p AS e, row_number() OVER (PARTITION BY key ORDER BY md5('1|' || unit_indx), unit_indx) AS rank FROM valued),
  errors AS (SELECT key, quantile_cont(e, (1 - 0.68) / 2) AS lo, quantile_cont(e, 0.68 + (1 - 0.68) / 2) AS hi FROM picks JOIN ranked USING (key, rank) GROUP BY key)
  SELECT key, n_comparables, round(CASE WHEN n_comparables >= 15 AND lo < 0 AND hi > 0 THEN lo END, 9) AS lo,
    round(CASE WHEN n_comparables >= 15 AND lo < 0 AND hi > 0 THEN hi END, 9) AS hi FROM sizes LEFT JOIN errors USING (key)""",
)
def interval_sampled(spark, sf_dir):
    out = V.interval_by_key(
        _rows(spark, sf_dir), "key", "price_p", "avm", frac=0.5, max_sample_sz=100, batch_sample_sets=3, unit="unit_indx", seed=1
    )
    return out.withColumns({"lo": F.round("lo", 9), "hi": F.round("hi", 9)})


@query(
    "avm_bounds",
    "K3",
    with_sql(
        _BOUNDS,
        """SELECT unit_indx, round(avm, 4) AS avm, avm_lower, avm_upper, round(fsd, 4) AS fsd, round(1 - fsd / avm, 6) AS conf FROM bounds""",
    ),
)
def avm_bounds(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    errors = V.interval_by_key(rows, "key", "price_p", "avm")
    joined = V.lookup_join(rows, errors, ["key"], weight="n_comparables")
    out = V.add_bounds(joined)
    return out.select(
        "unit_indx", F.round("avm", 4).alias("avm"), "avm_lower", "avm_upper", F.round("fsd", 4).alias("fsd"), F.round("conf", 6).alias("conf")
    )


@query(
    "avm_cleanup",
    "K2 K4 K7",
    with_sql(
        f"""{_BOUNDS}, shown AS (SELECT *, round_even(avm, 0) AS a, 1 - fsd / avm AS conf FROM bounds)""",
        """SELECT unit_indx, CASE WHEN a >= 0 THEN a END AS avm, CASE WHEN avm_lower <= a THEN avm_lower END AS avm_lower,
        CASE WHEN avm_upper >= a AND avm_upper >= 0 THEN avm_upper END AS avm_upper,
        CASE WHEN conf >= 0.4 THEN round(conf, 6) END AS conf, '2021-02-07 00:00:00' AS ts, '1' AS latest_production_version,
        CAST(NULL AS VARCHAR) AS latest_staging_version FROM shown""",
    ),
)
def avm_cleanup(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    out = V.avm(rows, rows, "key", "price_p", "avm", conf_min=0.4)
    out = V.add_run_metadata(out, production="1", at=dt.datetime(2021, 2, 7))
    return out.select(
        "unit_indx", "avm", "avm_lower", "avm_upper", F.round("conf", 6).alias("conf"),
        "ts", "latest_production_version", "latest_staging_version",
    )


_BATCH = """, shown AS (SELECT unit_indx, key, round_even(avm, 0) AS avm, avm_lower, avm_upper, fsd,
  round_even(1 - fsd / avm, 2) AS conf FROM bounds),
fixed AS (SELECT *, CASE WHEN avm_lower >= 0 AND avm_lower <= avm THEN avm_lower END AS l,
  CASE WHEN avm_upper >= 0 AND avm_upper >= avm THEN avm_upper END AS u FROM shown)
SELECT unit_indx, key, avm, round_even(CASE WHEN coalesce(l, avm - fsd) < 0 THEN 0 ELSE coalesce(l, avm - fsd) END, 0) AS avm_lower,
  round_even(coalesce(u, avm + fsd), 0) AS avm_upper, round_even(fsd, 0) AS fsd,
  CASE WHEN l IS NOT NULL AND u IS NOT NULL AND conf >= 0.5 THEN printf('%.2f', conf) ELSE '< 0.5' END AS conf_label FROM fixed"""
_OUT = ["unit_indx", "key", "avm", "avm_lower", "avm_upper", "fsd", "conf_label"]


@query("batch_confidence", "K5 K6 E3 F11", f"WITH {_BOUNDS}{_BATCH}")
def batch_confidence(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    return V.batch_confidence(rows, rows, "key", "price_p", "avm").select(*_OUT)


_ABSOLUTE = f"""{_ERR}, reps AS (SELECT key, avm AS of_rep FROM valued QUALIFY row_number() OVER (PARTITION BY key
  ORDER BY md5('0|' || CAST(unit_indx AS VARCHAR)), unit_indx) = 1),
raw AS (SELECT unit_indx, v.key, avm, round_even(of_rep + of_rep * lo, 0) AS rl, round_even(of_rep + of_rep * hi, 0) AS ru
  FROM valued v JOIN intervals i ON v.key = i.key JOIN reps r ON v.key = r.key),
again AS (SELECT unit_indx, key, avm, round_even(avm + avm * (rl / avm - 1), 0) AS avm_lower, round_even(avm + avm * (ru / avm - 1), 0) AS avm_upper FROM raw),
bounds AS (SELECT *, CASE WHEN avm - avm_lower > avm_upper - avm THEN avm - avm_lower ELSE avm_upper - avm END AS fsd FROM again)"""


@query("batch_confidence_absolute", "K5 F11", f"WITH {_ABSOLUTE}{_BATCH}")
def batch_confidence_absolute(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    out = V.batch_confidence(rows, rows, "key", "price_p", "avm", bounds="absolute")
    return out.select(*_OUT)
