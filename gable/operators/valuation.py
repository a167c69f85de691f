"""Valuation intervals: error percentiles of comparable properties, bounds, confidence and clean-up."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gable.operators.relational import representatives
from gable.operators.spread import exact_quantiles, hash_number, lookup_join, rank_by_hash
from gable.runtime import written

LOW_CONFIDENCE = "< 0.5"


def relative_error(y: str, pred: str) -> Column:
    """(prediction - truth) / truth, 0 where it is undefined."""
    return F.coalesce(F.try_divide(F.col(pred) - F.col(y), F.col(y)), F.lit(0.0))


def interval_by_key(
    comparables: DataFrame,
    key: str,
    y: str,
    pred: str,
    pred_interval: float = 0.68,
    min_sample_sz: int = 15,
    frac: float = 1.0,
    max_sample_sz: int | None = None,
    batch_sample_sets: int = 1,
    unit: str | None = None,
    seed: int = 0,
) -> DataFrame:
    """Per key: number of comparables and the relative error percentiles, null when the key is too small or when
    they do not enclose zero.

    ``frac=1`` uses every comparable once. A smaller share draws that share with replacement, at most
    ``max_sample_sz`` rows, ``batch_sample_sets`` times; ``unit`` (a unique column) then makes it reproducible.
    """
    lo, hi = (1 - pred_interval) / 2, pred_interval + (1 - pred_interval) / 2
    rows = comparables.withColumn("_e", relative_error(y, pred))
    if frac == 1.0 and max_sample_sz is None:
        out = exact_quantiles(rows.select(key, "_e"), {"lo": ("_e", lo), "hi": ("_e", hi)}, [key], size_col="n_comparables")
    else:
        if unit is None:
            raise ValueError("sampling needs the unit column")
        sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_comparables"))
        share = F.round(F.col("n_comparables") * frac).cast("int")
        draws = F.least(share, F.lit(max_sample_sz)) if max_sample_sz else share
        picks = sizes.filter(draws > 0).select(
            key, "n_comparables", F.explode(F.sequence(F.lit(1), draws * batch_sample_sets)).alias("_draw")
        )
        at = F.pmod(hash_number(F.lit(seed), F.col(key), F.col("_draw")), F.col("n_comparables")) + 1
        ranked = rank_by_hash(rows.select(key, unit, "_e"), unit, seed, [key], "_rank")
        sampled = picks.withColumn("_rank", at).join(ranked, [key, "_rank"])
        errors = exact_quantiles(sampled.select(key, "_e"), {"lo": ("_e", lo), "hi": ("_e", hi)}, [key])
        out = sizes.join(errors, key, "left")
    usable = (F.col("n_comparables") >= min_sample_sz) & (F.col("lo") < 0) & (F.col("hi") > 0)
    return out.select(key, "n_comparables", F.when(usable, F.col("lo")).alias("lo"), F.when(usable, F.col("hi")).alias("hi"))


def add_bounds(df: DataFrame, avm: str = "avm") -> DataFrame:
    """``avm_lower``, ``avm_upper`` from relative percentiles, with the larger side as ``fsd`` and the confidence."""
    value = F.col(avm)
    out = df.withColumns(
        {
            "avm_lower": F.bround(value + value * F.col("lo"), 0),
            "avm_upper": F.bround(value + value * F.col("hi"), 0),
        }
    )
    down, up = value - F.col("avm_lower"), F.col("avm_upper") - value
    out = out.withColumn("fsd", F.when(down > up, down).otherwise(up))
    return out.withColumn("conf", 1 - F.try_divide(F.col("fsd"), value))


def _unless(bad: Column, c: str) -> Column:
    return F.when(~F.coalesce(bad, F.lit(False)), F.col(c))


def clean_bounds(df: DataFrame, conf_min: float = 0.5) -> DataFrame:
    """Round, and blank what contradicts itself: negatives, a lower bound above the value, an upper bound below it,
    a confidence under the minimum."""
    out = df.withColumn("avm", F.bround("avm", 0))
    out = out.withColumns({"avm": _unless(F.col("avm") < 0, "avm"), "avm_upper": _unless(F.col("avm_upper") < 0, "avm_upper")})
    out = out.withColumn("avm_lower", _unless(F.col("avm_lower") > F.col("avm"), "avm_lower"))
    out = out.withColumn("avm_upper", _unless(F.col("avm_upper") < F.col("avm"), "avm_upper"))
    return out.withColumn("conf", _unless(F.col("conf") < conf_min, "conf"))


def correct_bounds(df: DataFrame, conf_min: float = 0.5) -> DataFrame:
    """Clean-up of the batch job: also blanks negative lower bounds, rounds the confidence to two digits and
    adds ``conf_label``, which spells a low or missing confidence as ``< 0.5``."""
    out = df.withColumns({"avm": F.bround("avm", 0), "conf": F.bround("conf", 2)})
    out = out.withColumns(
        {
            "avm": _unless(F.col("avm") < 0, "avm"),
            "avm_lower": _unless(F.col("avm_lower") < 0, "avm_lower"),
            "avm_upper": _unless(F.col("avm_upper") < 0, "avm_upper"),
        }
    )
    out = out.withColumn("avm_lower", _unless(F.col("avm_lower") > F.col("avm"), "avm_lower"))
    out = out.withColumn("avm_upper", _unless(F.col("avm_upper") < F.col("avm"), "avm_upper"))
    known = F.col("avm_lower").isNotNull() & F.col("avm_upper").isNotNull()
    out = out.withColumn("conf", F.when(known, F.col("conf")))
    label = F.when(F.col("conf") >= conf_min, F.format_string("%.2f", F.col("conf"))).otherwise(LOW_CONFIDENCE)
    return out.withColumn("conf_label", label)


def add_run_metadata(
    df: DataFrame, production: str | None = None, staging: str | None = None, at: dt.datetime | None = None
) -> DataFrame:
    """UTC timestamp of the run and the model versions, as literal columns."""
    return df.withColumns(
        {
            "ts": F.lit((at or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%d %H:%M:%S")),
            "latest_production_version": F.lit(production).cast("string"),
            "latest_staging_version": F.lit(staging).cast("string"),
        }
    )


def avm(
    units: DataFrame,
    comparables: DataFrame,
    key: str,
    y: str,
    pred: str,
    conf_min: float = 0.5,
    **interval,
) -> DataFrame:
    """Valuation with interval for every unit: errors once per key, one join, then bounds and clean-up."""
    errors = interval_by_key(comparables, key, y, pred, **interval)
    joined = lookup_join(units, errors, [key], weight="n_comparables")
    return clean_bounds(add_bounds(joined.withColumn("avm", F.col(pred))), conf_min)


def batch_confidence(
    units: DataFrame,
    comparables: DataFrame,
    key: str,
    y: str,
    pred: str,
    unit: str = "unit_indx",
    conf_min: float = 0.5,
    bounds: str = "relative",
    seed: int = 0,
    **interval,
) -> DataFrame:
    """Batch valuation. ``bounds='relative'`` applies the error percentiles of a key to each unit's own value;
    ``'absolute'`` gives every unit of a key the bounds of its representative unit."""
    if bounds not in ("relative", "absolute"):
        raise ValueError("bounds must be 'relative' or 'absolute'")
    errors = interval_by_key(comparables, key, y, pred, **interval)
    if bounds == "absolute":
        units = written(units)
        chosen = representatives(units.select(key, unit, F.col(pred).alias("_of")), [key], unit, seed)
        fixed = chosen.join(errors, key)
        value = F.col("_of")
        errors = fixed.select(
            key,
            "n_comparables",
            F.bround(value + value * F.col("lo"), 0).alias("_lower"),
            F.bround(value + value * F.col("hi"), 0).alias("_upper"),
        )
    out = lookup_join(units, errors, [key], weight="n_comparables").withColumn("avm", F.col(pred))
    if bounds == "absolute":
        out = out.withColumns({"lo": F.col("_lower") / F.col("avm") - 1, "hi": F.col("_upper") / F.col("avm") - 1})
    out = correct_bounds(add_bounds(out), conf_min)
    out = out.withColumns(
        {
            "avm_lower": F.coalesce("avm_lower", F.col("avm") - F.col("fsd")),
            "avm_upper": F.coalesce("avm_upper", F.col("avm") + F.col("fsd")),
        }
    )
    out = out.withColumns(
        {
            "avm_lower": F.bround(F.when(F.col("avm_lower") < 0, 0.0).otherwise(F.col("avm_lower")), 0),
            "avm_upper": F.bround("avm_upper", 0),
            "fsd": F.bround("fsd", 0),
        }
    )
    return out.drop("lo", "hi", "_lower", "_upper")
