"""Regression and classification metrics, each an aggregate over (truth, prediction).

All regression metrics of a call come from one pass, all binary metrics from one pass, and all multiclass
metrics from one grouped confusion count. Metrics that need an order of scores (AUC, threshold choice)
group equal scores first and accumulate counts with a distributed running total.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gable.operators.spread import exact_quantiles, running_totals

CLIP = 1e-15


@dataclass(frozen=True)
class Metric:
    name: str
    problem: str
    greater_is_better: bool
    perfect_score: float
    bounded: bool
    needs_proba: bool = False
    positive_only: bool = False
    core: bool = True


def _many(problem, greater, perfect, bounded, names, **more):
    return [Metric(n, problem, greater, perfect, bounded, **more) for n in names]


# ---- fixed values: metric names and their flags ------------------------------------------------------
_ALL = [
    *_many("regression", False, 0.0, False, ["MAPE", "MdAPE"], positive_only=True),
    *_many("time series regression", False, 0.0, False, ["Mean Absolute Percentage Error"], positive_only=True),
    *_many("regression", False, 0.0, True, ["MAE"]),
    *_many("regression", False, 0.0, False, ["MSE", "Root Mean Squared Error", "MedianAE", "MaxError"]),
    *_many("regression", False, 0.0, False, ["Mean Squared Log Error", "Root Mean Squared Log Error"], positive_only=True),
    *_many("regression", True, 1.0, False, ["R2", "ExpVariance"]),
    *_many("binary", True, 1.0, True, ["Accuracy Binary", "Balanced Accuracy Binary", "F1", "Precision", "Recall"]),
    *_many("binary", True, 1.0, True, ["AUC"], needs_proba=True),
    *_many("binary", False, 0.0, False, ["Log Loss Binary"], needs_proba=True),
    *_many("binary", True, 1.0, False, ["MCC Binary"]),
    *_many("binary", False, 0.0, True, ["Fraud Cost"], core=False),
    *_many("binary", True, math.inf, False, ["Lead Scoring"], core=False),
    *_many("multiclass", True, 1.0, True, ["Accuracy Multiclass", "Balanced Accuracy Multiclass"]),
    *_many("multiclass", True, 1.0, True, ["F1 Micro", "F1 Macro", "F1 Weighted"]),
    *_many("multiclass", True, 1.0, True, ["Precision Micro", "Precision Macro", "Precision Weighted"]),
    *_many("multiclass", True, 1.0, True, ["Recall Micro", "Recall Macro", "Recall Weighted"]),
    *_many("multiclass", True, 1.0, True, ["AUC Micro", "AUC Macro", "AUC Weighted"], needs_proba=True),
    *_many("multiclass", False, 0.0, False, ["Log Loss Multiclass"], needs_proba=True),
    *_many("multiclass", True, 1.0, False, ["MCC Multiclass"]),
]
# -----------------------------------------------------------------------------------------------------
METRICS = {m.name.lower(): m for m in _ALL}


def all_metric_names() -> list[str]:
    return list(METRICS)


def core_metric_names() -> list[str]:
    return [k for k, m in METRICS.items() if m.core]


def get_metric(name: str | Metric) -> Metric:
    if isinstance(name, Metric):
        return name
    if not isinstance(name, str):
        raise TypeError("a metric is given by name or as a Metric")
    if name.lower() not in METRICS:
        raise KeyError(f"{name} is not a valid metric; see all_metric_names()")
    return METRICS[name.lower()]


def core_metrics(problem: str) -> list[Metric]:
    """Metrics of a problem type; time series also take the plain regression metrics."""
    kinds = {problem, "regression"} if problem == "time series regression" else {problem}
    return [m for m in METRICS.values() if m.core and m.problem in kinds]


def column_name(metric: str) -> str:
    """Output column of a metric: its name in snake case."""
    return get_metric(metric).name.lower().replace(" ", "_")


# ---- input checks ------------------------------------------------------------------------------------
def violations(df: DataFrame, y: str, pred: str, proba: bool = False) -> DataFrame:
    """One row of counts of what makes inputs unusable."""

    def broken(c):
        v = F.col(c).cast("double")
        return F.coalesce(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(True))

    def count(test):
        return F.coalesce(F.sum(test.cast("long")), F.lit(0))

    outside = ~F.col(pred).between(0, 1) if proba else F.lit(False)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        count(broken(y)).alias("bad_truth"),
        count(broken(pred)).alias("bad_prediction"),
        count(F.coalesce(outside, F.lit(False))).alias("outside_unit"),
        count(F.coalesce(F.col(y) == 0, F.lit(False))).alias("zero_truth"),
        count(F.coalesce((F.col(y) < 0) | (F.col(pred) < 0), F.lit(False))).alias("negative"),
    )


def validate(df: DataFrame, y: str, pred: str, proba: bool = False) -> dict[str, int]:
    """Raise for empty, missing, infinite or out-of-range inputs; return the counts."""
    found = violations(df, y, pred, proba).first().asDict()
    if found["n_rows"] == 0:
        raise ValueError("there are no rows to score")
    if found["bad_truth"]:
        raise ValueError("the true values hold NaN, infinity or nulls")
    if found["bad_prediction"]:
        raise ValueError("the predictions hold NaN, infinity or nulls")
    if found["outside_unit"]:
        raise ValueError("probabilities must lie between 0 and 1")
    return found


# ---- regression --------------------------------------------------------------------------------------
def regression_aggregates(y: str, pred: str) -> dict[str, Column]:
    t, p = F.col(y).cast("double"), F.col(pred).cast("double")
    ape = F.avg(F.abs(F.try_divide(t - p, t))) * 100
    mse = F.avg(F.pow(t - p, F.lit(2.0)))
    msle = F.avg(F.pow(F.log1p(t) - F.log1p(p), F.lit(2.0)))
    return {
        "mape": ape,
        "mean_absolute_percentage_error": ape,
        "mae": F.avg(F.abs(t - p)),
        "mse": mse,
        "root_mean_squared_error": F.sqrt(mse),
        "mean_squared_log_error": msle,
        "root_mean_squared_log_error": F.sqrt(msle),
        "r2": 1 - F.try_divide(mse, F.var_pop(t)),
        "maxerror": F.max(F.abs(t - p)),
        "expvariance": 1 - F.try_divide(F.var_pop(t - p), F.var_pop(t)),
    }


def regression_scores(
    df: DataFrame,
    y: str,
    pred: str,
    metrics: Sequence[str] | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """One row (per key) with every asked regression metric, in a single pass."""
    names = [column_name(m) for m in (metrics or [m.name for m in core_metrics("time series regression")])]
    plain = regression_aggregates(y, pred)
    t, p = F.col(y).cast("double"), F.col(pred).cast("double")
    rows = df.withColumns({"_ae": F.abs(t - p), "_ape": F.abs(F.try_divide(t - p, t)) * 100})
    medians = {n: (c, 0.5) for n, c in (("mdape", "_ape"), ("medianae", "_ae")) if n in names}
    extra = [plain[n].alias(n) for n in names if n in plain]
    if medians:
        out = exact_quantiles(rows, medians, keys, extra)
    else:
        out = rows.groupBy(*keys).agg(*extra)
    return out.select(*keys, *names)


def score(
    df: DataFrame, y: str, pred: str, metrics: Sequence[str]
) -> tuple[DataFrame, dict[str, str]]:
    """Several regression metrics at once; those the data rule out are returned with the reason instead."""
    found = validate(df, y, pred)
    failed: dict[str, str] = {}
    for m in metrics:
        name = column_name(m)
        if name in ("mape", "mdape", "mean_absolute_percentage_error") and found["zero_truth"]:
            failed[m] = "target contains 0, so a percentage error is undefined"
        if name.endswith("log_error") and found["negative"]:
            failed[m] = "a log error needs non-negative values"
    return regression_scores(df, y, pred, [m for m in metrics if m not in failed], ()), failed


# ---- binary --------------------------------------------------------------------------------------------
def decide(proba: str, threshold: float = 0.5) -> Column:
    return (F.col(proba) > threshold).cast("int")


def decide_by_amount(proba: str, amount: str, threshold: float = 0.0) -> Column:
    return (F.col(proba) * F.col(amount) > threshold).cast("int")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def metrics_of_counts(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Binary metrics from the four cells of the confusion table."""
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    recalls = [F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)]
    seen = sum(F.when(r.isNotNull(), 1.0).otherwise(0.0) for r in recalls)
    balanced = F.try_divide(sum(F.coalesce(r, F.lit(0.0)) for r in recalls), seen)
    spread = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    return {
        "accuracy_binary": _ratio(tp + tn, tp + fp + fn + tn),
        "balanced_accuracy_binary": balanced,
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "mcc_binary": _ratio(tp * tn - fp * fn, spread),
    }


def binary_scores(df: DataFrame, y: str, decision: str, proba: str | None = None) -> DataFrame:
    """One row with the decision metrics, and the log loss when probabilities are given."""
    t, d = F.col(y).cast("int"), F.col(decision).cast("int")

    def cell(a, b):
        return F.sum(((t == a) & (d == b)).cast("long"))

    aggs = [cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn")]
    if proba:
        p = F.least(F.greatest(F.col(proba), F.lit(CLIP)), F.lit(1 - CLIP))
        aggs.append(F.avg(-F.ln(F.when(t == 1, p).otherwise(1 - p))).alias("log_loss_binary"))
    counts = df.agg(*aggs)
    made = metrics_of_counts(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    return counts.select(*[c.alias(n) for n, c in made.items()], *(["log_loss_binary"] if proba else []))


def fraud_cost(
    df: DataFrame,
    y: str,
    decision: str,
    amount: str = "amount",
    retry_percentage: float = 0.5,
    interchange_fee: float = 0.02,
    fraud_payout_percentage: float = 1.0,
) -> DataFrame:
    """Money lost (missed fraud and fees of declined good payments) per amount processed."""
    if amount not in df.columns:
        raise ValueError(f"`{amount}` is not a valid column")
    t, d, a = F.col(y).cast("int"), F.col(decision).cast("int"), F.col(amount)
    missed = F.sum(F.when((t == 1) & (d == 0), a).otherwise(0)) * fraud_payout_percentage
    declined = F.sum(F.when((t == 0) & (d == 1), a).otherwise(0)) * ((1 - retry_percentage) * interchange_fee)
    return df.agg(F.try_divide(missed + declined, F.sum(a)).alias("fraud_cost"))


def lead_score(df: DataFrame, y: str, decision: str, true_positives: float = 1, false_positives: float = -1) -> DataFrame:
    """Profit per lead."""
    t, d = F.col(y).cast("int"), F.col(decision).cast("int")
    gain = F.when((t == 1) & (d == 1), true_positives).when((t == 0) & (d == 1), false_positives).otherwise(0)
    return df.agg(F.avg(gain.cast("double")).alias("lead_scoring"))


def auc(df: DataFrame, y: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, ties counting half: one row (per key) with ``auc`` and the positives."""
    t = F.col(y).cast("int")
    ties = df.groupBy(*keys, score).agg(
        F.sum((t == 1).cast("long")).alias("_pos"), F.sum((t == 0).cast("long")).alias("_neg")
    )
    run = running_totals(ties, [score], ["_neg"], keys)
    pairs = F.sum(F.col("_pos") * (F.col("_neg_before") + F.col("_neg") / 2))
    return run.groupBy(*keys).agg(
        F.try_divide(pairs, F.sum("_pos").cast("double") * F.sum("_neg")).alias("auc"), F.sum("_pos").alias("n_positive")
    )


def threshold_table(df: DataFrame, y: str, score: str, amount: str | None = None) -> DataFrame:
    """Confusion counts (and amounts) for every decision ``score > threshold`` at a distinct score."""
    t = F.col(y).cast("int")
    sums = {"pos": F.sum((t == 1).cast("long")), "neg": F.sum((t == 0).cast("long"))}
    if amount:
        sums["amount_pos"] = F.sum(F.when(t == 1, F.col(amount)).otherwise(0))
        sums["amount_neg"] = F.sum(F.when(t == 0, F.col(amount)).otherwise(0))
    ties = df.groupBy(score).agg(*[c.alias(n) for n, c in sums.items()])
    run = running_totals(ties, [score], list(sums))
    below = {n: F.col(f"{n}_before") + F.col(n) for n in sums}
    made = {
        "fn": below["pos"],
        "tn": below["neg"],
        "tp": F.col("pos_total") - below["pos"],
        "fp": F.col("neg_total") - below["neg"],
    }
    if amount:
        made["missed"] = below["amount_pos"]
        made["declined"] = F.col("amount_neg_total") - below["amount_neg"]
        made["processed"] = F.col("amount_pos_total") + F.col("amount_neg_total")
    return run.select(F.col(score).alias("threshold"), *[c.alias(n) for n, c in made.items()])


def optimize_threshold(df: DataFrame, y: str, score: str, metric: str = "F1", **costs) -> DataFrame:
    """The best threshold over all distinct scores, by an exact sweep (smallest threshold on ties).

    For ``Fraud Cost`` the score is the expected amount and ``amount`` names the amount column.
    """
    chosen = get_metric(metric)
    table = threshold_table(df, y, score, costs.get("amount"))
    counts = [F.col(c) for c in ("tp", "fp", "fn", "tn")]
    if chosen.name == "Fraud Cost":
        fee = (1 - costs.get("retry_percentage", 0.5)) * costs.get("interchange_fee", 0.02)
        loss = F.col("missed") * costs.get("fraud_payout_percentage", 1.0) + F.col("declined") * fee
        value = F.try_divide(loss, F.col("processed"))
    elif chosen.name == "Lead Scoring":
        gain = F.col("tp") * costs.get("true_positives", 1) + F.col("fp") * costs.get("false_positives", -1)
        value = gain / sum(counts)
    else:
        value = metrics_of_counts(*counts)[column_name(metric)]
    best_first = F.desc("value") if chosen.greater_is_better else F.asc("value")
    return table.select("threshold", value.alias("value")).orderBy(best_first, "threshold").limit(1)


# ---- multiclass ------------------------------------------------------------------------------------------
def class_counts(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Per class: hits, support and predicted counts, from one grouped confusion table."""
    pairs = df.groupBy(F.col(y).alias("_y"), F.col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    sides = F.array(
        F.struct(
            F.col("_y").alias("label"),
            F.when(F.col("_y") == F.col("_p"), F.col("_n")).otherwise(0).alias("hit"),
            F.col("_n").alias("support"),
            F.lit(0).cast("long").alias("predicted"),
        ),
        F.struct(
            F.col("_p").alias("label"),
            F.lit(0).cast("long").alias("hit"),
            F.lit(0).cast("long").alias("support"),
            F.col("_n").alias("predicted"),
        ),
    )
    sums = [F.sum(c).alias(c) for c in ("hit", "support", "predicted")]
    return pairs.select(F.inline(sides)).groupBy("label").agg(*sums)


def multiclass_scores(df: DataFrame, y: str, pred: str) -> DataFrame:
    """One row with every decision metric of the multiclass family."""
    hit, support, predicted = F.col("hit"), F.col("support"), F.col("predicted")
    per_class = {
        "precision": _ratio(hit, predicted),
        "recall": _ratio(hit, support),
        "f1": _ratio(2 * hit, support + predicted),
    }
    rows = class_counts(df, y, pred).select("hit", "support", "predicted", *[c.alias(n) for n, c in per_class.items()])
    n, right = F.sum("support"), F.sum("hit")
    accuracy = right / n
    marginal = F.sum(F.col("support").cast("double") * F.col("predicted"))
    of_truth = F.sum(F.pow(F.col("support").cast("double"), F.lit(2.0)))
    of_pred = F.sum(F.pow(F.col("predicted").cast("double"), F.lit(2.0)))
    square = F.pow(n.cast("double"), F.lit(2.0))
    aggs = {"accuracy_multiclass": accuracy}
    aggs["balanced_accuracy_multiclass"] = F.avg(F.when(F.col("support") > 0, F.col("recall")))
    for m in per_class:
        aggs[f"{m}_micro"] = accuracy
        aggs[f"{m}_macro"] = F.avg(m)
        aggs[f"{m}_weighted"] = F.sum(F.col(m) * F.col("support")) / n
    top = right.cast("double") * n - marginal
    aggs["mcc_multiclass"] = _ratio(top, F.sqrt(square - of_pred) * F.sqrt(square - of_truth))
    return rows.agg(*[c.alias(k) for k, c in aggs.items()])


def log_loss_multiclass(df: DataFrame, y: str, probs: str) -> DataFrame:
    """``probs`` is an array with one probability per class code 0..k-1."""
    p = F.try_element_at(F.col(probs), F.col(y).cast("int") + 1)
    p = F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP))
    return df.agg(F.avg(-F.ln(p)).alias("log_loss_multiclass"))


def auc_multiclass(df: DataFrame, y: str, probs: str) -> DataFrame:
    """One-vs-rest AUC: pooled over classes, averaged, and averaged by support."""
    long = df.select(F.col(y).alias("_y"), F.posexplode(probs).alias("_class", "_score"))
    long = long.select("_class", "_score", (F.col("_y") == F.col("_class")).cast("int").alias("_hit"))
    each = auc(long, "_hit", "_score", ["_class"]).agg(
        F.avg("auc").alias("auc_macro"),
        (F.sum(F.col("auc") * F.col("n_positive")) / F.sum("n_positive")).alias("auc_weighted"),
    )
    micro = auc(long, "_hit", "_score").select(F.col("auc").alias("auc_micro"))
    names = ["auc_macro", "auc_weighted", "auc_micro"]
    # Two single rows with different columns, folded into one.
    return each.unionByName(micro, allowMissingColumns=True).agg(*[F.max(n).alias(n) for n in names])


# ---- comparison and reports ---------------------------------------------------------------------------------
def percent_difference(metric: str | Metric, score: Column, baseline: Column) -> Column:
    """Signed percentage change against a baseline score: positive when better."""
    m = get_metric(metric)
    gap = baseline - score
    change = F.abs(gap if m.bounded else F.try_divide(gap, baseline)) * 100
    worse = (gap > 0) if m.greater_is_better else (gap < 0)
    out = F.when(score.isNull() | baseline.isNull(), F.lit(None).cast("double")).when(F.abs(gap) < 1e-10, 0.0)
    if not m.bounded:
        out = out.when(F.abs(baseline) < 1e-10, float("inf"))
    return out.when(worse, -change).otherwise(change)


# ---- fixed values: price bands, inclusive on both sides --------------------------------------------------------
BAND_STEP = 50_000
BAND_TOP = 400_000
BAND_LABELS = [
    "<50k", "50k-100k", "100k-150k", "150k-200k", "200k-250k", "250k-300k", "300k-350k", "350k-400k", ">400k",
]
ERROR_LIMITS = (2, 5, 10, 20)
# --------------------------------------------------------------------------------------------------------------


def price_bands(y: str | Column, half_open: bool = False) -> Column:
    """Array of the bands a price falls in: a price on an edge is in both, unless ``half_open``."""
    price = F.col(y) if isinstance(y, str) else y
    last = len(BAND_LABELS) - 1
    lower = F.greatest(F.least(F.floor(price / BAND_STEP), F.lit(last)), F.lit(0)).cast("int")
    on_edge = (price % BAND_STEP == 0) & price.between(BAND_STEP, BAND_TOP)
    if half_open:
        return F.array(lower)
    return F.when(on_edge, F.array(lower - 1, lower)).otherwise(F.array(lower))


def accuracy_by_price_band(df: DataFrame, y: str, pred: str, more_than: int = 5, half_open: bool = False) -> DataFrame:
    """Per price band: rows and the share of rows within 2, 5, 10 and 20 percent error."""
    error = F.abs((F.col(pred) - F.col(y)) / F.col(y))
    rows = df.select(error.alias("_error"), F.explode(price_bands(y, half_open)).alias("_band"))
    shares = [F.avg((F.col("_error") < x / 100).cast("double")).alias(f"within_{x}") for x in ERROR_LIMITS]
    bands = rows.groupBy("_band").agg(F.count(F.lit(1)).alias("n"), *shares).filter(F.col("n") > more_than)
    labels = F.array(*[F.lit(x) for x in BAND_LABELS])
    return bands.select(F.element_at(labels, F.col("_band") + 1).alias("band"), "n", *[f"within_{x}" for x in ERROR_LIMITS])


def misvaluation(df: DataFrame, y: str, pred: str, limit: float = 0.2) -> DataFrame:
    """Rows with the signed relative error and flags: close, overvalued and undervalued sale."""
    signed = (F.col(pred) - F.col(y)) / F.col(y)
    return df.withColumn("percent_error", signed).withColumns(
        {
            "well_valued": F.abs(F.col("percent_error")) < limit,
            "badly_valued": F.abs(F.col("percent_error")) >= limit,
            "undervalued": F.col("percent_error") < -limit,
            "overvalued": F.col("percent_error") > limit,
        }
    )


def prediction_vs_actual(df: DataFrame, y: str, pred: str, outlier_threshold: float | None = None) -> DataFrame:
    """Prediction next to truth, flagged when the absolute residual reaches the threshold."""
    if outlier_threshold is not None and outlier_threshold <= 0:
        raise ValueError("outlier_threshold must be positive")
    flag = F.lit(None).cast("boolean") if outlier_threshold is None else F.abs(F.col(pred) - F.col(y)) >= outlier_threshold
    return df.withColumn("outlier", flag)
