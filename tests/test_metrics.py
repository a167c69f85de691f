import math

import pytest
from pyspark.sql import functions as F

from gable.operators import metrics as M


def frame(spark, rows, schema="y double, p double"):
    return spark.createDataFrame(rows, schema)


def test_registry():
    assert len(M.all_metric_names()) == 38 and len(M.core_metric_names()) == 36
    assert M.get_metric("mape").problem == "regression" and M.get_metric("MAE").bounded
    assert {m.name for m in M.core_metrics("binary")} >= {"AUC", "F1", "MCC Binary"}
    with pytest.raises(TypeError):
        M.get_metric(None)
    with pytest.raises(KeyError):
        M.get_metric("nope")


def test_zero_truth_and_negatives_are_reported(spark):
    df = frame(spark, [(0.0, 1.0), (2.0, -1.0)])
    scores, failed = M.score(df, "y", "p", ["MAPE", "MAE", "Mean Squared Log Error"])
    assert set(failed) == {"MAPE", "Mean Squared Log Error"} and scores.first().asDict() == {"mae": 2.0}


@pytest.mark.parametrize(
    "rows,message",
    [([], "no rows"), ([(None, 1.0)], "true values"), ([(1.0, float("nan"))], "predictions"), ([(1.0, math.inf)], "predictions")],
)
def test_validation(spark, rows, message):
    with pytest.raises(ValueError, match=message):
        M.validate(frame(spark, rows), "y", "p")


def test_probabilities_must_lie_in_the_unit_interval(spark):
    with pytest.raises(ValueError):
        M.validate(frame(spark, [(1.0, 1.2)]), "y", "p", proba=True)


def test_medians_of_large_input_agree(spark):
    df = frame(spark, [(float(i + 1), float(i + 1 + i % 7)) for i in range(500)])
    small = M.regression_scores(df, "y", "p", ["MdAPE", "MedianAE"]).first()
    assert small["medianae"] == 3.0


def test_constant_truth(spark):
    row = M.regression_scores(frame(spark, [(1.0, 2.0), (1.0, 1.0)]), "y", "p", ["R2", "MSE"]).first()
    assert row["mse"] == 0.5 and row["r2"] is None


def test_binary_zero_division(spark):
    row = M.binary_scores(frame(spark, [(1, 0), (0, 0)], "y int, p int"), "y", "p").first()
    assert row["f1"] == 0 and row["precision"] == 0 and row["mcc_binary"] == 0 and row["balanced_accuracy_binary"] == 0.5


def test_auc_counts_ties_half(spark):
    df = frame(spark, [(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    assert M.auc(df, "y", "s").first()["auc"] == pytest.approx(0.875)


def test_sweep_against_brute_force(spark):
    rows = [((i * 7) % 3 % 2, ((i * 37) % 23) / 23, float(i % 9 + 1)) for i in range(60)]
    df = frame(spark, rows, "y int, s double, a double")
    for metric in ("F1", "MCC Binary", "Balanced Accuracy Binary", "Lead Scoring"):
        best = M.optimize_threshold(df, "y", "s", metric).first()
        tries = {}
        for t in sorted({r[1] for r in rows}):
            decided = df.withColumn("d", (F.col("s") > t).cast("int"))
            if metric == "Lead Scoring":
                tries[t] = M.lead_score(decided, "y", "d").first()[0]
            else:
                tries[t] = M.binary_scores(decided, "y", "d").first()[M.column_name(metric)]
        assert best["value"] == pytest.approx(max(tries.values())) == pytest.approx(tries[best["threshold"]])


def test_fraud_threshold(spark):
    df = frame(spark, [(1, 10.0, 20.0), (0, 5.0, 10.0), (1, 30.0, 50.0), (0, 1.0, 5.0)], "y int, e double, amount double")
    best = M.optimize_threshold(df, "y", "e", "Fraud Cost", amount="amount").first()
    costs = [M.fraud_cost(df.withColumn("d", (F.col("e") > t).cast("int")), "y", "d").first()[0] for t in (1.0, 5.0, 10.0, 30.0)]
    assert best["threshold"] == 5.0 and best["value"] == pytest.approx(min(costs))
    with pytest.raises(ValueError):
        M.fraud_cost(df, "y", "y", "nope")


def test_multiclass_with_unpredicted_class(spark):
    df = frame(spark, [(0, 0), (1, 0), (2, 2), (2, 1)], "y int, p int")
    row = M.multiclass_scores(df, "y", "p").first()
    assert row["accuracy_multiclass"] == 0.5 and row["f1_micro"] == 0.5
    assert row["precision_macro"] == pytest.approx((0.5 + 0 + 1) / 3)
    assert row["recall_weighted"] == pytest.approx((1 * 1 + 0 + 0.5 * 2) / 4)


def test_percent_difference(spark):
    df = spark.range(1)

    def diff(metric, score, base):
        return df.select(M.percent_difference(metric, F.lit(score), F.lit(base))).first()[0]

    assert diff("MAPE", 5.0, 10.0) == 50.0 and diff("MAPE", 15.0, 10.0) == -50.0
    assert diff("R2", 0.5, 0.0) == math.inf and diff("R2", 0.5, 0.5) == 0
    assert diff("MAE", 7.0, 10.0) == 300.0
    assert diff("MAPE", None, 10.0) is None


def test_price_on_an_edge_is_in_two_bands(spark):
    prices = [0.0, 49999.0, 50000.0, 100000.0, 399999.0, 400000.0, 900000.0]
    df = frame(spark, [(p, p) for p in prices])
    both = [r[0] for r in df.select(M.price_bands("y")).collect()]
    assert both == [[0], [0], [0, 1], [1, 2], [7], [7, 8], [8]]
    assert [r[0] for r in df.select(M.price_bands("y", half_open=True)).collect()] == [[0], [0], [1], [2], [7], [8], [8]]
    few = M.accuracy_by_price_band(frame(spark, [(60000.0, 60000.0)] * 5 + [(120000.0, 130000.0)] * 6), "y", "p").collect()
    assert [(r["band"], r["n"], r["within_5"], r["within_10"]) for r in few] == [("100k-150k", 6, 0.0, 1.0)]


def test_outlier_flag_at_the_threshold(spark):
    df = frame(spark, [(100.0, 150.0), (100.0, 149.0)])
    assert [r["outlier"] for r in M.prediction_vs_actual(df, "y", "p", 50).collect()] == [True, False]
    with pytest.raises(ValueError):
        M.prediction_vs_actual(df, "y", "p", 0)
