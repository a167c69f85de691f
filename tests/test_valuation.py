import pytest
from pyspark.sql import functions as F

from gable.operators import valuation as V


def rows(spark, spec):
    """{key: [(y, p), ...]} as valued units."""
    data = [(i, k, float(y), float(p)) for k, pairs in spec.items() for i, (y, p) in enumerate(pairs)]
    return spark.createDataFrame([(n, k, y, p) for n, (_, k, y, p) in enumerate(data)], "unit_indx long, key string, y double, p double")


def test_small_or_one_sided_keys_have_no_interval(spark):
    df = rows(spark, {
        "few": [(100, 90 + i) for i in range(14)],
        "high": [(100, 150 + i) for i in range(20)],
        "good": [(100, 90 + i) for i in range(20)],
        "zero": [(0, 5)] * 16,
    })
    got = {r["key"]: r for r in V.interval_by_key(df, "key", "y", "p").collect()}
    assert got["few"]["lo"] is None and got["high"]["lo"] is None and got["zero"]["lo"] is None
    assert got["good"]["lo"] == pytest.approx(-0.0696) and got["good"]["hi"] == pytest.approx(0.0596)
    large = V.interval_by_key(df, "key", "y", "p")
    assert sorted((r["key"], str(r["lo"])[:8]) for r in large.collect()) == sorted((k, str(r["lo"])[:8]) for k, r in got.items())


def test_bounds_enclose_the_value(spark):
    df = rows(spark, {"good": [(100 + i, 95 + i) for i in range(60)] + [(100 + i, 108 + i) for i in range(60)]})
    out = V.avm(df, df, "key", "y", "p")
    assert out.filter("avm_lower > avm OR avm_upper < avm OR conf < 0.5 OR conf > 1").count() == 0
    assert out.filter("avm_lower IS NOT NULL AND conf IS NOT NULL").count() == 120


def test_clean_up_rules(spark):
    data = [(-5.0, -6.0, 1.0, 0.9), (10.4, 11.0, 9.0, 0.9), (10.0, -3.0, 12.0, 0.456), (10.0, 8.0, 12.0, 0.8)]
    df = spark.createDataFrame(data, "avm double, avm_lower double, avm_upper double, conf double")
    clean = V.clean_bounds(df).collect()
    assert clean[0]["avm"] is None and clean[1]["avm_lower"] is None and clean[1]["avm_upper"] is None
    assert clean[2]["avm_lower"] == -3.0 and clean[2]["conf"] is None and clean[3]["conf"] == 0.8
    correct = V.correct_bounds(df).collect()
    assert correct[2]["avm_lower"] is None and correct[2]["conf_label"] == "< 0.5" and correct[3]["conf_label"] == "0.80"
    assert correct[1]["conf"] is None


def test_batch_bounds(spark):
    df = rows(spark, {"good": [(100, 90 + i) for i in range(20)], "few": [(100, 90)] * 3})
    out = {r["unit_indx"]: r for r in V.batch_confidence(df, df, "key", "y", "p").collect()}
    assert len(out) == 23
    assert out[22]["conf_label"] == "< 0.5" and out[22]["avm_lower"] is None
    same = V.batch_confidence(df, df, "key", "y", "p", bounds="absolute").filter("key = 'good'")
    assert same.filter("avm_lower <= avm AND avm_upper >= avm").select("avm_lower").distinct().count() <= 12
    with pytest.raises(ValueError):
        V.batch_confidence(df, df, "key", "y", "p", bounds="other")


def test_sampled_intervals_are_reproducible(spark):
    df = rows(spark, {"good": [(100, 80 + i % 40) for i in range(400)], "few": [(100, 90)] * 3})
    how = dict(frac=0.5, max_sample_sz=100, batch_sample_sets=2, unit="unit_indx", seed=5)
    a = V.interval_by_key(df, "key", "y", "p", **how).collect()
    b = V.interval_by_key(df.repartition(7), "key", "y", "p", **how).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
    exact = {r["key"]: r for r in V.interval_by_key(df, "key", "y", "p").collect()}
    got = {r["key"]: r for r in a}
    assert got["good"]["lo"] == pytest.approx(exact["good"]["lo"], abs=0.06) and got["few"]["lo"] is None
    with pytest.raises(ValueError):
        V.interval_by_key(df, "key", "y", "p", frac=0.5)


def test_run_metadata(spark):
    out = V.add_run_metadata(spark.range(1), production="3")
    assert out.first()["latest_production_version"] == "3" and out.first()["latest_staging_version"] is None
    assert out.filter(F.col("ts").isNull()).count() == 0
