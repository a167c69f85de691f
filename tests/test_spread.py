"""The skew-safe building blocks give the plain answers, also when one group holds most rows."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gable.operators import spread
from gable.operators.timeseries import shifted


@pytest.fixture(scope="module")
def skewed(spark):
    """2000 rows: two thirds in one group, some in a null group, values with many ties."""
    rows = spark.range(2000).select(
        "id",
        F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 30 == 2, None).otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.when(F.col("id") % 5 > 0, (F.xxhash64("id") % 50).cast("double")).alias("v"),
    )
    return rows.persist()


def test_rank_by_hash_is_the_window_rank(skewed):
    got = spread.rank_by_hash(skewed, "id", 9, ["g"], "r", "n")
    w = Window.partitionBy("g")
    want = skewed.withColumn("r2", F.row_number().over(w.orderBy(spread.hash_order("id", 9), "id"))).withColumn("n2", F.count("*").over(w))
    both = got.join(want, "id")
    assert both.filter((F.col("r") != F.col("r2")) | (F.col("n") != F.col("n2"))).count() == 0
    assert both.count() == 2000


@pytest.mark.parametrize("strata", [(), ("g",)])
def test_rank_by_order_is_the_window_rank(skewed, strata):
    got = spread.rank_by_order(skewed, ["v", "id"], strata, "r", "n")
    w = Window.partitionBy(*strata)
    want = skewed.withColumn("r2", F.row_number().over(w.orderBy("v", "id"))).withColumn("n2", F.count("*").over(w))
    both = got.join(want, "id")
    assert both.count() == 2000
    assert both.filter((F.col("r") != F.col("r2")) | (F.col("n") != F.col("n2"))).count() == 0


@pytest.mark.parametrize("strata", [(), ("g",)])
def test_running_totals(skewed, strata):
    rows = skewed.withColumn("one", F.lit(1)).withColumn("x", F.col("id") % 11)
    got = spread.running_totals(rows, ["v", "id"], ["one", "x"], strata)
    w = Window.partitionBy(*strata).orderBy("v", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = rows.select("id", F.coalesce(F.sum("x").over(w), F.lit(0)).alias("want"))
    both = got.join(want, "id")
    assert both.filter(F.col("x_before") != F.col("want")).count() == 0
    assert got.agg(F.max("one_total")).first()[0] == (2000 if not strata else skewed.filter("g = 'hot'").count())


@pytest.mark.parametrize("keys", [(), ("g",)])
def test_exact_quantiles_are_percentiles(skewed, keys):
    wanted = {"lo": ("v", 0.16), "mid": ("v", 0.5), "hi": ("v", 0.99), "ends": ("id", 1.0)}
    got = {tuple(r[k] for k in keys): r for r in spread.exact_quantiles(skewed, wanted, keys, [F.count(F.lit(1)).alias("n")]).collect()}
    exact = [F.percentile(F.col(c), F.lit(q)).alias(n) for n, (c, q) in wanted.items()]
    want = {tuple(r[k] for k in keys): r for r in skewed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *exact).collect()}
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert got[k]["n"] == r["n"]
        for c in wanted:
            assert got[k][c] == pytest.approx(r[c], abs=1e-9)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(0, 1e6, 500), rng.normal(0, 1e-6, 500), [0.0, -0.0, 1e308, -1e308] * 3]).tolist()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wanted = {f"q{i}": ("v", q) for i, q in enumerate((0, 0.1, 0.37, 0.5, 0.93, 1))}
    row = spread.exact_quantiles(df, wanted).first()
    for name, (_, q) in wanted.items():
        assert row[name] == pytest.approx(np.quantile(values, q))


def test_a_frequent_value_is_one_row_before_any_window(spark):
    """90 % equal values in one group: they are summed before the shuffle, so no task gets them all."""
    df = spark.range(0, 50_000, 1, 8).select(F.lit("g").alias("g"), F.when(F.col("id") % 10 < 9, 7.0).otherwise(F.col("id").cast("double")).alias("v"))
    row = spread.exact_quantiles(df, {"m": ("v", 0.5), "h": ("v", 0.95)}, ["g"]).first()
    assert row["m"] == 7.0 and row["h"] == pytest.approx(np.quantile([7.0 if i % 10 < 9 else i for i in range(50_000)], 0.95))
    weighed = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    again = spread.exact_quantiles(weighed, {"m": ("v", 0.5), "h": ("v", 0.95)}, ["g"], size_col="k", weight="n").first()
    assert again.asDict() == {**row.asDict(), "k": 50_000}


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("weight", [None, "n"])
def test_salted_lookup_join_is_a_join(skewed, how, weight):
    lookup = skewed.filter("g IS NOT NULL AND g <> 'g1'").groupBy("g").agg(F.count("*").alias("n"), F.sum("v").alias("s"))
    got = spread.lookup_join(skewed, lookup, ["g"], how, weight)
    want = skewed.join(lookup, ["g"], how)
    assert sorted(map(str, got.select("id", "g", "n", "s").collect())) == sorted(map(str, want.select("id", "g", "n", "s").collect()))


def test_salted_lookup_join_on_two_keys(skewed):
    rows = skewed.withColumn("h", F.col("id") % 2)
    lookup = rows.groupBy("g", "h").agg(F.count("*").alias("n"))
    got = spread.lookup_join(rows, lookup, ["g", "h"], "left", "n")
    want = rows.join(lookup, ["g", "h"], "left")
    assert sorted(map(str, got.select("id", "n").collect())) == sorted(map(str, want.select("id", "n").collect()))


def test_salting_spreads_the_hot_key(skewed):
    lookup = skewed.groupBy("g").agg(F.count("*").alias("n"))
    plan = spread.lookup_join(skewed, lookup, ["g"], "left", "n")._jdf.queryExecution().toString()
    assert "_salt" in plan
    # Only keys above a partition's share are heavy: here the one with two thirds of the rows.
    assert [r["g"] for r in spread.heavy_keys(lookup, ["g"], "n").collect()] == ["hot"]


@pytest.mark.parametrize("series", [(), ("g",)])
def test_shift_over_chunks_is_the_window_shift(skewed, series):
    plan = {"a": ("v", 1), "b": ("v", 4), "c": ("v", -3)}
    got = shifted(skewed, ["v", "id"], plan, series, chunk_rows=37)
    w = Window.partitionBy(*series).orderBy("v", "id")
    want = skewed.withColumns({n: F.lag(c, k).over(w) for n, (c, k) in plan.items()})
    cols = ["id", *plan]
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))


def test_shift_needs_chunks_longer_than_its_reach(skewed):
    with pytest.raises(ValueError):
        shifted(skewed, ["id"], {"a": ("v", 9)}, chunk_rows=5)


def test_empty_and_single_row(spark, skewed):
    empty = skewed.limit(0)
    assert spread.rank_by_order(empty, ["id"]).count() == 0
    assert spread.rank_by_hash(empty, "id").count() == 0
    assert spread.exact_quantiles(empty, {"q": ("v", 0.5)}).first()["q"] is None
    one = spark.range(1).withColumn("v", F.lit(4.0))
    assert spread.exact_quantiles(one, {"q": ("v", 0.9)}).first()["q"] == 4.0
