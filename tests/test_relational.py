import datetime as dt

import pytest
from pyspark.sql import functions as F

from gable.functions import domain as D
from gable.operators import comparables as C
from gable.operators import prep as P
from gable.operators import profile as S
from gable.operators import relational as R
from gable.sources import readers, writers


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_floor_labels(spark):
    labels = ["NO DATA!", "NODATA!", "Basement", "Ground", "1st", "6th", "7th", "9th", "20th", "21st or above", "top floor", "mid floor", "8", "-1", "40", None]
    df = spark.createDataFrame([(x,) for x in labels], "f string")
    assert one(df, D.floor_level("f")) == [0, 0, -1, 0, 1, 6, None, 9, 20, 21, 22, 3, 8, -1, None, None]


def test_postcode_rules(spark):
    df = spark.createDataFrame([("E1 6AN",), ("EC4A 1AB",), ("NW1 2AB",), ("N7  8AB",)], "p string")
    assert one(df, D.postcode_outcode("p")) == ["E1", "EC4A", "NW1", "N7"]
    assert one(df, D.postcode_area(D.postcode_outcode("p"))) == ["E", "EC", "NW", "N"]
    assert one(df, D.postcode_area_by_cast("p")) == ["E", "EC", "NW", "N"]
    address = spark.createDataFrame([("1 High St E1 6AN",), ("X",)], "a string")
    assert one(address, D.postcode_from_address("a")) == ["E1 6AN", "X"]


def test_composite_key_prints_missing_as_nan(spark):
    df = spark.createDataFrame([("E", None), ("E", "Flat")], "a string, b string")
    assert one(df, D.composite_key("a", "b")) == ["E_nan", "E_Flat"]
    assert one(df, D.composite_key("a", "b", sep="")) == ["Enan", "EFlat"]


def test_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert one(df, D.round_half_even("x")) == [0.0, 2.0, 2.0]


def test_dates(spark):
    df = spark.createDataFrame([("5/20/20 0:00",), ("6/24/13",), ("nonsense",)], "s string")
    assert one(df, D.parse_timestamp("s")) == [dt.datetime(2020, 5, 20), dt.datetime(2013, 6, 24), None]


def test_two_digit_years(spark):
    df = spark.createDataFrame([(f"6/24/{y}",) for y in ("68", "69", "95", "00", "20")], "s string")
    years = [r[0].year for r in df.select(D.parse_timestamp("s")).collect()]
    assert years == [2068, 1969, 1995, 2000, 2020]
    whole = spark.createDataFrame([("2/29/2072 1:05",)], "s string").select(D.parse_timestamp("s", ["M/d/yyyy H:mm"]))
    assert whole.first()[0] == dt.datetime(2072, 2, 29, 1, 5)


def test_select_and_drop_check_names(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        R.select_columns(df, ["x"])
    with pytest.raises(ValueError):
        R.drop_columns(df, ["x"])


def test_drop_null_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 1)], "a int, b int, c int")
    assert R.drop_null_columns(df).columns == ["a", "c"]
    assert R.drop_null_columns(df, 0.5).columns == ["a"]
    assert R.drop_null_columns(df, 0).columns == ["a"]
    with pytest.raises(ValueError):
        R.drop_null_columns(df, 1.1)


def test_outliers_drop_missing_rooms_and_area_but_keep_missing_storeys(spark):
    rows = [(20000.0 + i, "3", None, "50") for i in range(100)]
    rows += [(20050.0, None, "2", "50"), (20050.0, "3", "2", None), (20050.0, "3", "25", "50"), (20050.0, "12", "2", "50")]
    df = spark.createDataFrame(rows, "Price_p double, NUMBER_HABITABLE_ROOMS_e string, FLAT_STOREY_COUNT_e string, TOTAL_FLOOR_AREA_e string")
    out = R.drop_outliers(df)
    assert out.filter("FLAT_STOREY_COUNT_e IS NOT NULL").count() == 0
    # 104 prices: one to two rows at the low end, then two cuts at the high end.
    assert 94 <= out.count() <= 97
    assert R.drop_outliers(df.limit(0)).count() == 0


def test_ensure_double_types(spark):
    df = spark.createDataFrame([(1, "2", "x", True)], "unit_indx int, a string, b string, c boolean")
    out = R.ensure_double_types(df)
    assert out.columns == ["a", "c"] and out.first().asDict() == {"a": 2.0, "c": 1.0}


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([(1, 5, 10, "a"), (1, 7, 12, "b"), (1, 7, 11, "c"), (2, 1, 13, None)], "k int, t int, i int, v string")
    assert {r["k"]: r["v"] for r in R.latest_per_key(df, ["k"], "t", "i").collect()} == {1: "c", 2: None}
    assert {r["k"]: r["i"] for r in R.first_per_key(df, ["k"], [F.col("t"), F.col("i")]).collect()} == {1: 10, 2: 13}


def test_rare_keys_salted_and_plain(spark):
    df = spark.range(100).withColumn("k", F.when(F.col("id") < 90, "hot").when(F.col("id") < 95, "five").otherwise(None))
    assert R.remove_rare_keys(df, ["k"], 5).count() == 90
    assert R.remove_rare_keys(df, ["k"], 5).count() == 90


def test_sample_rows_is_exact_and_reproducible(spark):
    df = spark.range(1000)
    picked = {r[0] for r in R.sample_rows(df, 37, "id", 1).collect()}
    assert len(picked) == 37 and picked == {r[0] for r in R.sample_rows(df.repartition(5), 37, "id", 1).collect()}


def test_problem_type(spark):
    df = spark.createDataFrame([(float(i), str(i % 3), i % 2, 1) for i in range(20)], "a double, b string, c int, d int")
    assert [S.detect_problem_type(df, c) for c in "abc"] == ["regression", "multiclass", "binary"]
    with pytest.raises(ValueError):
        S.detect_problem_type(df, "d")


def test_distribution_counts_null_rows(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,)], "t string")
    assert [tuple(r) for r in S.target_distribution(df, "t").collect()] == [("x", "66.67%")]


def test_lookup_of_single_row_group(spark):
    df = spark.createDataFrame([("p", 1.0, 10.0), ("q", 2.0, 20.0), ("q", 4.0, 30.0)], "k string, area double, price double")
    rows = {r["k"]: r for r in C.build_lookup(df, ["k"], ["area"], "price").collect()}
    assert rows["p"]["area__std"] is None and rows["q"]["area__median"] == 3.0 and rows["q"]["density_count"] == 2
    unseen = spark.createDataFrame([("z", 5.0)], "k string, area double")
    out = C.comparables_features(unseen, C.build_lookup(df, ["k"], ["area"], "price"), ["k"], ["area"]).first()
    assert out["area_minus_mean"] is None and out["price__mean"] is None


def test_neighbourhood_against_brute_force(spark):
    spots = [(i, 0.9 + (i % 13) * 7e-6, -0.002 + (i % 17) * 9e-6, float(i)) for i in range(300)]
    df = spark.createDataFrame(spots, "id int, lat double, lon double, v double")
    boxes = df.select("lat", "lon", D.lat_min("lat").alias("a"), D.lat_max("lat").alias("b"), D.lon_min("lat", "lon").alias("c"), D.lon_max("lat", "lon").alias("d"))
    want = {}
    for r in boxes.distinct().collect():
        near = [s for s in spots if r["a"] <= s[1] <= r["b"] and r["c"] <= s[2] <= r["d"]]
        want[(r["lat"], r["lon"])] = (len(near), sum(s[3] for s in near) / len(near))
    got = {(r["lat"], r["lon"]): (r["n_nearby"], r["mean_nearby"]) for r in C.neighbourhood_stats(df, "lat", "lon", "v").collect()}
    assert got.keys() == want.keys()
    assert max(w[0] for w in want.values()) > min(w[0] for w in want.values())
    for k, (n, mean) in want.items():
        assert got[k][0] == n and got[k][1] == pytest.approx(mean)


RAW = """Price_p double, Postcode string, FULLADRESS_e string, TypeOfMatching_m string, NUMBER_HABITABLE_ROOMS_e string,
NUMBER_HEATED_ROOMS_e string, FLAT_STOREY_COUNT_e string, TOTAL_FLOOR_AREA_e string, FLOOR_LEVEL_e string, PROPERTY_TYPE_e string,
POSTTOWN_e string, Latitude_m double, Longitude_m double"""


def raw(spark, n=300):
    rows = []
    for i in range(n):
        kind = None if i % 50 == 0 else ("Flat" if i % 2 else "House")
        match = "4. Other" if i % 10 == 9 else D.MATCH_TYPES[i % 3]
        rows.append((50000.0 + i * 100, f"E{i % 3} {i % 9}AB", f"{i} Road E{i % 3} {i % 9}AB", match, "3", None if i % 4 else "2", None, str(40 + i % 30), "Ground", kind, "LONDON", 51.0, -0.1))
    return spark.createDataFrame(rows, RAW)


def test_prepare_numbers_rows_and_filters(spark):
    out = P.prepare(raw(spark), order=["Price_p"])
    assert out.columns == ["unit_indx", *P.PREPARED, "Price_p"]
    ids = sorted(one(out, "unit_indx"))
    assert ids == list(range(len(ids)))
    assert out.filter("PROPERTY_TYPE_e IS NULL OR NUMBER_HEATED_ROOMS_e IS NULL").count() == 0
    assert "No PROPERTY_TYPE_e" in one(out, "PROPERTY_TYPE_e")
    with pytest.raises(ValueError):
        P.prepare(raw(spark))


def test_prepare_and_split_parts_are_disjoint(spark):
    out = P.prepare_and_split(raw(spark), order=["Price_p"])
    n = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert set(n) == {"train", "test", "validate"}
    assert out.select("unit_indx").distinct().count() == out.count()
    assert n["test"] / (n["train"] + n["test"]) == pytest.approx(0.15, abs=0.05)


def test_prepared_rows_conform_to_the_schema(spark):
    out = readers.conform(P.prepare(raw(spark), order=["Price_p"]))
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in readers.PROPERTY_SCHEMA.fields]
    filled = readers.with_fill_values(readers.conform(spark.range(2).select(F.col("id").alias("unit_indx"))))
    assert filled.first()["Price_p"] == -1.0 and filled.first()["POSTCODE"] == "None"


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, float("nan"), "b"), (3, 1.0, "c")], "id int, y double, c string")
    path = writers.write_csv(df, str(tmp_path / "csv"))
    x, y = readers.load_data(spark, path, "id", "y", n_rows=2, drop=["c"], verbose=True)
    assert x.columns == ["id"] and x.count() == 2 and y.columns == ["id", "y"]
    assert y.filter("y IS NULL").count() == 1
    for year, frame in ((2019, df), (2020, df.drop("c"))):
        frame.write.parquet(str(tmp_path / f"y{year}"))
    both = readers.read_years(spark, str(tmp_path / "y{year}"), [2019, 2020])
    assert both.count() == 6 and both.filter("c IS NULL").count() == 3 and both.filter("y IS NULL").count() == 2
    days = str(tmp_path / "dated")
    writers.save_dated_output(df, days, "2021-02-07")
    writers.save_dated_output(df.limit(1), days, "2021-02-08")
    assert writers.save_dated_output(df.limit(2), days, "2021-02-07").count() == 2
    assert spark.read.parquet(days).count() == 3
    table = writers.replace_table(df, "gable_test_table", str(tmp_path / "t"))
    assert writers.replace_table(df.limit(1), "gable_test_table", str(tmp_path / "t")).count() == 1 and table is not None
