import pytest
from pyspark.sql import functions as F

from gable.operators import models as M
from gable.runtime import scratch_path, shared_root
from gable.streaming import jobs


def test_only_new_files_are_scored(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df = spark.range(100).select(F.col("id").alias("unit_indx"), (F.col("id") * 2.0).alias("area"), (F.col("id") * 6.0).alias("price"))
    fitted = M.linear_regressor(["area"], "price").fit(df)
    df.filter("unit_indx < 60").write.parquet(source)
    stream = jobs.score_stream(jobs.read_files(spark, source, df.schema), fitted.transform).select("unit_indx", "prediction")
    assert jobs.run_available(stream, sink, state).count() == 60
    df.filter("unit_indx >= 60").write.mode("append").parquet(source)
    stream = jobs.score_stream(jobs.read_files(spark, source, df.schema, max_files=1), fitted.transform).select("unit_indx", "prediction")
    out = jobs.run_available(stream, sink, state)
    assert out.count() == 100
    want = fitted.transform(df).select("unit_indx", "prediction")
    assert out.exceptAll(want).count() == 0


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, setting, master, folder=None):
        self.sparkContext = FakeContext(master, folder)
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}


def test_shared_root_is_taken_from_the_session(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(shared_root(spark))
    cluster = FakeSession("hdfs://shared/here", "yarn")
    assert shared_root(cluster) == "hdfs://shared/here" and cluster.sparkContext.folder == "hdfs://shared/here"
    assert shared_root(FakeSession(None, "yarn", "hdfs://set/before")) == "hdfs://set/before"
    with pytest.raises(RuntimeError):
        shared_root(FakeSession(None, "yarn"))
    local = FakeSession(None, "local[2]")
    assert shared_root(local) == local.sparkContext.folder


def test_one_row_per_key_over_files_and_runs(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in.parquet", "out", "state"))
    schema = "k string, t long, v long"
    waves = [[("a", 5, 1), ("a", 3, 2), (None, 1, 3)], [("a", 1, 4), ("b", 9, 5)], [("b", 1, 6), ("c", 2, 7), (None, 0, 8)]]
    for rows in waves:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.read_files(spark, source, spark.createDataFrame([], schema).schema, max_files=1)
        found = jobs.append_new(stream, ["k"], [F.col("t")], sink, state)
    assert sorted((str(r["k"]), r["v"]) for r in found.collect()) == [("None", 3), ("a", 2), ("b", 5), ("c", 7)]


def test_a_folder_named_like_a_file_is_read_whole(spark, tmp_path):
    source = str(tmp_path / "events.parquet")
    spark.range(50).repartition(3).write.parquet(source)
    stream = jobs.read_files(spark, f"file://{source}", spark.range(1).schema)
    assert jobs.run_available(stream, str(tmp_path / "out")).count() == 50


def test_deduplicate(spark, tmp_path):
    df = spark.createDataFrame([(1, 0), (1, 5), (2, 9)], "unit_indx long, s int").withColumn("ts", F.timestamp_seconds("s"))
    df.write.parquet(str(tmp_path / "in"))
    stream = jobs.deduplicate_stream(jobs.read_files(spark, str(tmp_path / "in"), df.schema), ["unit_indx"], "ts")
    out = jobs.run_available(stream.select("unit_indx"), str(tmp_path / "out"))
    assert sorted(r[0] for r in out.collect()) == [1, 2]
    with pytest.raises(Exception):
        jobs.run_available(stream.select("nope"), str(tmp_path / "no"))
