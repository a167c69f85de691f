"""Queries that run as streams over the files of a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from gable.operators import models as M
from gable.plans.property_view import table
from gable.plans.registry import query
from gable.runtime import scratch_path
from gable.streaming import jobs


@query(
    "stream_score",
    "L1 A11",
    """SELECT event_id, round((SELECT regr_intercept(value, user_id) FROM events) + (SELECT regr_slope(value, user_id) FROM events) * user_id, 5)
    AS prediction FROM events""",
)
def stream_score(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    fitted = M.linear_regressor(["user_id"], "value").fit(rows)
    stream = jobs.read_files(spark, f"{sf_dir}/events.parquet", rows.schema)
    scored = jobs.score_stream(stream, fitted.transform).select("event_id", F.round("prediction", 5).alias("prediction"))
    return jobs.run_available(scored, scratch_path(spark, "scored"))


@query(
    "stream_dedup",
    "L2 B18",
    """SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def stream_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    stream = jobs.read_files(spark, f"{sf_dir}/events.parquet", rows.schema)
    found = jobs.append_new(stream, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")], scratch_path(spark, "deduplicated"))
    return found.select("user_id", "event_type", "event_id", "value")
