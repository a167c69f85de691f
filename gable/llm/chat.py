"""Perspective rotation of dialogues, with DataFrame functions only.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant, all others as named
users, and a mask that covers the speaker's own words. System turns stay system messages and are no participant.

A dialogue is rendered in parts of at most PART turns, so that no group grows with the data: turns are ranked within
their conversation by a distributed ordering that may cut any conversation, and a part is the rank divided by PART. The
rendered parts of a speaker, one after the other, are the whole rendering. Copying a turn once per speaker is the output
itself.

Order: turn (nulls first), then speaker, then text; repeated rows are turns of their own. A null role is the speaker
"unknown", a null text an empty turn, rows with a null conv_id form one conversation with a null id. A conversation of
system turns alone has no rows. Control markers inside texts or roles are broken up by a space. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gable.operators.spread import rank_by_order

PART = 64
SYSTEM = "system"
# The markers of the chat format.
OPEN, CLOSE, END = "<|", "|>", "<|end|>"


def _plain(c: Column) -> Column:
    return F.replace(c, F.lit(OPEN), F.lit("< |"))


def rotate(turns: DataFrame, part_turns: int = PART) -> DataFrame:
    """conv_id, speaker, part, n_turns, text and mask (array of start, end in characters of text, end exclusive)."""
    rows = turns.select(
        turns["conv_id"].cast("long").alias("conv_id"),
        turns["turn"].cast("long").alias("turn"),
        F.coalesce(_plain(turns["role"].cast("string")), F.lit("unknown")).alias("role"),
        F.coalesce(_plain(turns["text"].cast("string")), F.lit("")).alias("text"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", F.md5("text"), F.monotonically_increasing_id()]
    ranked = rank_by_order(rows, order, ["conv_id"], "rank")
    placed = ranked.select("conv_id", "role", "text", "rank", F.expr(f"(rank - 1) div {part_turns}").alias("part"))
    # One row per conversation and role: a small side, so that a long conversation can be split by the join.
    speakers = placed.where(F.col("role") != SYSTEM).groupBy("conv_id", "role").agg(F.count(F.lit(1)).alias("said"))
    speakers = speakers.select(F.col("conv_id").alias("of"), F.col("role").alias("speaker"))
    views = placed.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))
    own = F.col("role") == F.col("speaker")
    head = F.when(own, f"{OPEN}assistant{CLOSE}\n").when(F.col("role") == SYSTEM, f"{OPEN}system{CLOSE}\n")
    head = head.otherwise(F.concat(F.lit(f"{OPEN}user name="), "role", F.lit(f"{CLOSE}\n")))
    said = F.concat("text", F.lit(END))
    turn = F.struct("rank", own.alias("own"), head.alias("head"), said.alias("said"))
    parts = views.groupBy("conv_id", "speaker", "part").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    empty = "struct(0L as at, cast(array() as array<struct<start:bigint,end:bigint>>) as spans)"
    after = "s.at + char_length(t.head) + char_length(t.said)"
    span = f"named_struct('start', s.at + char_length(t.head), 'end', {after})"
    # The newline between turns counts one character.
    mask = f"aggregate(turns, {empty}, (s, t) -> struct({after} + 1 as at, if(t.own, array_append(s.spans, {span}), s.spans) as spans), s -> s.spans)"
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["said"])), "\n")
    return parts.select("conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"), F.concat(text, F.lit("\n")).alias("text"), F.expr(mask).alias("mask"))


SQL = f"""
WITH rows AS (SELECT conv_id, turn, coalesce(replace(role, '{OPEN}', '< |'), 'unknown') AS role, coalesce(replace(text, '{OPEN}', '< |'), '') AS text
  FROM conversations),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS rank FROM rows),
speakers AS (SELECT DISTINCT conv_id AS of, role AS speaker FROM rows WHERE role <> '{SYSTEM}'),
views AS (SELECT conv_id, speaker, (rank - 1) // {PART} AS part, rank, role = speaker AS own, text || '{END}' AS said,
  CASE WHEN role = speaker THEN '{OPEN}assistant{CLOSE}\n' WHEN role = '{SYSTEM}' THEN '{OPEN}system{CLOSE}\n'
  ELSE '{OPEN}user name=' || role || '{CLOSE}\n' END AS head FROM placed JOIN speakers ON conv_id IS NOT DISTINCT FROM of),
ends AS (SELECT *, sum(length(head) + length(said) + 1) OVER (PARTITION BY conv_id, speaker, part ORDER BY rank) - 1 AS stop FROM views)
SELECT conv_id, speaker, part, count(*) AS n_turns, string_agg(head || said, '\n' ORDER BY rank) || '\n' AS text,
  coalesce(string_agg((stop - length(said))::BIGINT || ':' || stop::BIGINT, ',' ORDER BY rank) FILTER (own), '') AS mask
FROM ends GROUP BY conv_id, speaker, part"""
