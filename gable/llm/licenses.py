"""License scan by diagonal voting, with DataFrame functions only.

Every text is cut into words. The hash of each run of K_SHORT and of K_LONG words is joined with the positions of such
runs in a fixed set of templates. A match votes for its diagonal, the text position minus the template position: one
alignment of the template with the text. Votes are counted per diagonal. Diagonals of long templates that lie within
MERGE of the next one (a few words put in or left out) form one alignment. It is verified by the share of the template's
words that its matches cover: phrases must be whole, long templates need MIN_COVER.

The templates are a constant of the module, so the broadcast side has a fixed size. One text's matches are bounded by its
length; texts are aggregated apart from each other, also when ids repeat. Null texts count as empty. Rows are returned one
for one; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gable.llm.rows import text_of

K_SHORT, K_LONG = 2, 4
MERGE = 3
MIN_COVER = 0.6

# Phrases and opening sentences of common licenses, in lower-case words.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
LONG = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under the creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
]
TEMPLATES = [(label, text.split(), K_SHORT, True) for label, text in PHRASES] + [(label, text.split(), K_LONG, False) for label, text in LONG]
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_grams() -> list[tuple[int, int, list[str]]]:
    """(template, position, words) of every run of words."""
    return [(t, p, words[p : p + k]) for t, (_, words, k, _) in enumerate(TEMPLATES) for p in range(len(words) - k + 1)]


def _templates(spark: SparkSession) -> DataFrame:
    grams = spark.createDataFrame(template_grams(), "template int, tpos int, words array<string>")
    h = [F.xxhash64(F.col("words")[i]) for i in range(K_LONG)]
    short, pair = F.xxhash64(h[0], h[1]), F.xxhash64(F.xxhash64(h[0], h[1]), F.xxhash64(h[2], h[3]))
    hashed = grams.select(F.when(F.size("words") == K_SHORT, short).otherwise(pair).alias("gram"), "template", "tpos")
    every = spark.range(1).select(F.lit(0).cast("long").alias("gram"), F.lit(-1).alias("template"), F.lit(0).alias("tpos"))
    return hashed.unionByName(every)


def matches(docs: DataFrame) -> DataFrame:
    """row, doc_id, n_words, template, tpos and wpos of each match, and for each text one row of template -1."""
    # The Kelvin sign is the only other character whose lower case is an ASCII letter; it stays a letter of its own.
    lower = F.lower(F.replace(text_of(docs), F.lit("K"), F.lit("ĸ")))
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.array_remove(F.split(lower, SEPARATORS), "").alias("words"))
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").alias("n_words"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    pairs = F.zip_with(F.slice("h", 1, F.greatest(F.size("h") - 1, F.lit(0))), F.slice("h", 2, F.greatest(F.size("h") - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    rows = rows.select("row", "doc_id", "n_words", pairs.alias("short"))
    left = F.greatest(F.size("short") - 2, F.lit(0))
    fours = F.zip_with(F.slice("short", 1, left), F.slice("short", 3, left), lambda a, b: F.xxhash64(a, b))
    rows = rows.select("row", "doc_id", "n_words", F.concat(F.array(F.lit(0).cast("long")), "short", fours).alias("grams"))
    grams = rows.select("row", "doc_id", "n_words", F.posexplode("grams").alias("place", "gram"))
    n_short = F.greatest(F.col("n_words") - 1, F.lit(0))
    wpos = F.when(F.col("place") <= n_short, F.col("place") - 1).otherwise(F.col("place") - 1 - n_short)
    hit = grams.join(F.broadcast(_templates(docs.sparkSession)), "gram")
    # A text's own hash could be 0; only the first place stands for the whole text.
    return hit.where((F.col("template") >= 0) | (F.col("place") == 0)).select("row", "doc_id", "n_words", "template", "tpos", wpos.alias("wpos"))


def _per_template(values: dict[int, object], of: str = "template"):
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col(of))


def alignments(hits: DataFrame) -> DataFrame:
    """Verified alignments: row, template, label, base, start and end (words, end exclusive), cover; and the rows of template -1."""
    near = hits.repartition("row")
    diagonals = near.groupBy("row", "doc_id", "n_words", "template", (F.col("wpos") - F.col("tpos")).alias("diagonal")).agg(
        F.collect_set("tpos").alias("at"), F.min("wpos").alias("first"), F.max("wpos").alias("last")
    )
    order = W.partitionBy("row", "template").orderBy("diagonal")
    apart = _per_template({t: (1 if base else MERGE) for t, (_, _, _, base) in enumerate(TEMPLATES)} | {-1: 0})
    starts = F.when(F.col("diagonal") - F.lag("diagonal").over(order) < apart, 0).otherwise(1)
    grouped = diagonals.withColumn("new", starts).withColumn("group", F.sum("new").over(order))
    merged = grouped.groupBy("row", "doc_id", "n_words", "template", "group").agg(
        F.flatten(F.collect_list("at")).alias("at"), F.min("first").alias("start"), F.max("last").alias("last")
    )
    k = _per_template({t: kk for t, (_, _, kk, _) in enumerate(TEMPLATES)} | {-1: 1})
    size = _per_template({t: len(w) for t, (_, w, _, _) in enumerate(TEMPLATES)} | {-1: 1})
    words = F.size(F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + F.col("k") - 1)))))
    sized = merged.withColumn("k", k).withColumn("cover", words / size)
    base = F.col("template").isin([t for t, x in enumerate(TEMPLATES) if x[3]])
    good = sized.where((F.col("template") < 0) | F.when(base, F.col("cover") == 1).otherwise(F.col("cover") >= MIN_COVER))
    label = _per_template({t: x[0] for t, x in enumerate(TEMPLATES)} | {-1: ""})
    return good.select("row", "doc_id", "n_words", "template", label.alias("label"), base.alias("base"), "start", (F.col("last") + F.col("k")).alias("end"), "cover")


def scan(docs: DataFrame) -> DataFrame:
    """One row per text: words, places of the phrases, labels, the best cover, and the spans of all alignments."""
    found = F.col("template") >= 0
    span = F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "label", "cover")
    phrase = F.when(F.col("base"), F.col("start").cast("long"))
    grouped = alignments(matches(docs)).groupBy("row", "doc_id", "n_words").agg(
        F.count(phrase).alias("n_base"),
        F.min(phrase).alias("first_word"),
        F.max(phrase).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(found, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(found, F.round("cover", 6))), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(found, span))).alias("spans"),
    )
    return grouped.withColumn("n_words", F.col("n_words").cast("long")).drop("row")


def _sql() -> str:
    lit = lambda x: "'" + x + "'"
    grams = ", ".join(f"({t}, {p}, {lit(' '.join(g))})" for t, p, g in template_grams())
    kinds = ", ".join(f"({t}, {lit(x[0])}, {len(x[1])}, {x[2]}, {str(x[3]).lower()})" for t, x in enumerate(TEMPLATES))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH grams(template, tpos, gram) AS (VALUES {grams}),
kinds(template, label, n, k, base) AS (VALUES {kinds}),
texts AS (SELECT row_number() OVER () AS id, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
places AS (SELECT id, words, unnest(range(0, len(words))) AS wpos FROM texts),
runs AS (SELECT id, wpos, array_to_string(words[wpos + 1 : wpos + {K_SHORT}], ' ') AS gram FROM places WHERE wpos + {K_SHORT} <= len(words)
  UNION ALL SELECT id, wpos, array_to_string(words[wpos + 1 : wpos + {K_LONG}], ' ') FROM places WHERE wpos + {K_LONG} <= len(words)),
hits AS (SELECT id, template, tpos, wpos, wpos - tpos AS diagonal FROM runs JOIN grams USING (gram)),
diagonals AS (SELECT DISTINCT id, template, diagonal FROM hits),
marked AS (SELECT d.*, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY id, template ORDER BY diagonal) < CASE WHEN base THEN 1 ELSE {MERGE} END
  THEN 0 ELSE 1 END AS fresh FROM diagonals d JOIN kinds USING (template)),
grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY id, template ORDER BY diagonal) AS grp FROM marked),
covered AS (SELECT id, template, grp, min(wpos) AS start, list_distinct(flatten(list(range(tpos, tpos + k)))) AS words
  FROM hits JOIN grouped USING (id, template, diagonal) JOIN kinds USING (template) GROUP BY id, template, grp),
good AS (SELECT id, label, base, start, len(words) / n AS cover FROM covered JOIN kinds USING (template)
  WHERE CASE WHEN base THEN len(words) = n ELSE len(words) / n >= {MIN_COVER} END)
SELECT doc_id, len(any_value(words))::BIGINT AS n_words, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
  max(start) FILTER (base) AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(round(cover, 6)), 0.0)::DOUBLE AS score
FROM texts LEFT JOIN good USING (id) GROUP BY id, doc_id"""


SQL = _sql()
