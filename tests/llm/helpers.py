"""Awkward inputs that every operator must take."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ["key", "row", "id", "hash", "label", "size", "bucket", "gram", "start", "end", "words", "grams", "n", "spans", "template", "place", "rank", "part", "score", "of"]


def documents(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
