import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gable.llm import packing
from gable.llm.packing import Bins, cut, default_tokenizer, digest, encoder_for, pack
from gable.llm.queries import QUERIES
from tests.llm.helpers import documents, with_clashes

TEXTS = [
    None, "", " ", "plain words here", "don't I'll WE'VE it's", "a  b \n\n c\t\td ", "x_y __ 12 3² ½ Ⅷ ①", "naïve café ÀÉ ß ÿ × ÷",
    "日本語 текст with ’quotes’ and 😀😀", "tail spaces   ", "\x00\x01 \x1c \x85 \xa0 z", "<|endoftext|> marker", "word " * 9000, "a" * 5000, "\n" * 50 + "x", "same", "same",
]


def whole_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer()).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_encoder_equals_the_tokenizer(text):
    assert np.frombuffer(encoder_for(default_tokenizer()).encode(text or ""), "<u4").tolist() == whole_ids(text)


def test_pieces_round_trip_and_fill_sequences(spark):
    docs = with_clashes(documents(spark, TEXTS)).repartition(3)
    pieces = pack(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
        assert len(p["ids"]) == p["length"] and zlib.crc32(np.array(p["ids"], "<u4").tobytes()) == p["ids_crc32"]
    for i, text in enumerate(TEXTS):
        parts = sorted(by_doc[i], key=lambda p: p["start"])
        ids = [x for p in parts for x in p["ids"]]
        assert ids == [*whole_ids(text), 1]
        assert [p["start"] for p in parts] == [sum(q["length"] for q in parts[:k]) for k in range(len(parts))]
        assert {p["doc_tokens"] for p in parts} == {len(ids)}
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p["offset"])
        total = sum(p["length"] for p in parts)
        assert total <= 2048 and total & (total - 1) == 0
        assert [p["offset"] for p in parts] == [sum(q["length"] for q in parts[:k]) for k in range(len(parts))]
        assert len({p["length"] for p in parts}) == 1


def test_cut_and_bins():
    for n in range(1, 300):
        parts = list(cut(n, 64))
        assert sum(length for _, length in parts) == n and all(length & (length - 1) == 0 for _, length in parts)
    with pytest.raises(ValueError):
        Bins(100, 0)
    bins = Bins(8, 5)
    assert bins.add(4, ("a",)) == [] and bins.add(4, ("b",)) == [("a", 5, 0), ("b", 5, 4)]
    assert bins.add(2, ("c",)) == [] and bins.rest() == [("c", 6, 0)] and bins.rest() == []


def test_empty_table(spark):
    assert pack(documents(spark, [])).collect() == []


def test_the_last_stage_gives_the_ids(spark, sf_dir):
    pieces = corpus_pipeline.packing_stage(spark, documents(spark, TEXTS), sf_dir).collect()
    for i, text in enumerate(TEXTS):
        parts = sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"])
        assert [x for p in parts for x in p["ids"]] == [*whole_ids(text), 1]


def test_digest_is_of_the_ids(spark, sf_dir, monkeypatch):
    pieces = pack(documents(spark, TEXTS))
    plain = pieces.drop("ids")
    found = digest(pieces.withColumn("ids_crc32", F.lit(0).cast("long")))
    assert found.columns == plain.columns and sorted(found.collect()) == sorted(plain.collect())
    asked = []
    monkeypatch.setattr(packing, "pack", lambda docs, *a, **k: asked.append(k.get("with_ids", True)) or pack(docs, *a, **k))
    assert "ids" not in QUERIES["op3_harmonic_packing"](spark, sf_dir).columns and asked == [True]
