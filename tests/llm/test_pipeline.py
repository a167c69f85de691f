"""The pipeline over awkward tables: nulls, empty texts, repeated rows, clashing names, no rows at all."""

from collections import defaultdict

import pytest

import corpus_pipeline
from gable.runtime import written
from tests.llm.helpers import documents, with_clashes

ITEM = "Which of the seven old bridges over the northern river was closed after the flood of that long winter?"
PLAIN = "the harbour office keeps a list of ships that leave before noon and of those that stay until the evening tide"


def tables(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    marks = [(0, 1, 0), (1, 0, 1), (None, 1, 1), (3, None, None)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, as run() applies them."""
    texts = [PLAIN, "a you idiot", None, "", f"so: {ITEM} Yes.", f"write to ann@example.org, {PLAIN[:60]}", PLAIN, PLAIN, "w " * 5000, None]
    docs = with_clashes(documents(spark, texts, [0, 1, 2, 3, 4, 5, 0, 7, 8, None]))
    sf_dir = tables(spark, tmp_path_factory.mktemp("awkward"), docs)
    kept, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        kept = written(stage(spark, kept, sf_dir))
        out.append(kept)
    return docs, out


def test_stages_keep_the_columns_and_their_decisions_take_effect(stages):
    docs, out = stages
    assert all(found.columns == docs.columns for found in out[:-1])
    _, distinct, clean, redacted, _ = ([r.asDict() for r in found.collect()] for found in out)
    assert sum(r["text"] == PLAIN for r in distinct) == 1
    assert 4 in {r["doc_id"] for r in distinct} and 4 not in {r["doc_id"] for r in clean}
    assert {0, 5, 8} <= {r["doc_id"] for r in clean} and len(redacted) == len(clean)
    assert not any("ann@example.org" in (r["text"] or "") for r in redacted)
    assert any(r["doc_id"] == 5 and PLAIN[:60] in r["text"] for r in redacted)


def test_pieces_hold_every_id_of_what_is_kept(stages):
    _, out = stages
    pieces = defaultdict(list)
    for r in out[-1].collect():
        pieces[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
    assert set(pieces) == {r["doc_id"] for r in out[-2].collect()}
    for i, parts in pieces.items():
        at = 0
        for start, length, total in sorted(parts):
            assert start == at, i
            at += length
        assert at == total


def test_no_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, documents(spark, []))).collect() == []
