"""Every query of the subpackage next to its SQL or to the shape its contract asks for, and the pipeline by brute force."""

import pytest

import corpus_pipeline
from gable.llm import decontamination, neardup, packing, pii, toxicity
from gable.llm.queries import QUERIES, SQL
from tests.compare import connect, difference, rows_of_spark, rows_of_sql


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(rows_of_spark(QUERIES[name](spark, sf_dir)), rows_of_sql(connect(sf_dir), SQL[name])) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"op3_harmonic_packing", "op8_template_leaks", "op12_cholesky_whitening"}))
def test_one_row_per_document(spark, sf_dir, name):
    ids = [r["doc_id"] for r in QUERIES[name](spark, sf_dir).select("doc_id").collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect())


def test_pipeline_equals_plain_steps(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = {i: t for i, t in rows.items() if toxicity.scorer(model)([t])[0] < 0.5}

    from tests.llm.test_neardup import brute

    ids = sorted(rows)
    label = brute([rows[i] for i in ids])
    rows = {i: rows[i] for k, i in enumerate(ids) if label[k] == k}
    bad = decontamination.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    for r in bad.collect():
        rows.pop(r["doc_id"], None)
    encoder = packing.encoder_for(packing.default_tokenizer())
    want = {i: len(encoder.encode(pii.redact(t, pii.find(t)))) // 4 + 1 for i, t in rows.items()}
    found = corpus_pipeline.run(spark, sf_dir).select("doc_id", "doc_tokens").distinct().collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in found} == want
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert neardup.SIMILARITY == 0.8
