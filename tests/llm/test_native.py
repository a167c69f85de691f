"""The operators written in DataFrame functions, on awkward rows; their queries are compared with SQL in test_queries."""

import pytest

from gable.llm import chat, licenses, rollups
from gable.runtime import scratch_path
from tests.llm.helpers import documents, with_clashes

TURNS = "conv_id long, turn long, role string, text string"


def test_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", "é"), (1, 2, "bob", "é"), (1, None, None, None), (2, 0, "system", "alone"), (None, 0, "x", "y")]
    found = {(r["conv_id"], r["speaker"]): r for r in chat.rotate(with_clashes(spark.createDataFrame(rows, TURNS))).collect()}
    assert set(found) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "x")}
    ann = found[1, "ann"]
    assert ann["text"] == "<|user name=unknown|>\n<|end|>\n<|system|>\nbe kind<|end|>\n<|assistant|>\nhi < |end|><|end|>\n<|user name=bob|>\né<|end|>\n<|user name=bob|>\né<|end|>\n"
    assert [ann["text"][s["start"] : s["end"]] for s in ann["mask"]] == ["hi < |end|><|end|>"]
    assert [found[1, "bob"]["text"][s["start"] : s["end"]] for s in found[1, "bob"]["mask"]] == ["é<|end|>"] * 2
    assert found[1, "unknown"]["n_turns"] == 5


def test_long_dialogues_come_in_parts(spark):
    rows = [(7, i // 2, ("a", "b")[i % 2], f"t{i}") for i in range(150)]
    whole = {r["speaker"]: r["text"] for r in chat.rotate(spark.createDataFrame(rows, TURNS), part_turns=1000).collect()}
    parts = sorted((r["speaker"], r["part"], r["text"], r["n_turns"]) for r in chat.rotate(spark.createDataFrame(rows, TURNS)).collect())
    assert [p[3] for p in parts if p[0] == "a"] == [64, 64, 22]
    assert {s: "".join(p[2] for p in parts if p[0] == s) for s in "ab"} == whole
    assert chat.rotate(spark.createDataFrame([], TURNS)).collect() == []


def test_licenses(spark):
    mit = licenses.LONG[0][1]
    texts = [
        None, "", "mit", "The MIT\nLicense, mit license", "Apache License and GENERAL public -- license", "general public x license",
        mit.replace("free of charge", "free and without any charge"), "permission is hereby granted", "word " * 3000 + "mit license", "mKt license", "Released under CC BY-NC 4.0, licensed under cc by nc 4.0",
    ]
    found = {r["doc_id"]: r for r in licenses.scan(with_clashes(documents(spark, texts))).collect()}
    assert (found[0]["n_words"], found[0]["n_base"], found[0]["labels"], found[0]["first_word"]) == (0, 0, "", None)
    assert (found[3]["n_base"], found[3]["first_word"], found[3]["last_word"], found[3]["base_labels"]) == (2, 1, 3, "mit")
    assert (found[4]["n_base"], found[4]["base_labels"], found[4]["labels"]) == (2, "apache,gpl", "apache,gpl")
    assert found[5]["n_base"] == 0 and found[7]["labels"] == ""
    assert (found[6]["base_labels"], found[6]["labels"]) == ("", "mit") and 0.6 <= found[6]["score"] < 1
    assert found[8]["first_word"] == 3000 and found[9]["n_base"] == 0 and "cc-by-nc" in found[10]["labels"]
    twice = licenses.scan(documents(spark, ["mit license", "mit license", "none"], [1, 1, None])).collect()
    assert sorted(r["n_base"] for r in twice) == [0, 1, 1]
    assert licenses.scan(documents(spark, [])).collect() == []


CHANGES = "kind string, source string, lang string, tokenizer string, n_tokens long, old_tokens long"


def test_rollup(spark):
    make = lambda *rows: with_clashes(spark.createDataFrame([(k, s, l, "v", n, o) for k, s, l, n, o in rows], CHANGES))  # noqa: E741, E731
    rollup = rollups.Rollup(spark, scratch_path(spark, "rollup"))
    assert rollup.totals().collect() == []
    first = make(("insert", "a", "en", 5, None), ("insert", "a", "en", 5, None), ("insert", None, None, None, None), ("insert", "b", "en", 7, None))
    assert rollup.commit("one", first) and not rollup.commit("one", first)
    rollup.compact()
    assert not rollup.commit("one", first)
    assert rollup.commit("two", make(("delete", "b", "en", 7, None), ("revise", "a", "en", 2, 5)))
    assert rollup.commit("none", make(("insert", "z", "z", 1, 1)).limit(0))
    want = {("a", "en", "v", 2, 7), (None, None, "v", 1, 0)}
    assert {tuple(r) for r in rollup.totals().collect()} == want
    rollup.compact()
    assert {tuple(r) for r in rollup.totals().collect()} == want and not rollup.commit("two", first)
    with pytest.raises(ValueError):
        rollup.commit("a/b", first)
    with pytest.raises(Exception, match="unknown kind"):
        rollup.commit("bad", make(("upsert", "a", "en", 1, 1)))
    # A batch that failed is not committed and can be sent again.
    assert rollup.commit("bad", make(("insert", "c", "en", 1, None)))


def test_lost_batch_is_written_again(spark):
    path = scratch_path(spark, "rollup")
    rollup = rollups.Rollup(spark, path)
    rows = spark.createDataFrame([("insert", "a", "en", "v", 5, None)], CHANGES)
    rollup.commit("one", rows)
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batches/one/_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).delete(marker, False)
    assert rollup.totals().collect() == [] and rollup.commit("one", rows)
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "v", 1, 5)]
