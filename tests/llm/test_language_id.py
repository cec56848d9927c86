from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from dumpwise.llm import language_id as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = L.predictions(docs).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_filter_returns_all_languages_that_contain_a_gram(spark):
    docs = spark.createDataFrame([("abcd abcd xyzw xyzw", "one"), ("abcd abcd qrst qrst", "two"), (None, "three"), ("none", None)], "text string, lang string")
    model = L.train(docs)
    assert sorted(model.languages) == ["one", "two"]

    def languages(gram):
        code = L.gram_codes(np.frombuffer(gram, np.uint8))
        hits = model.hits(code, np.array([0]))[0]
        return {model.languages[i] for i in np.flatnonzero(hits)}

    assert languages(b"abcd") == {"one", "two"} and languages(b"xyzw") == {"one"} and languages(b"qrst") == {"two"}


def test_more_languages_than_one_mask_holds(spark):
    words = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}{chr(97 + i % 7)}{chr(97 + i % 5)}" for i in range(150)]
    docs = spark.createDataFrame([(i, " ".join([w] * 5), f"l{i}") for i, w in enumerate(words)], "doc_id long, text string, lang string")
    got = docs.select("lang", L.language_of(F.col("text"), L.train(docs), spark).alias("found")).collect()
    assert all(r["found"]["lang"] == r["lang"] for r in got)


def test_edges(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(1, None, "en", ""), (2, "", "en", ""), (3, "123 $$$", "en", ""), (4, "hello there my friend hello", "en", ""), (4, "hello there my friend hello", "en", ""), (5, "bonjour mon ami bonjour", "fr", ""),
            (6, "hello my friend " * 30_000, None, ""), (7, "Ωmega", None, ""), (None, "bonjour mon ami bonjour", "fr", ""), (8, "hello there bonjour hello there", "en", "")]
    got = [(r["doc_id"], r["lang_pred"]) for r in L.predictions(spark.createDataFrame(rows, schema)).collect()]
    assert {(1, "und"), (2, "und"), (3, "und"), (5, "fr"), (6, "en")} <= set(got) and got.count((4, "en")) == 2
    assert L.predictions(spark.createDataFrame([], schema)).count() == 0
    assert [r["lang_pred"] for r in L.predictions(spark.createDataFrame([(1, "abc", None, "")], schema)).collect()] == ["und"]
