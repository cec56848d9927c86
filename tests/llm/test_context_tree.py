from __future__ import annotations

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dumpwise.llm import context_tree as T
from dumpwise.llm.common import limited_batches
from dumpwise.llm.language_id import fold_of

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, held boolean"


def stream(text):
    data = bytes([255] * T.DEPTH) + (text or "").encode().lower() + b"\xff"
    for i in range(T.DEPTH, len(data)):
        for k in range(8):
            yield data[i - T.DEPTH : i], (1 << k) | (data[i] >> (8 - k)), (data[i] >> (7 - k)) & 1


def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)


def weighted(events, d=0):
    """ln Pw of a node by its definition: ``events`` are its (context, bit) pairs."""
    if not events:
        return 0.0
    own = kt(sum(1 for _, x in events if not x), sum(1 for _, x in events if x))
    if d == T.DEPTH:
        return own
    parts = {}
    for context, bit in events:
        parts.setdefault(context[-1 - d], []).append((context, bit))
    below = sum(weighted(p, d + 1) for p in parts.values())
    top = max(own, below)
    return top + math.log(math.exp(own - top) + math.exp(below - top)) - math.log(2)


def brute(docs):
    trees = {}
    for _, text, held in docs:
        if not held:
            for context, path, bit in stream(text):
                trees.setdefault(path, []).append((context, bit))
    memo = {p: weighted(e) for p, e in trees.items()}
    words = Counter(w for _, t, held in docs if not held for w in [*(t or "").encode().lower().split(), None])
    n, v = sum(words.values()), len(words)
    out = []
    for doc, text, _ in docs:
        # the next bit's probability is the growth of the root's Pw
        lp = sum(weighted([*trees.get(p, []), (c, b)]) - memo.get(p, 0.0) for c, p, b in stream(text))
        tokens = [*(text or "").encode().lower().split(), None]
        out.append((doc, len(tokens), sum(words[t] > 0 for t in tokens), n, sum(math.log10((words[t] + 1) / (n + v + 1)) for t in tokens), lp / math.log(10)))
    return sorted(out)


DOCS = [(1, "the cat the hat", False), (2, "The cat", True), (3, None, False), (4, "", True), (5, "é\tthe", False), (6, "zzz the", True)]


def run(spark, docs, **options):
    rows = T.score(spark.createDataFrame(docs, SCHEMA), F.col("held"), **options).collect()
    return sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows)


@pytest.mark.parametrize("block_bytes", [16 << 20, 12])
def test_matches_the_definition(spark, block_bytes):
    for got, want in zip(run(spark, DOCS, block_bytes=block_bytes), brute(DOCS), strict=True):
        assert got == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_nothing_learned_and_empty(spark):
    got = run(spark, [(1, "ab", True), (1, "ab", True)])
    assert got == [pytest.approx((1, 2, 0, 0, 0.0, -24 * math.log10(2)))] * 2
    assert run(spark, []) == []


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 7.25, 100.5, 1e6, 3e9])
    assert T.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-11, abs=1e-11)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = T.score(df, fold_of("doc_id", 7) == 2).collect()
    assert len(rows) == df.count()
    assert {r["doc_id"] for r in rows if r["held_out"]} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2}
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rows_of_one_id_are_spread_over_blocks(spark):
    docs = spark.createDataFrame([(None, f"text {i}") for i in range(2000)], "doc_id long, text string")
    sizes = [r["count"] for r in docs.groupBy(T.block_of(10).alias("block")).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 300


@pytest.mark.parametrize("one_id", [None, 7])
def test_scores_of_rows_that_share_an_id(spark, one_id):
    def scores(docs):
        rows = T.score(spark.createDataFrame(docs, SCHEMA), F.col("held"), block_bytes=12).collect()
        return sorted((r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 9), round(r["score"], 9)) for r in rows)

    assert scores([(one_id, text, held) for _, text, held in DOCS]) == scores(DOCS)


def peak(work):
    """Most bytes held while ``work`` runs, and what it returns."""
    tracemalloc.start()
    try:
        found = work()
        return tracemalloc.get_traced_memory()[1], found
    finally:
        tracemalloc.stop()


def test_tables_are_small_and_answer_every_key():
    keys = np.unique(np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 300_000)) & ~np.int64(0xFFF)
    keys = np.concatenate([np.unique(keys), np.arange(1000)])
    table = T._Table(keys, keys * 0.5)
    assert (table(keys[::-1]) == keys[::-1] * 0.5).all()
    assert sum(x.nbytes for x in vars(table).values() if isinstance(x, np.ndarray)) <= 25 * len(keys)
    alone = T._Table(np.array([T.END_KEY]), np.array([3.0]))
    assert alone(np.array([T.END_KEY, T.END_KEY])).tolist() == [3.0, 3.0]


def test_a_slot_of_many_keys_is_answered():
    inverse = pow(0x9E3779B97F4A7C15, -1, 1 << 64)
    keys = np.array([i * inverse % (1 << 64) for i in range(1000)], np.uint64).view(np.int64)  # hashes 0 to 999
    assert (T._Table(keys, np.arange(1000.0))(keys[::-1]) == np.arange(1000.0)[::-1]).all()


def test_a_block_is_tallied_without_its_texts(monkeypatch):
    monkeypatch.setattr(T, "SLICE", 1 << 16)
    monkeypatch.setattr(T, "PENDING", 1 << 12)
    texts = [4 * f"word{i % 50} and {i % 7} others {'again ' * (i % 5)}".encode() for i in range(60_000)]

    def tally():
        block = T.BlockTally()
        for i, text in enumerate(texts):
            block.add(bytes(bytearray(text)), i % 3 > 0)
        return {kind: dict(zip(keys.tolist(), counts.tolist())) for kind, keys, counts in block.totals()}

    most, found = peak(tally)
    assert most < 0.8 * sum(map(len, texts))
    want = Counter({k: 0 for keys, _ in T.word_keys(texts) for k in keys.tolist()} | {T.END_KEY: 0})
    for keys, _ in T.word_keys(texts[1::3] + texts[2::3]):
        want.update(keys.tolist())
    assert found["w"] == want + Counter() | {k: 0 for k in want if not want[k]} | {T.END_KEY: 40_000}
    grams = Counter({k: 0 for keys, _ in T.windows(texts) for k in keys.tolist()})
    for keys, _ in T.windows(texts[1::3] + texts[2::3]):
        grams.update(keys.tolist())
    assert found["g"] == dict(grams)


def test_adding_up_runs_takes_little_memory():
    rng = np.random.default_rng(2)
    runs = [np.unique(rng.integers(0, 1 << 20, 60_000)) for _ in range(16)]
    n = sum(map(len, runs))
    most, (keys, counts) = peak(lambda: T.add_up(runs, [np.ones(len(r), np.int64) for r in runs]))
    assert most < 50 * n
    want = Counter(k for r in runs for k in r.tolist())
    assert keys.tolist() == sorted(want) and counts.tolist() == [want[k] for k in sorted(want)]


def test_batches_are_limited_while_scoring_only(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen = spark.conf.get(key), []
    plain = T.staged
    monkeypatch.setattr(T, "staged", lambda df, name: seen.append((name, spark.conf.get(key))) or plain(df, name))
    run(spark, DOCS)
    assert {size for _, size in seen} == {str(T.BATCH_BYTES)} and "tree-scores" in dict(seen)
    assert spark.conf.get(key) == before

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    texts = spark.range(0, 5000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("text"))
    with limited_batches(spark, 1 << 20):
        assert max(r["size"] for r in texts.mapInArrow(sizes, "size long").collect()) < 2 << 20


def test_packed_keys():
    rng = np.random.default_rng(3)
    for keys in (np.zeros(0, np.int64), np.zeros(3, np.int64), np.array([T.END_KEY, -1, 0, (1 << 63) - 1, -(1 << 63)]), np.sort(rng.integers(-(1 << 63), (1 << 63) - 1, 1000)), rng.integers(0, 300, 1000)):
        assert (T.unpack(T.pack(keys)) == keys).all() and len(T.unpack(T.pack(keys))) == len(keys)
    assert len(T.unpack(None)) == 0
    near = np.sort(rng.integers(0, 1 << 30, 10_000)) | (1 << 45)
    assert len(zlib.compress(T.pack(near), 1)) < 0.7 * len(zlib.compress(near.tobytes(), 1))


def test_window_keys_are_staged_packed(spark, monkeypatch):
    kinds = {}
    plain = T.staged
    monkeypatch.setattr(T, "staged", lambda df, name: kinds.update({name: dict(df.dtypes)}) or plain(df, name))
    run(spark, DOCS)
    assert kinds["tree-tally"]["keys"] == kinds["tree-words"]["keys"] == "binary"


def test_more_blocks_than_partitions(spark):
    docs = [(i, f"text {i} of {i % 3} or {i % 5}", i % 4 == 0) for i in range(30)]
    assert len(docs) * 16 // 20 > 2 * 8  # blocks, partitions
    for got, want in zip(run(spark, docs, block_bytes=20), run(spark, docs), strict=True):
        assert got == pytest.approx(want, rel=1e-9, abs=1e-9)
