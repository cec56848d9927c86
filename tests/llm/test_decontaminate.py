from __future__ import annotations

import hashlib
import re

import pytest

from dumpwise.llm.decontaminate import contamination, marked

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.01"


def split(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    """The contract read literally: every window of every item at every position."""
    windows = {}
    for item, text in items:
        w = split(text)
        if item is not None and w:
            for i in range(max(1, len(w) - 9)):
                windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = split(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, contamination(d, b, **options).collect()), key=str)


LONG = " ".join(f"w{i}" for i in range(25))
DOCS = [
    (1, f"before {LONG} after"), (2, "w0 w1 w2"), (3, None), (4, ""), (5, "One, TWO; three!"), (6, " ".join(f"w{i}" for i in range(3, 13))),
    (7, "a a a a a a a a a a a a"), (7, "a a a a a a a a a a a a"), (8, "zwei eins zwei drei"), (9, "é " * 4 + "x"), (10, LONG + " . " + LONG),
    (11, "..."), (12, " ".join(f"w{i}" for i in range(3, 12))),
]
ITEMS = [(100, LONG), (100, LONG), (101, "one two three"), (102, "a a a a a a a a a a a"), (103, None), (104, ""), (None, "zwei"), (105, "drei"), (9, "é é"), (106, LONG)]


@pytest.mark.parametrize("block_bytes", [4 << 20, 300])
def test_matches_brute_force(spark, block_bytes):
    assert run(spark, DOCS, ITEMS, block_bytes=block_bytes) == brute(DOCS, ITEMS)


@pytest.mark.parametrize("block_bytes", [4 << 20, 0])
def test_empty_tables(spark, block_bytes):
    assert run(spark, DOCS, [], block_bytes=block_bytes) == brute(DOCS, [])
    assert run(spark, [], ITEMS, block_bytes=block_bytes) == []


def test_a_large_benchmark_is_not_gathered(spark):
    """A third of all texts hold one passage, many items share one window, and a window repeats inside a text."""
    shared = " ".join(f"s{i}" for i in range(12))
    docs = [(i, f"d{i} {shared} e{i}" if i % 3 == 0 else f"w{i} w{i + 1} " * 9) for i in range(300)]
    docs += [(1000 + i, f"copy {shared} {shared}") for i in range(50)] + [(None, shared), (7, None), (7, "")]
    items = [(i, f"{shared} t{i}") for i in range(200)] + [(500 + i, f"w{i} w{i + 1} " * 6) for i in range(0, 300, 7)]
    want = brute(docs, items)
    assert run(spark, docs, items, block_bytes=0) == want == run(spark, docs, items)


def test_marked_keeps_all_columns(spark):
    d = spark.createDataFrame([(1, LONG, "x", 5), (None, None, None, None)], "doc_id long, text string, `a.b` string, digest int")
    b = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    for block_bytes in (4 << 20, 0):
        rows = sorted(marked(d, b, name="seen", block_bytes=block_bytes).collect(), key=str)
        assert [(r["a.b"], r["digest"], r["seen"]["n_hit"], r["seen"]["n_words"]) for r in rows] == [("x", 5, 25, 25), (None, None, 0, 0)]


def test_extra_columns(spark):
    d = spark.createDataFrame([(1, LONG, "x", 5)], "doc_id long, text string, item_id string, spans int")
    b = spark.createDataFrame([(1, LONG, "x")], "item_id long, text string, doc_id string")
    assert contamination(d, b).first()["n_hit"] == 25


@pytest.mark.parametrize("block_bytes", [4 << 20, 0])
def test_whole_tables(spark, block_bytes):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = run(spark, docs, items, block_bytes=block_bytes)
    assert got == brute(docs, items)
    assert any(r[-1] for r in got)
