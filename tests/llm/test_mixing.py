from __future__ import annotations

import math
import re

import pytest

from dumpwise.llm.mixing import mix

SF = "/root/testdata/sf0.01"


def water(sizes):
    """The contract's targets, by resharing the excess until none is above its stop."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 3 * sizes[s]]
        if not over:
            out |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def check(rows, docs, tolerance):
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = water(sizes)
    by_id = {d[0]: d for d in docs}
    taken = {}
    for r in rows:
        _, text, source = by_id[r["doc_id"]]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(want[source], rel=1e-9) and 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == r["size"] * r["copies"]
        taken[source] = taken.get(source, 0) + r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(tolerance * t, 0), (s, taken[s], t)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [tuple(r) for r in df.select("doc_id", "text", "source").collect()]
    rows = mix(df).collect()
    assert len(rows) == len(docs)
    check(rows, docs, 0.02)
    assert sorted(map(tuple, mix(df.repartition(3)).collect())) == sorted(map(tuple, rows))


def test_edges(spark):
    schema = "doc_id long, text string, source string, size int, rate string"
    docs = [(i, "w " * (1 + i % 7), ["a", "b", None, "é", "B"][i % 5]) for i in range(400)] + [(1000, None, "a"), (1001, "", "empty"), (1002, "x " * 30_000, "b"), (1003, " \t ", None)]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], schema)
    rows = mix(df).collect()
    assert len(rows) == len(docs)
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = water(sizes)
    got = {r["doc_id"]: r for r in rows}
    for d, _, s in docs:
        assert got[d]["target"] == pytest.approx(want[s], rel=1e-9)
        assert got[d]["taken"] <= 3 * got[d]["size"]
    assert got[1000]["taken"] == got[1001]["taken"] == 0


def test_repeated_rows_and_empty(spark):
    schema = "doc_id long, text string, source string"
    rows = mix(spark.createDataFrame([(1, "a b", "s")] * 4 + [(2, "c", "t")], schema)).collect()
    assert len(rows) == 5 and sum(r["taken"] for r in rows if r["doc_id"] == 1) <= 24
    assert mix(spark.createDataFrame([], schema)).count() == 0
    assert [r["target"] for r in mix(spark.createDataFrame([(1, None, None)], schema)).collect()] == [0.0]


def test_a_hot_id_is_ranked_as_one_row(spark):
    # a third of all rows share a null id and one size; they get their class's copies all the same
    docs = [(i, "w " * (1 + i % 40), "a" if i % 2 else "b") for i in range(6_000)] + [(None, "w " * 20, "a")] * 3_000
    rows = mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    assert len(rows) == len(docs) and sum(r["doc_id"] is None for r in rows) == 3_000
    taken = {}
    for r in rows:
        assert r["taken"] <= 3 * r["size"] and r["copies"] in (int(r["rate"]), int(r["rate"]) + 1)
        taken[r["target"]] = taken.get(r["target"], 0) + r["taken"]
    assert len(taken) == 2 and all(abs(words - target) <= 0.01 * target for target, words in taken.items())
    again = mix(spark.createDataFrame(docs[::-1], "doc_id long, text string, source string").repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def entropy_rates(sizes, target):
    """The optimum by bisection of the dual: rates min(3, exp(m * size)) that take ``target`` words."""
    low, high = -50.0, 50.0
    rate = lambda m, s: min(3.0, math.exp(min(m * s / max(sizes), 50.0)))
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(s * rate(mid, s) for s in sizes) < target else (low, mid)
    return [rate(low, s) for s in sizes]


def test_rates_are_the_entropy_optimum(spark):
    docs = [(i, "w " * (1 + (i * 37) % 90), ["a", "b", "c"][0 if i % 10 < 6 else 1 if i % 10 < 8 else 2]) for i in range(600)]
    rows = {r["doc_id"]: r for r in mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    for source in "abc":
        ids = [d for d, _, s in docs if s == source]
        want = entropy_rates([rows[d]["size"] for d in ids], rows[ids[0]]["target"])
        assert [rows[d]["rate"] for d in ids] == pytest.approx(want, rel=1e-5)
