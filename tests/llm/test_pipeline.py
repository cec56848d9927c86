from __future__ import annotations

import re

import pytest
from test_decontaminate import brute as brute_hits
from test_mixing import check as check_mix
from test_ngram_join import brute as brute_links

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox jumps over the lazy dog and then it runs away from all the other animals in the wood".split()


@pytest.fixture
def sf_dir(spark, scratch):
    items = [(1, " ".join(f"bench{i} item" for i in range(10)))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    return scratch


def prose(k, n=60):
    return " ".join(f"{PROSE[(k * 7 + i * (k + 1)) % len(PROSE)]}{'' if i % 5 else PROSE[(k + i) % len(PROSE)]}" for i in range(n))


def rows(*texts):
    return [(i, t, "en", f"s{i % 3}", len(t) if t else None) for i, t in enumerate(texts)]


def test_language_stage(spark, sf_dir):
    docs = rows(*[prose(k) for k in range(30)], None, "", "12 34 !!", prose(3))
    got = P.language_id(spark, spark.createDataFrame(docs, COLUMNS), sf_dir)
    assert got.columns == [c.split()[0] for c in COLUMNS.split(", ")]
    assert {r["doc_id"] for r in got.collect()} == {*range(30), 33}


def test_near_duplicate_stage(spark, sf_dir):
    docs = rows(*[prose(k) for k in range(6)], prose(2), prose(4).replace("dog", "cat", 1), None, "")
    docs += [docs[0], (None, prose(1), "en", "s0", 1)]
    got = sorted(tuple(r) for r in P.near_duplicates(spark, spark.createDataFrame(docs, COLUMNS), sf_dir).where("doc_id is not null").collect())
    keep = {i for i, _, smallest in brute_links([(d[0], d[1]) for d in docs if d[0] is not None]) if i == smallest}
    assert got == sorted({d for d in docs if d[0] in keep})


def test_decontamination_stage(spark, sf_dir):
    leak = "bench3 item bench4 item bench5 item bench6 item bench7 item"
    docs = rows(prose(1), f"{prose(2)} {leak} {prose(3)}", None, leak.upper(), "bench3 item bench4 item", prose(1))
    got = P.decontamination(spark, spark.createDataFrame(docs, COLUMNS), sf_dir)
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {r[0] for r in brute_hits([(d[0], d[1]) for d in docs], items) if not r[-1]}
    assert sorted(map(tuple, got.collect()), key=str) == sorted((d for d in docs if d[0] in clean), key=str)
    assert clean == {0, 2, 4, 5}


def test_pii_stage(spark, sf_dir):
    docs = rows("clean text 12", "write to a.b@example.org or 4111111111111111", None, "")
    got = {r["doc_id"]: r for r in P.pii(spark, spark.createDataFrame(docs, COLUMNS), sf_dir).collect()}
    assert [tuple(got[i]) for i in (0, 2, 3)] == [docs[0], docs[2], docs[3]]
    assert not re.search("a.b@|4111111111111111", got[1]["text"]) and got[1]["n_chars"] == len(got[1]["text"])


def test_mixing_stage(spark, sf_dir):
    docs = [(i, "w " * (5 + i % 40), "en", f"s{i % 4}", 1) for i in range(400)]
    got = {r["doc_id"]: r for r in P.mixing(spark, spark.createDataFrame(docs, COLUMNS), sf_dir).collect()}
    assert all(r["copies"] >= 1 and r["text"] for r in got.values())

    class Row(dict):
        pass

    sizes = {}
    for d in docs:
        sizes[d[3]] = sizes.get(d[3], 0) + 5 + d[0] % 40
    full = [Row(doc_id=d[0], size=5 + d[0] % 40, source_size=sizes[d[3]], copies=got[d[0]]["copies"] if d[0] in got else 0) for d in docs]
    targets = {r["source"]: r["target"] for r in got.values()}
    for r, d in zip(full, docs):
        r.update(taken=r["size"] * r["copies"], target=targets[d[3]])
    check_mix(full, [(d[0], d[1], d[3]) for d in docs], 0.03)


def test_mixing_of_null_and_repeated_ids(spark, sf_dir):
    docs = [(None, f"{'w ' * (9 + i % 3)}{i}", "en", f"s{i % 4}", i) for i in range(400)]
    docs += [(7, f"{'v ' * (9 + i % 2)}{i}", "en", f"s{i % 4}", i) for i in range(200)] + [(None, "u " * 10, "en", None, 1)] * 90 + [(8, None, "en", "s1", None)] * 3
    got = [r.asDict() for r in P.mixing(spark, spark.createDataFrame(docs, COLUMNS), sf_dir).collect()]
    sources, left = {}, list(docs)
    for r in got:
        left.remove((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]))
        assert r["size"] == len((r["text"] or "").split()) and r["taken"] == r["size"] * r["copies"] and r["copies"] >= 1
        sources.setdefault(r["source"], []).append(r)
    assert set(sources) == {"s0", "s1", "s2", "s3", None}
    for mine in sources.values():
        assert len({r["target"] for r in mine}) == 1
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 0.03 * mine[0]["target"]
    assert sorted(map(str, got)) == sorted(str(r.asDict()) for r in P.mixing(spark, spark.createDataFrame(docs, COLUMNS), sf_dir).collect())


def test_near_duplicates_of_an_id_with_several_texts(spark, sf_dir):
    docs = [(5, prose(1), "en", "s0", 1), (5, prose(2), "en", "s0", 1), (3, prose(2), "en", "s0", 1), (11, prose(1), "en", "s0", 1), (5, prose(1), "en", "s0", 1)]
    got = sorted(tuple(r) for r in P.near_duplicates(spark, spark.createDataFrame(docs, COLUMNS), sf_dir).collect())
    assert got == [docs[2], docs[0]]


def test_mixing_keeps_rows_that_hardly_differ(spark, sf_dir):
    cases = ["timestamp'2024-01-01 00:00:00.000001'", "timestamp'2024-01-01 00:00:00.000002'", "timestamp'2024-01-01 00:00:00'", "cast(null as timestamp)"]
    numbers = ["double('NaN')", "cast(null as double)", "0.1D", "0.10000000000000002D"]
    select = " union all ".join(f"select 1L doc_id, 'w w w' text, 'en' lang, 's' source, 3L n_chars, {t} at, {x} x, named_struct('in', to_timestamp_ntz({t})) nested" for t in cases for x in numbers)
    docs = spark.sql(select)
    got = P.mixing(spark, docs, sf_dir)
    assert sorted(map(str, got.select(docs.columns).collect())) == sorted(map(str, docs.collect()))


def test_empty_documents(spark, sf_dir):
    empty = spark.createDataFrame([], COLUMNS)
    for _, stage in P.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_whole_pipeline(spark):
    got = P.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    links = brute_links([tuple(r) for r in docs.select("doc_id", "text").collect()])
    group = {i: smallest for i, _, smallest in links}
    ids = [r["doc_id"] for r in got]
    assert len(set(ids)) == len(ids) and len({group[i] for i in ids}) == len(ids)
    assert all(not re.search(r"@mail\d", r["text"]) for r in got)
