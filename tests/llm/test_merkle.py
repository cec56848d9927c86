from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest

from dumpwise.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place int, hash string, g string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return sha(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """Root of a list of hashes and, per node, its steps (left siblings, right siblings)."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k // 8 * 8 : k // 8 * 8 + 8]
            steps[i].append(("".join(run[: k % 8]), "".join(run[k % 8 + 1 :])))
            at[i] = k // 8
        nodes = [sha(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return (nodes[0] if nodes else None), steps


def by_hand(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        low = None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        own = leaf(doc_id, source, lang, n_chars, text)
        groups.setdefault(lang, []).append((doc_id, own, leaf(doc_id, source, lang, n_chars, low) if bad else own))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        made[lang] = climb([r[1] for r in groups[lang]])
    root, upper = climb([made[x][0] for x in langs])
    out = []
    for i, lang in enumerate(langs):
        for (doc_id, own, changed), steps in zip(groups[lang], made[lang][1]):
            path = steps + upper[i]
            fold = changed
            for left, right in path:
                fold = sha(left, fold, right)
            out.append((doc_id, own, made[lang][0], root, sha(*(x for step in path for x in step)), fold, fold == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def got(spark, rows):
    df = spark.createDataFrame([(*r, 5, "h", "+x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.manifest(df).select(COLUMNS).collect()), key=str)


def test_edge_rows(spark):
    rows = [
        (None, "No id A", "en", "s", 1), (None, "No id A", "en", "s", 1), (1, None, "en", None, None), (2, "", None, "s", 0), (2, "", None, "s", 0), (3, "Ünï A:B", "", "s", 7),
        (9, "AZ[`", "zz", "s", 4), (0, "x" * 300_000 + "Q", "en", "s", 300_001), *[(i, f"Text {i}", "de", f"s{i % 3}", i) for i in range(600)], *[(5, "Same Row", "fr", "s", 8)] * 90,
    ]
    assert got(spark, rows) == by_hand(rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_sizes_around_the_fan(spark, n):
    rows = [(i, f"T{i}", "en", "s", i) for i in range(n)]
    assert got(spark, rows) == by_hand(rows)


def test_many_languages(spark):
    rows = [(i, f"T{i}", f"l{i % 70}" if i % 70 else None, "s", i) for i in range(200)]
    assert got(spark, rows) == by_hand(rows)


def test_tampering_is_found(spark):
    rows = [(i, "Aa" if i % 2 else "aa", "en", "s", 2) for i in range(300)]
    for doc_id, *_, verified in got(spark, rows):
        assert verified == (zlib.crc32(str(doc_id).encode()) % 3 != 0 or doc_id % 2 == 0)


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_windows_stay_within_chunks(spark):
    """No window and no sort of a whole language: levels are dealt by (group, chunk)."""
    nodes = spark.range(10).selectExpr("'+en' g", "id place", "10L total", "sha2(string(id), 256) hash")
    plan = merkle._with_siblings(nodes, "g")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "FLOOR" in plan.upper() and "SinglePartition" not in plan


def test_oracle_on_odd_rows(spark):
    rows = [(None, "A", "en", "s", 1), (1, None, None, None, None), *[(i, f"Té{i}", "de" if i % 4 else "", "s", i) for i in range(2, 90)]]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", rows)
    want = sorted((tuple(r) for r in con.execute(f"select {', '.join(COLUMNS)} from ({merkle.oracle()})").fetchall()), key=str)
    assert want == by_hand(rows) == got(spark, rows)
