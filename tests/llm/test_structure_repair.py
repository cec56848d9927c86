from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dumpwise.llm import structure_repair as sr

WHITE = " \t\n\v\f\r"
INS = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """Least (cost, audit) by plain recursion from the front; rows are (initial, fault)."""

    @lru_cache(maxsize=None)
    def f(i, state, inserts):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, ""))
        if inserts < 3:
            c, a = f(i, INS[state], inserts + 1)
            found.append((c + 2, "I" + a))
        if i < len(rows):
            initial, fault = rows[i]
            edits = [(3, "D", state)]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                edits.append((2 + extra, "R", INS[state]))
                if (initial, state) in {("s", ""), ("u", ""), ("u", "s"), ("u", "a"), ("a", "u")}:
                    edits.append((0 + extra, "K", initial))
            for cost, letter, to in edits:
                c, a = f(i + 1, to, 0)
                found.append((c + cost, letter + a))
        return min(found, default=(10**9, ""))

    for i in range(len(rows), 0, -1):  # the back first, so that no call goes deep
        for state in INS:
            f(i, state, 0)
    return f(0, "", 0)


def by_hand(table):
    """The whole contract in plain Python for rows (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for c, turn, role, text in table:
            if c != conv:
                continue
            key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(key.encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.strip(WHITE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] if r[1][:1] in ("s", "u", "a") else "?" for r in rows]
        cost, audit = cheapest(tuple(zip(initials, faults)))
        turns = [r[0] for r in rows if r[0] is not None]
        repaired, i, state = [], 0, ""
        for letter in audit:
            if letter == "I":
                role, text = {"u": "user", "a": "assistant"}[INS[state]], ""
            else:
                _, role, text = rows[i]
                i += 1
                if letter == "D":
                    continue
                role = {"u": "user", "a": "assistant"}[INS[state]] if letter == "R" else role
            repaired.append(f"{role}:{text}")
            state = role[0]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
        )
    return out


def result(df):
    got = sr.repair(df).drop("n_rows", "n_repaired").collect()
    out = {r[0]: tuple(r)[1:] for r in got}
    assert len(out) == len(got)
    return out


SYMBOLS = {chr(sr.FIRST_SYMBOL + 4 * r + f): ("sua?"[r], ["", "truncated", "blank", "duplicate"][f]) for r in range(4) for f in range(4)}


def best(grammar, symbols):
    m = grammar.matrix(symbols)
    audits = [(m.cost[0][q] + sr.CLOSING[q][0], m.audit(0, q) + sr.CLOSING[q][1]) for q in range(4) if m.cost[0][q] < sr.INF]
    return min(audits)


def test_every_short_string():
    grammar = sr.Grammar(())
    letters = [s for s, (r, f) in SYMBOLS.items() if f != "duplicate"]
    for n in (1, 2, 3):
        for symbols in product(letters, repeat=n):
            assert best(grammar, "".join(symbols)) == cheapest(tuple(SYMBOLS[c] for c in symbols))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=sorted(SYMBOLS), min_size=1, max_size=40), st.integers(0, 9))
def test_rules_change_nothing(symbols, seed):
    pairs, text = [], symbols
    for i in range(seed):  # rules of pairs that occur, nested
        if len(text) > 1:
            pairs.append(text[(at := i % (len(text) - 1)) : at + 2])
            text = sr.rewritten(text, tuple(pairs), len(pairs) - 1)
    grammar = sr.Grammar(tuple(pairs))
    assert len(grammar.compressed(symbols)) <= len(symbols)
    assert best(grammar, symbols) == cheapest(tuple(SYMBOLS[c] for c in symbols))
    m = grammar.matrix(symbols)
    for p in range(4):  # ranks are the order of the audits
        row = sorted((m.audit(p, q), q) for q in range(4) if m.cost[p][q] < sr.INF)
        assert [q for _, q in row] == sorted((q for q in range(4) if m.cost[p][q] < sr.INF), key=lambda q: m.rank[p][q])


def test_whole_table_against_plain_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = by_hand([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()])
    assert result(df) == want


SCHEMA = "conv_id long, turn long, role string, text string, pos string, audit int"


def test_edge_rows(spark):
    rows = [
        (1, 0, "user", "A."), (1, 1, "assistant", "B"), (1, None, "system", "S."), (1, 9, "user", None), (1, 9, None, "x."), (1, 9, "", "x."),
        (None, 0, "user", "hi."), (None, None, "assistant", "yo!"), (2, 5, "tool", " \t"), (3, 1, "assistant", "same."), (3, 2, "assistant", "same."), (3, 2, "assistant", "same."),
        (4, 1, "usher", "End ! \n"), (4, 2, "Assistant", "é" * 100_000 + "."), (5, None, None, None),
        *[(c, t, "user", "q?") for c in range(100, 140) for t in range(2)], *[(c, 0, "user", "only?") for c in range(200, 260)],
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    want = by_hand(rows)
    assert result(df) == want
    assert any(v[6] == "" for v in want.values()) and len({zlib.crc32(f"{r[0]}:{r[1]}".encode()) % 20 for r in rows} & set(range(5))) == 5


@pytest.mark.parametrize("segment", [4, 1 << 12])
def test_one_long_conversation_in_segments(spark, monkeypatch, segment):
    monkeypatch.setattr(sr, "SEGMENT", segment)
    roles = ["system", "user", "assistant", "user", "tool", "assistant", "assistant"]
    rows = [(7, t, roles[(t * t + t // 5) % 7], ["done.", "open", f"t{t}!", f"t{t}"][t % 4]) for t in range(900)] + [(8, 0, "user", "one.")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert result(df) == by_hand(rows)


def test_empty_table(spark):
    assert sr.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pairs_are_counted_over_all_strings(spark):
    strings = spark.createDataFrame([("abab", 5), ("cd", 3), ("ef", 1)], "symbols string, n long")
    pairs = sr.learn_pairs(strings)
    assert pairs[0] == "ab" and "cd" in pairs and "ef" not in pairs
    assert pairs[2:] == (chr(sr.FIRST_RULE) * 2,)
