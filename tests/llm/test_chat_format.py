from __future__ import annotations

import hashlib

from hypothesis import given
from hypothesis import strategies as st

from dumpwise.llm.chat_format import PART, Escaper, Flattener, Template, digests, format_conversations, read_back

T = Template()
E = Escaper(T)
PIECES = st.lists(st.sampled_from(["<", "\\", "|turn|>", "<|turn|>", "<|end|>\n", "</s>", "[INST]", "/INST]", "[", "a", "\n", "<\\", "é", "<|body|>", "s>"]), max_size=12).map("".join)


@given(PIECES)
def test_escape_is_reversible_and_hides_markers(text):
    out = E.escape(text)
    assert E.unescape(out) == text
    assert not any(m in out for m in [T.turn, T.body, T.end, *T.foreign, *T.placeholders.values()])


@given(st.lists(st.tuples(PIECES, st.lists(PIECES, max_size=3)), max_size=4))
def test_turns_round_trip(turns):
    flat = Flattener(T, E)
    made = "".join(T.turn + E.escape(r) + T.body + flat.visit([{"type": "text", "text": p} for p in parts])[0] + T.end + T.after for r, parts in turns)
    assert read_back(made, T, E) == [(r, "".join(parts)) for r, parts in turns]


def expected(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    res = []
    for conv, turns in out.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        res.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned)))
    return sorted(res, key=str)


ROWS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi </s>"), (2, 1, "assistant", None), (2, 0, None, "x"), (None, 0, "user", "lost"), (3, None, "user", "a"), (3, 2, "user", "b"),
    (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"), (4, 0, "user", "same"), (4, 0, "user", "same"), (5, 0, "user", "y " * 50_000),
    *[(6, i, "assistant" if i % 2 else "user", f"turn {i} <|end|>") for i in range(700)],
]


def test_whole_conversations(spark):
    df = spark.createDataFrame([(*r, 1) for r in ROWS], "conv_id long, turn long, role string, text string, formatted int")
    got = digests(format_conversations(df)).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()
    assert sorted(map(tuple, got), key=str) == expected(ROWS)


def test_typed_parts(spark):
    parts = [("text", "see <|im", None, None, None, None, None), ("text", "age|> ", None, None, None, None, None), ("image", None, "a.png", 28, 15, None, None), ("audio", None, "b.wav", None, None, 2.0, None),
             ("document", None, "c.pdf", None, None, None, 3), ("video", None, "d.mp4", None, None, None, None), ("text", None, None, None, None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "assistant", parts[:3])], f"conv_id long, turn long, role string, parts array<{PART}>")
    row = format_conversations(df, parts_col="parts").first()
    seen = [(a["turn"], a["type"], a["ref"], a["n_tokens"]) for a in row["attachments"]]
    assert seen == [(0, "image", "a.png", 4), (0, "audio", "b.wav", 50), (0, "document", "c.pdf", 768), (0, "video", "d.mp4", 1), (2, "image", "a.png", 4)]
    for a in row["attachments"]:
        assert row["formatted"][a["at"] :].startswith(T.placeholders.get(a["type"], T.placeholders["other"]))
    assert [row["formatted"][x["a"] : x["b"]] for x in row["loss"]] == ["", r"see <\|image|> <|image|>"]


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert digests(format_conversations(df)).count() == 0
