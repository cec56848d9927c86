from __future__ import annotations

import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dumpwise.llm import token_files as tf

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = tf.WordEncoder(PATH)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


IDS = st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=300)


@settings(deadline=None)
@given(IDS, st.data())
def test_words_round_trip_whole_and_in_ranges(ids, data):
    x = np.array(ids, "<u4")
    read = tf.Frame(tf.frame([None], [x.tobytes()]))
    assert read.ids().tolist() == ids and read.doc_ids == [None]
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert read.ids(a, b).tolist() == ids[a:b]


def test_blocks_of_a_long_frame():
    rng = np.random.default_rng(3)
    parts = [(2 ** rng.uniform(0, 20, n)).astype("<u4") for n in (0, 5_000, 1, 40_000, 30)]
    read = tf.Frame(tf.frame([1, 2, 3, None, -5], [p.tobytes() for p in parts]))
    assert len(read.blocks) > 20 and len(read.escapes) > 0
    assert [read.document(i).tolist() for i in range(5)] == [p.tolist() for p in parts]
    assert read.doc_ids == [1, 2, 3, None, -5]


def test_small_ids_are_dense_and_wide_ones_escape():
    words, _, escaped = tf.encode(np.zeros(6_000, np.uint32))
    assert len(words) == 100 and not len(escaped)
    ids = np.full(4_000, 1_000, np.uint32)
    ids[::100] = 4_000_000_000
    words, _, escaped = tf.encode(ids)
    assert len(escaped) == 40 and len(words) * 8 + 160 < 4_000 * 2


def test_broken_frames_are_refused():
    data = tf.frame([1], [b"\x01\x00\x00\x00"])
    for bad in (data[:-1], data + b"x", b"XXXX" + data[4:]):
        with pytest.raises(ValueError):
            tf.Frame(bad)


PIECES = ["a", "B", "İ", "ǅ", "Å", "é", "É", "ß", "Σ", "ſ", "ª", "'s", "'S", "'", "1", "½", "²", ".", "!?", ",", ";", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|", "|>", " ", "\t\n", "\x85", " ",
          " ", "\x1c", "\x00", "漢字", "ไทย", "हिन्दी", "שלום", "😀", "👩‍👧", "한", "각", "ffi", "͏", "thatble", "café", "</w>", "Ġ"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.characters(exclude_categories=["Cs"])), max_size=30).map("".join))
def test_words_encode_as_the_library_does(text):
    assert np.frombuffer(ENCODER.encode([text.encode()])[0], "<u4").tolist() == library(text)


def test_memo_may_start_afresh(monkeypatch):
    monkeypatch.setattr(tf, "MEMO_WORDS", 5)
    texts = ["one two, three. four five six seven!", "two one, eight; one"] * 3
    assert [np.frombuffer(x, "<u4").tolist() for x in tf.WordEncoder(PATH).encode([t.encode() for t in texts])] == [library(t) for t in texts]


def test_only_tokenizers_that_drop_white_space_are_cut():
    assert tf.spaces_cut(LIBRARY)
    assert not tf.spaces_cut(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))


def by_hand(rows):
    """(doc_id, start, n_tokens, crc) with rows in ascending order of ids; rows of one id as a multiset of their lengths."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library(text), 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


SCHEMA = "doc_id long, text string, shard int, start string"


def rows_of(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return df, [tuple(r) for r in tf.token_files(df, PATH, 1).orderBy("start").collect()]


def test_files_against_the_library(spark):
    rows = [(i * 7 % 400, f"Document {i}: it's {'word ' * (i % 50)}<|endoftext|> é") for i in range(400)]
    rows += [(1_000, "long " * 200_000), (1_001, None), (1_002, ""), (-3, " \n\t"), (1_003, "😀 <|ENDOFTEXT|>")]
    _, got = rows_of(spark, rows)
    assert got == by_hand(rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "no id"), (None, "no id"), (None, "another text"), (5, "five"), (5, "five"), (5, "cinq cinq"), (6, "six")]
    _, got = rows_of(spark, rows)
    assert [r[0] for r in got] == [None] * 3 + [5] * 3 + [6]
    assert sorted((r[0], *r[2:]) for r in got if r[0]) == sorted((r[0], *r[2:]) for r in by_hand(rows) if r[0])
    ends = [r[1] + r[2] for r in got]
    assert [r[1] for r in got] == [0, *ends[:-1]]


def test_empty_table_and_ids_column(spark):
    assert rows_of(spark, [])[1] == []
    df, _ = rows_of(spark, [(1, "a b"), (2, None)])
    path = f"{tempfile.mkdtemp(prefix='dumpwise-test-')}/ids"
    tf.write_token_files(df, path, PATH, 1)
    assert [(r["doc_id"], r["ids"]) for r in tf.read_token_files(spark, path, with_ids=True).orderBy("doc_id").collect()] == [(1, [*library("a b"), 1]), (2, [1])]


def test_whole_texts_of_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = [tuple(r) for r in tf.token_files(df, PATH, 1).orderBy("start").collect()]
    assert got == by_hand([(r["doc_id"], r["text"]) for r in df.collect()])
