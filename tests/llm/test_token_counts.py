from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dumpwise.llm import token_counts as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = T._Counter(PATH, T.prove_whole(LIBRARY))


def library(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_whole_tokens_encode_alone_as_one():
    whole = sorted(COUNTER.whole)
    assert len(whole) > 49_000 and set(library(whole)) == {1}


def test_every_settled_character_splits_as_the_library_does():
    settled = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and not T.UNSETTLED.search(chr(c))]
    texts = [f"a{c}a 1{c}1 !{c}! {c} {c}{c}a" for c in settled]
    assert len(texts) > 30_000
    assert [COUNTER.count(t) for t in texts] == library(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", " ", "\n\n", "\t", "don't", "I'll", "word", "Wörter", "日本語", "한국", "123", "½", "!?", "…", "՘", "😀", "é", "\x1c", " ", "x" * 40]), max_size=20).map("".join))
def test_matches_the_library(text):
    assert COUNTER.count(text) == library([text])[0]


def test_whole_rows(spark):
    texts = [None, "", "a", "<|endoftext|> x", "word " * 40_000, "z" * 30_000, "a"]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, T.count_tokens(df, PATH).collect()))
    want = [(i, len((t or "").encode()), n, n > 512) for (i, t), n in zip(enumerate(texts), library([t or "" for t in texts]))]
    assert got == want
    assert T.count_tokens(df.limit(0), PATH).count() == 0


def test_other_tokenizers_are_refused(spark):
    with pytest.raises(ValueError):
        T.count_tokens(spark.createDataFrame([(1, "a")], "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json"))
