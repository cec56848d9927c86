"""Token counts with the whole-token shortcut (operator 1).

A byte-level BPE tokenizer first cuts a text into pre-tokens and then merges
each one by itself, so a text's count is the sum over its pre-tokens. Offline,
``prove_whole`` encodes every vocabulary string alone and keeps those that come
out as exactly one token: for these pre-tokens the count is known to be 1
without any merge. The rest is merged by the library, each distinct string once
per task (a bounded memo).

The pre-token pattern is evaluated here by the ``regex`` module, whose Unicode
tables may be newer than the library's. ``SETTLED`` names ranges in which both
agree for every character (a test probes them all); a text with any other
character is counted by the library as a whole. Special tokens are cut out
before the pattern, as the library does by default, and count 1 each.

Cases: null text counts as empty (0 bytes, 0 tokens); repeated rows give
repeated rows; extra columns are ignored; an empty table gives no rows. A text
is never cut; a very long pre-token is merged whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

# Fixed value: the pre-token pattern of byte-level BPE vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SETTLED = "\x00-՗ -⁮₠-₵←-⇿ぁ-ゖァ-ヺ一-龥가-힣！-～"
UNSETTLED = regex.compile(f"[^{SETTLED}]")
MEMO_ENTRIES = 400_000  # distinct merged pre-tokens a task remembers before it starts afresh

SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def prove_whole(tokenizer: Tokenizer) -> frozenset[str]:
    """Vocabulary strings that the library encodes, alone, as exactly one token."""
    ids = sorted(set(tokenizer.get_vocab().values()))
    special = set(tokenizer.get_added_tokens_decoder())
    ids = [i for i in ids if i not in special]
    texts = tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False)
    encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
    return frozenset(t for i, t, e in zip(ids, texts, encoded) if e.ids == [i])


def supported(tokenizer: Tokenizer) -> bool:
    """True for the tokenizers the shortcut is proven for: byte-level, no normaliser, plain special tokens."""
    import json

    spec = json.loads(tokenizer.to_str())
    pre = spec.get("pre_tokenizer") or {}
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
    return spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) \
        and not pre.get("add_prefix_space") and plain


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte of UTF-8, read off the library."""
    split = ByteLevel(add_prefix_space=False, use_regex=False)
    letters: dict[int, str] = {}
    for code in chain(range(0x800), range(0x800, 0x110000, 0x400)):
        if not 0xD800 <= code <= 0xDFFF:
            letters.update(zip(chr(code).encode(), split.pre_tokenize_str(chr(code))[0][0]))
    return letters


class _Counter:
    """Counts tokens of texts in one Python worker."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.whole = dict.fromkeys(whole, 1)
        self.memo = dict(self.whole)
        self.find = regex.compile(PRE_TOKEN).findall
        self.model = self.tokenizer.model
        self.byte_letters = byte_letters()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def merged(self, token: str) -> int:
        """Tokens of one pre-token, merged by the library's model."""
        return len(self.model.tokenize(token.encode().decode("latin-1").translate(self.byte_letters)))

    def library(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def count(self, text: str) -> int:
        if UNSETTLED.search(text):
            return self.library([text])[0]
        parts, extra = [text], 0
        if self.special:
            parts = self.special.split(text)
            extra = len(parts) - 1
        tokens = list(chain.from_iterable(map(self.find, parts)))
        memo = self.memo
        rest = [t for t in set(tokens) if t not in memo]
        if rest:
            if len(memo) > len(self.whole) + MEMO_ENTRIES:
                self.memo = memo = dict(self.whole)
                rest = [t for t in set(tokens) if t not in memo]
            memo.update(zip(rest, map(self.merged, rest)))
        return extra + sum(map(memo.__getitem__, tokens))


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    ``tokenizer_path`` must be readable on every executor. The proof runs on the
    driver; its result is bounded by the vocabulary and sent as a broadcast.
    The job is one narrow pass: no shuffle, memory bounded by a batch of rows.
    """
    tokenizer = Tokenizer.from_file(tokenizer_path)
    if not supported(tokenizer):
        raise ValueError("the whole-token shortcut needs a byte-level tokenizer without normaliser")
    whole = docs.sparkSession.sparkContext.broadcast(prove_whole(tokenizer))
    state: list[_Counter] = []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state.append(_Counter(tokenizer_path, whole.value))
        counter = state[0]
        for batch in batches:
            texts = batch.column(1)
            sizes, counts = [], []
            for i in range(len(texts)):
                text = texts[i].as_py() or ""
                sizes.append(len(text.encode()))
                counts.append(counter.count(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, SCHEMA).withColumn("over_limit", F.col("n_tokens") > limit)
