"""Benchmark decontamination as a prefix-filtered set join (operator 3).

A benchmark item becomes windows of 10 consecutive words (an item of fewer
words is one window). A window is a set of 5-word shingles, and a document
contains it only if it contains all of them, so one shingle per window is a
sufficient prefix: the rarest in the documents. The job

1. counts the benchmark's shingles over all documents (only hashes that occur
   in the benchmark leave a task),
2. picks each window's rarest shingle as its prefix token, and
3. joins the documents' shingles with the prefix tokens. The token's place in
   the window gives the only possible start (positional bound); start and end
   must lie in the document (length bound); the candidate is then verified word
   for word over the item-sized window.

Windows of up to ``block_bytes`` are broadcast, and the documents pass through
without a shuffle (two passes). A larger benchmark is never gathered: shingles
are joined by a shuffle, in three passes over the documents whatever its size.
A bit filter of at most 32 MB, built by an aggregate over the shingles' codes,
keeps document shingles that no window has from leaving their task; counts come
from a join on the code; then the occurrences of prefix tokens, each with the
words around it, meet their windows in a join on the code, which verifies them
where they meet. Copies of a text are one candidate there (spans belong to the
text's digest). A token with very many occurrences is split by Spark's skew
join, since nothing above reuses the join's partitioning. An item list per text
and a text's spans in order are the only things one task holds.

Words: A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Cases: a null or
empty text has no words and is clean; a benchmark row without words gives no
window, one without ``item_id`` cannot be named and is left out; repeated item
rows count once; an empty benchmark leaves every document clean; repeated
document rows give repeated results.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dumpwise.llm.common import byte_column, mix64, staged, words
from dumpwise.llm.wordhash import shingles_of_texts

WINDOW = 10
SHINGLE = 5
BLOCK_BYTES = 4 << 20
BATCH_WORDS = 1 << 20  # documents are matched in runs of about so many words
FILTER_BITS = 28  # the bit filter has at most 2**28 bits (32 MB)
SENT_ROWS = 1 << 12

MARK = "struct<n_words: long, n_hit: long, n_items: long, items_sha256: string, contaminated: boolean>"
_MARK_TYPE = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # with A-Z, which the words have in lower case
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct ``(item, window)``: the words of each window joined by a space."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), byte_column(batch, "text")):
                w = words(text)
                found = sorted({b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}) if w else []
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(found), pa.string()), pa.array(found, pa.binary())], names=["item", "window"])

    named = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return named.mapInArrow(cut, "item string, window binary").distinct()


def _shingle_codes(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash per run of ``size`` word ids; 0 where the run meets an unknown word or a document end (id 0)."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    code = np.zeros(n, np.uint64)
    known = np.ones(n, bool)
    for k in range(size):
        part = ids[k : n + k]
        code = mix64(code * _MULTIPLIER + part.astype(np.uint64))
        known &= part != 0
    return np.where(known, code | np.uint64(1), np.uint64(0))


class BlockIndex:
    """One block of windows: the vocabulary, and per shingle length the prefix tokens with their windows."""

    def __init__(self, rows: list[tuple[str, bytes]]):
        items: dict[bytes, list[str]] = defaultdict(list)
        for item, window in rows:
            items[window].append(item)
        self.windows = sorted(items)
        self.items = [sorted(items[w]) for w in self.windows]
        vocabulary = sorted({w for window in self.windows for w in window.split(b" ")})
        self.ids = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.grams = [np.array([self.ids[w] for w in window.split(b" ")], np.int64) for window in self.windows]
        self.codes = [_shingle_codes(g, min(SHINGLE, len(g))) for g in self.grams]
        by_size: dict[int, list[int]] = defaultdict(list)
        for k, g in enumerate(self.grams):
            by_size[min(SHINGLE, len(g))].append(k)
        self.shingles = {size: np.unique(np.concatenate([self.codes[k] for k in ks])) for size, ks in by_size.items()}
        self.by_size = dict(by_size)
        self.prefixes: dict[int, tuple[np.ndarray, ...]] = {}

    def order(self, counts: dict[tuple[int, int], int]) -> None:
        """Choose each window's rarest shingle (ties by hash) as its prefix token."""
        for size, ks in self.by_size.items():
            rows = []
            for k in ks:
                codes = self.codes[k].tolist()
                place = min(range(len(codes)), key=lambda i: (counts.get((size, codes[i]), 0), codes[i]))
                rows.append((codes[place], place, k))
            rows.sort()
            codes = np.array([r[0] for r in rows], np.uint64)
            tokens, first = np.unique(codes, return_index=True)
            last = np.append(first[1:], len(rows))
            self.prefixes[size] = (tokens, first, last, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))

    def word_ids(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Word ids of many documents in one array, a 0 after each; and where each document starts."""
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.zeros(starts[-1], np.int64)
        get = self.ids.get
        for t, s in zip(texts, starts):
            if t:
                ids[s : s + len(t)] = np.fromiter((get(w, 0) for w in t), np.int64, len(t))
        return ids, starts

    def matches(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(window, its verified start positions) for all occurrences; a 0 id breaks a run."""
        for size, (tokens, first, last, place, window) in self.prefixes.items():
            codes = _shingle_codes(ids, size)
            at = np.flatnonzero(codes)
            if not len(at):
                continue
            where = np.searchsorted(tokens, codes[at])
            where[where == len(tokens)] = 0
            hit = tokens[where] == codes[at]
            at, where = at[hit], where[hit]
            by_token = np.argsort(where, kind="stable")
            at, where = at[by_token], where[by_token]
            for token, begin, end in zip(*_runs(where)):
                for r in range(first[token], last[token]):
                    gram = self.grams[window[r]]
                    starts = at[begin:end] - place[r]
                    starts = starts[(starts >= 0) & (starts + len(gram) <= len(ids))]
                    same = np.ones(len(starts), bool)
                    for j, word in enumerate(gram):
                        same &= ids[starts + j] == word
                    if same.any():
                        yield int(window[r]), starts[same]


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, begins and ends of the runs of equal values in ``x``."""
    if not len(x):
        return x, x, x
    begin = np.concatenate([[0], np.flatnonzero(np.diff(x)) + 1])
    return x[begin], begin, np.append(begin[1:], len(x))


def _document_runs(column: pa.Array) -> Iterator[tuple[int, int, list[list[bytes]]]]:
    """Slices (first, end) of a text column that hold about ``BATCH_WORDS`` words, with their words."""
    texts = column.cast(pa.large_binary()).to_pylist()
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(words(text))
        size += len(held[-1]) + 1
        if size >= BATCH_WORDS or i == len(texts) - 1:
            yield first, i + 1, held
            first, held, size = i + 1, [], 0


def _count(batches: Iterator[pa.RecordBatch], index) -> Iterator[pa.RecordBatch]:
    block: BlockIndex = index.value
    totals = {size: np.zeros(len(s), np.int64) for size, s in block.shingles.items()}
    for batch in batches:
        for _, _, held in _document_runs(batch.column(0)):
            ids, _ = block.word_ids(held)
            for size, shingles in block.shingles.items():
                codes = _shingle_codes(ids, size)
                codes = codes[codes != 0]
                where = np.searchsorted(shingles, codes)
                where[where == len(shingles)] = 0
                totals[size] += np.bincount(where[shingles[where] == codes], minlength=len(shingles)) if len(codes) else 0
    for size, total in totals.items():
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(seen), size), pa.int32()), pa.array(block.shingles[size][seen].astype(np.int64)), pa.array(total[seen])], names=["size", "code", "n"]
        )


def _merge(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Sorted, disjoint spans that cover the same words."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _mark(index):
    """A column function: a text's words, words hit, items and their digest, from a broadcast block of windows."""

    @F.arrow_udf(MARK)
    def mark(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block: BlockIndex = index.value
        for texts in batches:
            out: list[dict] = []
            for _, _, held in _document_runs(texts):
                ids, starts = block.word_ids(held)
                spans: list[list[tuple[int, int]]] = [[] for _ in held]
                items: list[set[str]] = [set() for _ in held]
                for window, at in block.matches(ids):
                    size = len(block.grams[window])
                    docs = np.searchsorted(starts, at, side="right") - 1
                    for d, a in zip(docs.tolist(), (at - starts[docs]).tolist()):
                        spans[d].append((a, a + size))
                        items[d].update(block.items[window])
                for text, s, i in zip(held, map(_merge, spans), items):
                    hit = sum(b - a for a, b in s)
                    digest = hashlib.sha256(",".join(sorted(i)).encode()).hexdigest()
                    out.append({"n_words": len(text), "n_hit": hit, "n_items": len(i), "items_sha256": digest, "contaminated": hit > 0})
            yield pa.array(out, _MARK_TYPE)

    return mark


def _broadcast_mark(docs: DataFrame, windows: DataFrame, text_col: str) -> Column:
    """The mark of every text, the windows (few, by the caller's check) broadcast."""
    context, text = docs.sparkSession.sparkContext, F.col(text_col).cast("string")
    index = BlockIndex([(r["item"], bytes(r["window"])) for r in windows.collect()])
    if index.windows:
        shared = context.broadcast(index)
        counted = docs.select(text.alias("text")).mapInArrow(partial(_count, index=shared), "size int, code long, n long").groupBy("size", "code").agg(F.sum("n").alias("n"))
        # bounded by the block's own shingles
        index.order({(r["size"], r["code"] & (2**64 - 1)): r["n"] for r in counted.collect()})
    return _mark(context.broadcast(index))(text)


def _window_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``wid, code, place`` of every shingle of every window."""
    for batch in batches:
        wids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        codes, starts, counts = shingles_of_texts(texts, SHINGLE)
        per = np.where(counts == 0, 0, np.maximum(1, counts - SHINGLE + 1))
        place = np.arange(len(codes)) - np.repeat(starts, per)
        owner = np.repeat(np.arange(len(texts)), per).tolist()
        yield pa.RecordBatch.from_arrays([pa.array([wids[k] for k in owner], pa.binary()), pa.array(codes.astype(np.int64)), pa.array(place.astype(np.int32))], names=["wid", "code", "place"])


def bit_filter(codes: DataFrame) -> np.ndarray:
    """The codes of a one-column table as a bit filter, gathered as bitmaps of 4 KB: 2**FILTER_BITS bits at most."""
    n = max(1, codes.count())
    bits = min(FILTER_BITS, max(16, math.ceil(math.log2(16 * n))))
    place = F.pmod(F.col("code"), F.lit(1 << bits)) + 1
    maps = codes.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in maps.toLocalIterator():
        at = (r["bucket"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)[: len(out) - at]
    return out


def _in_filter(codes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = (codes & np.uint64(len(bits) * 8 - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _candidates(texts: list[bytes | None], sizes: list[int], bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, word position, code) of the shingles in the filter, per shingle length."""
    for size in sizes:
        codes, starts, counts = shingles_of_texts(texts, size)
        at = np.flatnonzero(_in_filter(codes, bits))
        text = np.searchsorted(starts, at, side="right") - 1
        enough = counts[text] >= size  # a shorter text's only shingle belongs to another length
        yield text[enough], at[enough] - starts[text[enough]], codes[at[enough]]


def _text_runs(column: pa.Array) -> Iterator[tuple[int, list[bytes | None]]]:
    """Runs of texts of about BATCH_WORDS * 8 bytes, and where each begins."""
    texts = column.cast(pa.large_binary()).to_pylist()
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= 8 * BATCH_WORDS or i == len(texts) - 1:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0


def _seen(batches: Iterator[pa.RecordBatch], sizes: list[int], shared) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in _text_runs(batch.column(0)):
            for _, _, codes in _candidates(texts, sizes, shared.value):
                unique, n = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(unique.astype(np.int64)), pa.array(n.astype(np.int64))], names=["code", "n"])


def _around(batches: Iterator[pa.RecordBatch], sizes: list[int], shared) -> Iterator[pa.RecordBatch]:
    """``digest, code, at, off, context``: a candidate's position, and the words around it (it is word ``off`` of them)."""
    names = ["digest", "code", "at", "off", "context"]
    types = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.binary())]
    for batch in batches:
        digests = batch.column(0).to_pylist()
        for first, texts in _text_runs(batch.column(1)):
            held: list[list] = [[] for _ in names]
            split: tuple[int, list[bytes]] = (-1, [])
            for found in _candidates(texts, sizes, shared.value):
                for text, at, code in zip(*(x.tolist() for x in (found[0], found[1], found[2].astype(np.int64)))):
                    if split[0] != text:
                        split = text, words(texts[text])
                    low = max(0, at - WINDOW)
                    for column, value in zip(held, (digests[first + text], code, at, at - low, split[1][low : at + WINDOW])):
                        column.append(value)
                    if len(held[0]) >= SENT_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, types)], names=names)
                        held = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, types)], names=names)


def _found_by_shuffle(docs: DataFrame, windows: DataFrame, text_col: str) -> DataFrame:
    """``digest, n_hit, n_items, items_sha256`` of the distinct texts that hold a window; every step is a join or an aggregate."""
    context, text = docs.sparkSession.sparkContext, F.col(text_col).cast("string")
    named = staged(windows.select(F.unhex(F.md5("window")).alias("wid"), "item", "window"), "decontaminate-windows")
    distinct = named.select("wid", "window").dropDuplicates(["wid"])
    shingles = staged(distinct.mapInArrow(_window_shingles, "wid binary, code long, place int"), "decontaminate-shingles")
    length = F.size(F.split(F.col("window").cast("string"), " "))
    sizes = sorted(r[0] for r in distinct.select(F.least(length, F.lit(SHINGLE)).alias("size")).distinct().collect())  # 1 to SHINGLE

    bits = context.broadcast(bit_filter(shingles.select("code").distinct()))
    seen = docs.select(text.alias("text")).mapInArrow(partial(_seen, sizes=sizes, shared=bits), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "code", "place")).alias("r")
    # a window with a shingle that no document has occurs nowhere
    prefix = shingles.join(seen, "code", "left").groupBy("wid").agg(rarest).where("r.n > 0").select("wid", "r.code", "r.place")
    gram = F.transform(F.split(F.col("window").cast("string"), " "), lambda w: w.cast("binary")).alias("gram")
    tokens = staged(prefix.join(distinct, "wid").select("wid", "code", "place", gram), "decontaminate-tokens")

    bits = context.broadcast(bit_filter(tokens.select("code").distinct()))
    digest = F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))).alias("digest")
    met = docs.select(digest, text.alias("text")).mapInArrow(partial(_around, sizes=sizes, shared=bits), "digest binary, code long, at int, off int, context array<binary>")
    inside = F.slice("context", F.greatest(F.lit(1), F.col("off") - F.col("place") + 1), F.size("gram")) == F.col("gram")
    verified = met.dropDuplicates(["digest", "code", "at"]).join(tokens, "code").where((F.col("off") >= F.col("place")) & inside)
    start = F.col("at") - F.col("place")
    spans = staged(verified.select("digest", "wid", start.alias("a"), (start + F.size("gram")).alias("b")), "decontaminate-spans")

    earlier = F.coalesce(F.max("b").over(Window.partitionBy("digest").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = F.greatest(F.lit(0), F.col("b") - F.greatest(F.col("a"), earlier)).cast("long")
    hits = spans.select("digest", "a", "b").distinct().select("digest", fresh.alias("new")).groupBy("digest").agg(F.sum("new").alias("n_hit"))
    items = spans.select("digest", "wid").distinct().join(named.select("wid", "item"), "wid").select("digest", "item").distinct()
    listed = items.groupBy("digest").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return hits.join(listed, "digest").select("digest", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))


def marked(docs: DataFrame, benchmark: DataFrame, name: str = "mark", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with one more column ``name``: a struct of n_words, n_hit, n_items, items_sha256, contaminated.

    ``name`` must not be a column of ``docs`` yet.
    """
    windows = item_windows(benchmark, item_col, item_text_col)
    size = windows.agg(F.sum(F.octet_length("window") + F.octet_length("item") + 32)).first()[0] or 0
    if size <= block_bytes:
        return docs.withColumn(name, _broadcast_mark(docs, windows, text_col))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = "_" * (1 + max(map(len, [*docs.columns, name])))  # a name that no column has
    found = _found_by_shuffle(docs, windows, text_col).withColumnRenamed("digest", key)
    of = lambda c: F.col(f"{key}f.{c}")
    none = F.sha2(F.lit("").cast("binary"), 256)
    mark = F.struct(
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), F.coalesce(of("n_hit"), F.lit(0)).cast("long").alias("n_hit"), F.coalesce(of("n_items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(of("items_sha256"), none).alias("items_sha256"), of("n_hit").isNotNull().alias("contaminated"),
    )
    found = found.select(key, F.struct("n_hit", "n_items", "items_sha256").alias(f"{key}f"))
    return docs.withColumn(key, F.unhex(F.md5(text.cast("binary")))).join(found, key, "left").withColumn(name, mark).drop(key, f"{key}f")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: words, words inside benchmark windows, items met and their digest."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return marked(rows, benchmark, **options).select("doc_id", "mark.*")
