"""Language ID with language-bitmask n-gram filters (operator 10).

The model is a bit-sliced Bloom filter: an array of rows, each row a bitmask
with one bit per language. An n-gram (4 bytes of lower-cased text, everything
ASCII that is no letter being a space) sets its languages' bits in K rows;
looking it up is the AND of its K rows, which returns all languages containing
it at once. A text's hits are counted per language (popcounts of the bit
slices) and corrected for the filter's false positives: with f the chance that
a foreign n-gram has bit l set in all its rows, hits = true + (n - true) * f.
The language with the most corrected hits wins; the score is its share of the
text's n-grams.

Training counts (n-gram, language) pairs over all training texts. A language
contains an n-gram if it uses it at a rate of at least ``MIN_RATE`` and at no
less than ``SHARE`` of the highest rate any language has, so foreign passages in
a language's texts do not blur the filter. ``MIN_RATE`` bounds the n-grams per
language by 1 / MIN_RATE and with it the filter, which is therefore safe to
broadcast: at most 2**24 rows.

Cases: null text or a text without any letter is ``und`` with score 0; a text
that is too short or foreign to hit anything gets the language with most
training n-grams and score 0; without training rows every text is ``und``; repeated
rows repeat; an empty table gives no rows; extra columns are ignored. Texts are
read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpwise.llm.common import mix64, staged

N = 4
K = 3
ROWS_PER_GRAM = 16
MIN_RATE = 1e-6
SHARE = 0.3
MAX_LANGUAGES = 4096
RUN_BYTES = 1 << 22
LETTER = regex.compile(r"\p{L}")
# ASCII letters and all bytes from 0x80 on stay; the rest is a space
KEEP = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def gram_codes(data: np.ndarray) -> np.ndarray:
    """The N-byte windows of ``data`` as uint32; 0 where a window has two spaces in a row."""
    n = len(data) - N + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    code = np.zeros(n, np.uint32)
    for k in range(N):
        code <<= np.uint32(8)
        code |= data[k : n + k]
    pair = (data[1:] == 0x20) & (data[:-1] == 0x20)
    for k in range(N - 1):
        code[pair[k : n + k]] = 0
    return code


def prepared(text: str) -> bytes:
    """A text for ``gram_codes``: lower case, spaces for non-letters, two spaces around."""
    return b"  " + text.lower().encode("utf-8", "replace").translate(KEEP) + b"  "


def places(codes: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The K filter rows of each n-gram (``size`` is a power of two)."""
    wide = codes.astype(np.uint64)
    first = mix64(wide + np.uint64(0x51ED270B))
    second = (first >> np.uint64(32)) | np.uint64(1)
    for i in range(K):
        yield ((first + np.uint64(i) * second) & np.uint64(size - 1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """``rows``: one uint64 mask per filter row and 64 languages; languages[0] has most training n-grams."""

    languages: tuple[str, ...]
    rows: np.ndarray  # (size, ceil(languages / 64))
    false_rate: np.ndarray  # per language

    def hits(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Hits per text and language; ``starts``: where each text's codes begin."""
        out = np.zeros((len(starts), len(self.languages)), np.int64)
        at = list(places(codes, len(self.rows)))
        for word in range(self.rows.shape[1]):
            mask = self.rows[at[0], word]
            for p in at[1:]:
                mask &= self.rows[p, word]
            mask[codes == 0] = 0
            total = np.zeros(len(mask) + 1, np.int64)
            for bit, language in enumerate(range(word * 64, min(len(self.languages), word * 64 + 64))):
                np.cumsum((mask >> np.uint64(bit)) & np.uint64(1), out=total[1:])
                out[:, language] = np.diff(total[np.append(starts, len(mask))])
        return out


def _grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task's rows, merged every few million entries."""
    held: dict[str, list[bytes]] = {}
    counts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged(parts):
        grams = np.concatenate([p[0] for p in parts])
        n = np.concatenate([p[1] for p in parts])
        unique, where = np.unique(grams, return_inverse=True)
        return unique, np.bincount(where, n, len(unique)).astype(np.int64)

    def fold():
        for lang, texts in held.items():
            unique, n = np.unique(gram_codes(np.frombuffer(b"".join(texts), np.uint8)), return_counts=True)
            known = unique != 0
            counts[lang] = [merged([*counts.get(lang, []), (unique[known], n[known])])]
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = prepared(text.as_py())
            held.setdefault(lang, []).append(data)
            size += len(data)
            if size >= RUN_BYTES:
                fold()
                size = 0
    fold()
    for lang, ((grams, n),) in counts.items():
        for i in range(0, len(grams), 100_000):
            g = grams[i : i + 100_000].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n[i : i + 100_000])], names=["lang", "gram", "n"])


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The filter of all rows that have a text and a language."""
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = staged(rows.mapInArrow(_grams_of, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the column is no language label")
    if not totals:
        return Model((), np.zeros((1, 1), np.uint64), np.zeros(0))
    languages = tuple(r["lang"] for r in totals)
    index = F.create_map(*[F.lit(x) for i, r in enumerate(totals) for x in (r["lang"], i)])
    total = F.create_map(*[F.lit(x) for r in totals for x in (r["lang"], float(r["total"]))])
    rates = counts.where("n > 1").withColumn("rate", F.col("n") / total[F.col("lang")]).where(F.col("rate") >= MIN_RATE)
    # at most one entry per language in each list
    users = rates.groupBy("gram").agg(F.max("rate").alias("top"), F.collect_list(F.struct(index[F.col("lang")].alias("i"), "rate")).alias("users"))
    owners = users.select("gram", F.transform(F.filter("users", lambda u: u["rate"] >= F.col("top") * SHARE), lambda u: u["i"]).alias("owners"))
    owners = staged(owners, "language-owners")
    most = owners.select(F.explode("owners").alias("i")).groupBy("i").count().agg(F.max("count")).first()[0] or 1
    size = 1 << max(10, int(np.ceil(np.log2(ROWS_PER_GRAM * most))))
    words = -(-len(languages) // 64)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column(0).to_numpy().astype(np.uint32)
            masks = np.zeros((len(grams), words), np.uint64)
            for k, owned in enumerate(batch.column(1).to_pylist()):
                for i in owned:
                    masks[k, i // 64] |= np.uint64(1) << np.uint64(i % 64)
            for p in places(grams, size):
                for w in range(words):
                    yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(np.full(len(p), w, np.int32)), pa.array(masks[:, w].view(np.int64))], names=["place", "word", "mask"])

    # one number per filter row and 64 languages, bounded by the filter's size
    filled = owners.mapInArrow(marks, "place long, word int, mask long").groupBy("place", "word").agg(F.bit_or("mask").alias("mask")).where("mask <> 0").toArrow()
    table = np.zeros((size, words), np.uint64)
    table[filled["place"].to_numpy(), filled["word"].to_numpy()] = filled["mask"].to_numpy().view(np.uint64)
    fill = np.array([np.mean((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)) for i in range(len(languages))])
    return Model(languages, table, fill**K)


def decide(texts: list[str | None], m: Model) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    data = [prepared(t) if t else b"" for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in data])[:-1]]).astype(np.int64)
    codes = gram_codes(np.frombuffer(b"".join(data) + b" " * (N - 1), np.uint8))
    grams = np.diff(np.concatenate([[0], np.cumsum(codes != 0)])[np.append(starts, len(codes))])
    found = m.hits(codes, starts) if len(codes) and m.languages else np.zeros((len(texts), max(1, len(m.languages))))
    true = np.clip((found - grams[:, None] * m.false_rate) / (1 - m.false_rate), 0, None) if m.languages else found
    best = true.argmax(axis=1)
    share = true[np.arange(len(texts)), best] / np.maximum(grams, 1)
    known = [bool(t) and bool(m.languages) and LETTER.search(t) is not None for t in texts]
    return [m.languages[b] if k else "und" for b, k in zip(best, known)], [float(min(1.0, s)) if k else 0.0 for s, k in zip(share, known)]


def language_of(text: Column, model: Model, spark: SparkSession) -> Column:
    """``struct<lang, score>`` of a text column; the texts themselves stay in the JVM."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            langs, scores, run, size = [], [], [], 0
            for i, x in enumerate(column):
                run.append(x.as_py())
                size += len(run[-1] or "")
                if size >= RUN_BYTES or i == len(column) - 1:
                    a, b = decide(run, shared.value)
                    langs, scores, run, size = langs + a, scores + b, [], 0
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])

    return predict(text.cast("string"))


def fold_of(id_col: str, folds: int):
    """crc32 of the id as text, modulo ``folds`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


def predictions(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: trained on all folds but ``held``, applied to every row."""
    held_out = fold_of("doc_id", folds) == held
    model = train(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), language_of(F.col("text"), model, docs.sparkSession).alias("found"))
    return rows.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
