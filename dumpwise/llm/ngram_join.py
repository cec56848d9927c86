"""N-gram Jaccard join with Bayesian candidate pruning (operator 8).

Links documents whose sets of 5-word shingles have Jaccard similarity >= 0.8.

1. Exact copies (equal text) form a class; from here on a class counts once.
2. Each class gets HASHES MinHash values, cut into bands of ROWS; classes that
   share a band are candidates. A pair at 0.8 shares none with probability
   (1 - 0.8**5)**20 < 0.0004, and only if no chain of candidates joins it.
3. Inside a bucket, pairs compare their MinHash values STEP at a time. With a
   uniform prior, the similarity given m matches of n is Beta(m+1, n-m+1); a
   pair is dropped as soon as the probability of reaching 0.8 falls below
   ``TOLERANCE``. A bucket hands on only enough edges to connect what survives. A
   bucket of more than BUCKET classes does the same in tiles, in many tasks
   (``crowds``).
4. The components of these edges are the verification groups. A group holds
   the texts of its classes once; all its pairs are pruned as above and the
   rest is verified exactly on the shingles themselves. A group of more than
   TILE_WORDS words is cut into tiles, and each pair of tiles is one piece of
   work, so no group is ever collected in one task and none is capped.

The result has one row per document, never one per pair: class, number of other
documents linked directly (copies included), smallest id of the component, and
whether the document is that one.

Words: A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A text of 1 to 4
words is one shingle; a text without words (or null) links with nothing, not even
its copies. Rows with null id link with nothing and are kept. Repeated rows count
as copies of each other. An id may name several texts: texts are told apart by
their digest, ids only name classes and components. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpwise.llm.common import byte_column, mix64, partitions, staged, words
from dumpwise.llm.crowds import crowded_edges
from dumpwise.llm.graph import components, roots
from dumpwise.llm.wordhash import shingles_of_texts

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 5
HASHES = BANDS * ROWS
STEP = 20
TOLERANCE = 1e-6
BUCKET = 1000
TILE_WORDS = 500_000
RUN_BYTES = 1 << 20

_random = np.random.default_rng(20240607)
_XOR = _random.integers(0, 2**32, HASHES, dtype=np.uint32)
_MULTIPLY = _random.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After n compared values, the fewest matches with which P(similarity >= threshold) is still >= tolerance.

    The Beta(m+1, n-m+1) tail is a binomial sum: P(S >= t) = P(Bin(n+1, t) <= m).
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def surviving(signatures: np.ndarray, others: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Which pairs (row of ``signatures``, row of ``others``) survive the incremental comparison."""
    alive = np.ones((len(signatures), len(others)), bool)
    matches = np.zeros(alive.shape, np.int16)
    for n, m in least.items():
        if alive.mean() > 0.05:
            for k in range(n - STEP, n):
                matches += signatures[:, k, None] == others[None, :, k]
        else:
            i, j = np.nonzero(alive)
            matches[i, j] += (signatures[i, n - STEP : n] == others[j, n - STEP : n]).sum(axis=1).astype(np.int16)
        alive &= matches >= m
        if not alive.any():
            break
    return alive


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, digest, n_words, signature) of every row, in runs of about RUN_BYTES of text."""
    for batch in batches:
        texts = byte_column(batch, "text")
        first, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text or b"") + 1
            if size < RUN_BYTES and i < len(texts) - 1:
                continue
            codes, starts, counts = shingles_of_texts(texts[first : i + 1], SHINGLE)
            small = (codes >> np.uint64(32)).astype(np.uint32)
            sigs = np.zeros((len(counts), HASHES), np.uint32)
            has = np.diff(np.append(starts, len(codes))) > 0
            if has.any():
                at = starts[has]
                for k in range(HASHES):
                    sigs[has, k] = np.minimum.reduceat((small ^ _XOR[k]) * _MULTIPLY[k], at)
            rows = batch.slice(first, i + 1 - first)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(counts), pa.array([s.tobytes() if h else None for s, h in zip(sigs, has)], pa.binary())], names=["doc_id", "digest", "n_words", "signature"]
            )
            first, size = i + 1, 0


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), sigs.shape[:2])
        for r in range(ROWS):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + sigs[:, :, r])
        ids = np.repeat(batch.column(0).to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(ids)], names=["band", "class_id"])


def runs(batches: Iterator[pa.RecordBatch], same: Callable[[dict], tuple]) -> Iterator[list[dict]]:
    """Consecutive rows with equal keys; the rows must come sorted by the key."""
    held: list[dict] = []
    key = None
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            for row in batch.slice(i, 512).to_pylist():
                if held and same(row) != key:
                    yield held
                    held = []
                key = same(row)
                held.append(row)
    if held:
        yield held


def _near(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Which pairs of signatures survive the incremental comparison."""
    matrix = lambda column: np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)
    return surviving(matrix(left), matrix(right), least_matches())


def _bucket_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect the surviving pairs of each bucket."""
    least = least_matches()
    for bucket in runs(batches, lambda r: (r["band"],)):
        ids = [r["class_id"] for r in bucket]
        sigs = np.frombuffer(b"".join(r["signature"] for r in bucket), np.uint32).reshape(-1, HASHES)
        root = roots(len(ids), zip(*np.nonzero(np.triu(surviving(sigs, sigs, least), 1))))
        a, b = [ids[i] for i, r in enumerate(root) if i != r], [ids[r] for i, r in enumerate(root) if i != r]
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], wanted: np.ndarray, n_shingles: int) -> np.ndarray:
    """Common shingles of the wanted pairs: one by one if they are few, else by products of incidence blocks."""
    common = np.zeros(wanted.shape, np.float32)
    pairs = np.argwhere(wanted)
    if len(pairs) <= 8 * (len(left) + len(right)):
        for i, j in pairs:
            common[i, j] = len(np.intersect1d(left[i], right[j], assume_unique=True))
        return common

    def marked(sets: list[np.ndarray]) -> np.ndarray:
        found = np.zeros(n_shingles, bool)
        for s in sets:
            found[s] = True
        return found

    # shingles of one side only, or of one text, cannot be common
    uses = np.zeros(n_shingles, np.int32)
    for s in left if left is right else [*left, *right]:
        uses[s] += 1
    used = np.flatnonzero((uses > 1) & marked(left) & marked(right))
    column = np.full(n_shingles, -1)
    column[used] = np.arange(len(used))
    width = max(256, (1 << 24) // max(1, len(left) + len(right)))

    def block(sets: list[np.ndarray], first: int) -> np.ndarray:
        out = np.zeros((len(sets), min(width, len(used) - first)), np.float32)
        for i, s in enumerate(sets):
            c = column[s] - first
            out[i, c[(c >= 0) & (c < out.shape[1])]] = 1
        return out

    for first in range(0, len(used), width):
        a = block(left, first)
        common += a @ (a if left is right else block(right, first)).T
    return common


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece of work and class: documents linked directly, and the smallest class it is linked to by a chain."""
    least = least_matches()
    for piece in runs(batches, lambda r: (r["group"], r["i"], r["j"])):
        piece.sort(key=lambda r: r["class_id"])
        ids: dict[bytes, int] = {}
        sets = []
        for row in piece:
            w = words(row["text"])
            grams = {b" ".join(w[k : k + SHINGLE]) for k in range(max(1, len(w) - SHINGLE + 1))}
            sets.append(np.array(sorted(ids.setdefault(g, len(ids)) for g in grams), np.int64))
            row["text"] = None
        sigs = np.frombuffer(b"".join(r["signature"] for r in piece), np.uint32).reshape(-1, HASHES)
        sizes = np.array([len(s) for s in sets], np.float64)
        copies = np.array([r["copies"] for r in piece], np.int64)
        if piece[0]["i"] == piece[0]["j"]:
            left = right = np.arange(len(piece))
        else:
            tile = np.array([r["tile"] for r in piece])
            left, right = np.flatnonzero(tile == piece[0]["i"]), np.flatnonzero(tile == piece[0]["j"])
        wanted = surviving(sigs[left], sigs[right], least)
        same = left is right
        if same:
            wanted = np.triu(wanted, 1)
        x = [sets[i] for i in left]
        common = _overlaps(x, x if same else [sets[i] for i in right], wanted, len(ids))
        union = sizes[left][:, None] + sizes[right][None, :] - common
        linked = wanted & (common >= THRESHOLD * union - 1e-9)
        n = np.zeros(len(piece), np.int64)
        np.add.at(n, left, linked.astype(np.int64) @ copies[right])
        np.add.at(n, right, linked.T.astype(np.int64) @ copies[left])
        i, j = np.nonzero(linked)
        root = roots(len(piece), zip(left[i].tolist(), right[j].tolist()))
        classes = [r["class_id"] for r in piece]
        yield pa.RecordBatch.from_arrays(
            [pa.array(classes, pa.int64()), pa.array(n), pa.array([classes[r] for r in root], pa.int64()), pa.array([r["tiles"] for r in piece], pa.int64())], names=["class_id", "linked", "root", "tiles"]
        )


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile_words: int = TILE_WORDS, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, class_id, n_links, component_id, kept`` for every row of ``docs``."""
    return joined_rows(docs, id_col, text_col, tile_words, bucket).drop("digest")


def joined_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile_words: int = TILE_WORDS, bucket: int = BUCKET) -> DataFrame:
    """The join's rows with the ``digest`` (MD5) of their text, which tells the rows of an id that names several texts apart."""
    spark = docs.sparkSession
    n = partitions(spark)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("digest"), text.alias("text"))
    signed = staged(rows.mapInArrow(_signatures, "doc_id long, digest binary, n_words long, signature binary"), "ngram-signatures")
    classes = (
        signed.where("doc_id is not null and signature is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("label"), F.count(F.lit(1)).alias("copies"), F.first("signature").alias("signature"), F.first("n_words").alias("n_words"))
    )
    # a number of its own for every text; ids are only labels, one may name several texts
    classes = staged(classes.withColumn("class_id", F.monotonically_increasing_id()), "ngram-classes")

    bands = staged(classes.select("class_id", "signature").mapInArrow(_bands, "band long, class_id long"), "ngram-bands")
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = staged(bands.join(shared, "band"), "ngram-members")
    signed_members = lambda test: members.where(test).join(classes.select("class_id", "signature"), "class_id").select("band", "class_id", "signature")
    small = signed_members(F.col("n") <= bucket)
    edges = small.repartition(n, "band").sortWithinPartitions("band", "class_id").mapInArrow(_bucket_edges, "a long, b long")
    if members.where(F.col("n") > bucket).limit(1).count():
        edges = edges.unionByName(crowded_edges(signed_members(F.col("n") > bucket), "band", "signature", _near, bucket))
    groups = staged(components(edges), "ngram-groups")

    tiles = (
        groups.join(classes, groups["node"] == classes["class_id"]).groupBy("component").agg(F.sum("n_words").alias("w"))
        .select(F.col("component").alias("group"), F.ceil(F.col("w") / tile_words).cast("long").alias("tiles"))
    )
    texts = rows.where("doc_id is not null").select("doc_id", "digest", "text")
    placed = (
        groups.join(tiles, F.col("component") == F.col("group")).join(classes, F.col("node") == F.col("class_id"))
        .select("class_id", "label", "digest", "copies", "signature", "group", "tiles", F.pmod(F.xxhash64("class_id"), F.col("tiles")).alias("tile"))
    )
    full = placed.join(texts.withColumnRenamed("digest", "d"), (F.col("doc_id") == F.col("label")) & (F.col("d") == F.col("digest"))).drop("doc_id", "d", "digest", "label").dropDuplicates(["class_id"])
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    work = full.withColumn("other", other).withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other")).withColumn("text", F.col("text").cast("binary")).drop("other")
    found = work.repartition(n, "group", "i", "j").sortWithinPartitions("group", "i", "j").mapInArrow(_verified, "class_id long, linked long, root long, tiles long")
    found = staged(found, "ngram-verified")

    linked = found.groupBy("class_id").agg(F.sum("linked").alias("linked"), F.min("root").alias("root"))
    cut = found.where("tiles > 1")
    if cut.limit(1).count():
        chained = components(cut.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
        linked = linked.join(chained, F.col("class_id") == F.col("node"), "left").withColumn("root", F.coalesce("component", "root")).drop("node", "component")
    linked = linked.join(classes.select("class_id", "label"), "class_id")
    named = linked.groupBy("root").agg(F.min("label").alias("component_id"))
    linked = linked.join(named, "root").select("class_id", "linked", "component_id")
    per_class = classes.select("digest", "class_id", "label", "copies").join(linked, "class_id", "left").select(
        "digest", "label", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n"), F.coalesce("component_id", "label").alias("component_id"))
    # equal texts share a digest; rows without words or id match no class
    out = signed.where("doc_id is not null and signature is not null").join(per_class, "digest")
    alone = signed.where("doc_id is null or signature is null")
    done = out.select("doc_id", F.col("label").alias("class_id"), F.col("n").alias("n_links"), "component_id", "digest")
    rest = alone.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id"), "digest")
    return done.unionByName(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))).select("doc_id", "class_id", "n_links", "component_id", "kept", "digest")
