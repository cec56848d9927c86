"""LM scoring by context-tree weighting over bytes (operator 2).

The model predicts a text byte by byte (A-Z lower-cased, 0xFF as end). A byte is
eight binary decisions; each decision is predicted in the context of the bits
already known and of the last d bytes, for all depths d = 0..DEPTH at once. A
node (context, bits so far) keeps how many zeros and ones followed it in the
training texts, its Krichevsky-Trofimov estimate Pe = KT(zeros, ones), and the
weighted probability Pw = (Pe + product of the children's Pw) / 2; at full depth
Pw = Pe. The next bit's probability mixes the depths with the posterior weight
Pe / (Pe + product) of stopping at a node. A text's score is the sum of the
log10 probabilities of its bytes and its end.

As Spark jobs:

1. Documents are dealt into blocks of about ``BLOCK_BYTES`` (up to 1.5 times that), by id and text (only
   repetitions of a whole row share a block for certain). A block reports its
   distinct words and (DEPTH + 1)-byte windows with their training counts, as
   arrays per hash bucket (keys in order and packed, see ``pack``).
2. Buckets add the counts of all blocks up. Words get their corpus count back.
3. The distinct windows are dealt by their last two context bytes and processed
   by their last three. Whatever the corpus, such a group has at most 2**24
   windows, so it fits a task; it yields all nodes of depth 3 and more. Nodes of
   depth 2 are rows of a table (one per context and bit path). Depths 0 and 1 have
   65,280 nodes at most and are finished on the driver from sums per node.
4. Every window gets its log probability, goes back to the blocks that asked for
   it, and the blocks score their documents.

Nothing that grows with the corpus is broadcast or collected.

A task's Python worker holds one block's distinct windows, or one bucket's, and
what it hands over; texts pass in slices. Blocks and buckets are dealt round-robin
by their number, and Arrow batches are kept to ``BATCH_BYTES``, since rows of texts
and lists are long.

Words are keyed by 64 bits of hash: among 10**10 distinct words a few pairs may
share a count. Cases: null text is
empty (one end token); without training rows all counts are 0 and every bit has
probability 1/2; repeated rows count repeatedly; an empty table gives no rows;
extra columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpwise.llm.common import byte_column, drained, limited_batches, mix64, partitions, staged
from dumpwise.llm.wordhash import word_hashes

DEPTH = 5
FIRST, PAIR, TRIPLE = 8 * DEPTH, 8 * (DEPTH - 1), 8 * (DEPTH - 2)  # where a window's key holds its last one, two, three context bytes
END = 0xFF  # no byte of UTF-8
END_KEY = -0x61C8864680B583EB  # the end token among the word keys
SPACES = b" \t\n\r\x0b\x0c"
SPACE_TABLE = bytes(0x20 if c in SPACES else c for c in range(256))
BLOCK_BYTES = 16 << 20
SLICE = 1 << 20
PENDING = 1 << 18  # keys a tally collects at least before it adds them up
BATCH_BYTES = 4 << 20
MODEL_ROWS = 100_000
LN10 = math.log(10)

TALLY = "kind string, bucket long, block long, keys binary, counts array<long>"
ANSWER = "block long, kind string, keys binary, n array<long>, lp array<double>"


# --- words and windows of texts

def pieces(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """Runs of about SLICE bytes of (index, text); a longer text comes in pieces that never cut a word."""
    held: list[tuple[int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            cut = min(len(text), at + SLICE)
            while cut < len(text) and text[cut] not in SPACES:
                cut += 1
            held.append((i, text[at:cut]))
            size += cut - at
            at = cut
            if size >= SLICE:
                yield held
                held, size = [], 0
    if held:
        yield held


def word_keys(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word keys, index of their text) in runs; a key is a 64-bit hash of the word."""
    for run in pieces(texts):
        hashes, counts = word_hashes([b for _, b in run], SPACE_TABLE)
        yield hashes.view(np.int64), np.repeat(np.array([i for i, _ in run]), counts)


def windows(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window keys, index of their text) in slices; a window is a byte with its DEPTH predecessors.

    A key has the most recent context byte on top and the predicted byte last.
    Before its first byte a text has DEPTH end marks.
    """
    pad, end = bytes([END]) * DEPTH, bytes([END])
    held: list[tuple[int, bytes]] = []
    size = 0

    def keys() -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(b for _, b in held), np.uint8)
        lengths = np.array([len(b) for _, b in held])
        first = np.cumsum(lengths) - lengths
        real = np.ones(len(data), bool)
        for k in range(DEPTH):
            real[first + k] = False
        at = np.flatnonzero(real)
        key = np.zeros(len(at), np.int64)
        for k in range(1, DEPTH + 1):
            key = (key << 8) | data[at - k]
        return (key << 8) | data[at], np.repeat(np.array([i for i, _ in held]), lengths - DEPTH)

    for i, text in enumerate(texts):
        whole = pad + text + end
        for at in range(DEPTH, len(whole), SLICE):
            held.append((i, whole[at - DEPTH : at + SLICE]))
            size += len(held[-1][1])
            if size >= SLICE:
                yield keys()
                held, size = [], 0
    if held:
        yield keys()


def add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts; a stable sort merges runs of ordered keys."""
    if not sum(map(len, keys)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    together = np.concatenate(keys)
    order = np.argsort(together, kind="stable")
    together = together[order]
    new = np.ones(len(together), bool)
    np.not_equal(together[1:], together[:-1], out=new[1:])
    first = np.flatnonzero(new)
    unique = together[first]
    del together, new
    return unique, np.add.reduceat(np.concatenate(counts)[order], first)


class Tally:
    """Distinct keys with the sums of their counts; what is pending is added up once it outgrows the rest."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, learned: bool) -> None:
        """Count each key once per occurrence, or not at all if it is not learned from."""
        unique, n = np.unique(keys, return_counts=True)
        self.pending.append((unique, n if learned else np.zeros(len(n), np.int64)))
        self.size += len(unique)
        if self.size > max(PENDING, len(self.keys)):
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys in order and their counts."""
        if self.pending:
            keys, counts = zip((self.keys, self.counts), *self.pending)
            self.pending, self.size = [], 0
            self.keys, self.counts = add_up(list(keys), list(counts))
        return self.keys, self.counts


class BlockTally:
    """Words and windows of one block's texts, taken in slices, so that the texts need not be held."""

    def __init__(self):
        self.words, self.windows = Tally(), Tally()
        self.texts: dict[bool, list[bytes]] = {True: [], False: []}
        self.size = {True: 0, False: 0}

    def add(self, text: bytes, learned: bool) -> None:
        self.texts[learned].append(text)
        self.size[learned] += len(text) + DEPTH + 1
        if self.size[learned] >= SLICE:
            self._count(learned)

    def _count(self, learned: bool) -> None:
        texts, self.texts[learned], self.size[learned] = self.texts[learned], [], 0
        for keys, _ in word_keys(texts):
            self.words.add(keys, learned)
        for codes, _ in windows(texts):
            self.windows.add(codes, learned)
        self.words.add(np.full(len(texts), END_KEY), learned)

    def totals(self) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """(kind, distinct keys in order, counts) of words and of windows."""
        for learned in (True, False):
            self._count(learned)
        yield "w", *self.words.total()
        yield "g", *self.windows.total()


# --- the tree

def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for 0 < x < 1e30: Stirling's series at x + 8, less the logarithm of the eight factors passed."""
    factors = np.ones_like(x)
    for k in range(8):
        factors = factors * (x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) + 1 / (1188 * y**9)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(factors)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi) - log_gamma(zeros + ones + 1.0)


def stop_weight(own: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Posterior weight of stopping at a node: Pe / (Pe + product of the children's Pw)."""
    return 1 / (1 + np.exp(np.clip(below - own, -700, 700)))


def _numbered(order: np.ndarray, *parts: np.ndarray) -> tuple[np.ndarray, int]:
    """Ids of equal (parts) combinations, given an order in which equals are neighbours."""
    if not len(order):
        return order, 0
    new = np.zeros(len(order), bool)
    for p in parts:
        s = p[order]
        new[1:] |= s[1:] != s[:-1]
    ids = np.empty(len(order), np.int64)
    ids[order] = np.cumsum(new)
    return ids, int(ids[order[-1]]) + 1


def deep_nodes(keys: np.ndarray, counts: np.ndarray, top: int = 3):
    """For each bit: the nodes of depth ``top`` and the probability that depths >= top give each window's bit.

    ``keys`` must hold all windows of every depth-``top`` context in it, in order.
    Yields (bit index, node path per window, bit per window, probability per
    window, representative windows, zeros, ones, ln Pw of the depth-``top`` nodes).
    """
    symbol = keys & 0xFF
    prefix = {d: keys >> (8 * (DEPTH - d) + 8) for d in range(top, DEPTH + 1)}
    order = {d: np.lexsort((symbol, prefix[d])) for d in prefix}
    weight = counts.astype(np.float64)
    for i in range(8):
        path = (1 << i) | (symbol >> (8 - i))
        bit = (symbol >> (7 - i)) & 1
        below_ids = below_reps = below_pw = None
        p = np.full(len(keys), 0.5)
        for d in range(DEPTH, top - 1, -1):
            ids, n = _numbered(order[d], prefix[d], path)
            ones = np.bincount(ids, weight * bit, n)
            zeros = np.bincount(ids, weight * (1 - bit), n)
            pe = log_kt(zeros, ones)
            kt = (np.where(bit == 1, ones[ids], zeros[ids]) + 0.5) / (zeros[ids] + ones[ids] + 1)
            if below_ids is None:
                pw, p = pe, kt
            else:
                product = np.bincount(ids[below_reps], below_pw, n)
                stop = stop_weight(pe, product)[ids]
                p = stop * kt + (1 - stop) * p
                pw = np.logaddexp(pe, product) - math.log(2)
            reps = np.empty(n, np.int64)
            reps[ids] = np.arange(len(keys))
            below_ids, below_reps, below_pw = ids, reps, pw
        yield i, path, bit, p, reps, zeros, ones, pw


class UpperTree:
    """Depths 0 and 1: stop weights and KT estimates per (context byte, path), from sums over depth 2."""

    def __init__(self, rows: list[tuple[int, int, float, float, float]]):
        zeros, ones, product = np.zeros((256, 256)), np.zeros((256, 256)), np.zeros((256, 256))
        for byte, path, a, b, pw in rows:
            zeros[byte, path], ones[byte, path], product[byte, path] = a, b, pw
        pe = log_kt(zeros.reshape(-1), ones.reshape(-1)).reshape(256, 256)
        self.stop1 = stop_weight(pe, product)
        self.one1 = (ones + 0.5) / (zeros + ones + 1)
        pw = np.logaddexp(pe, product) - math.log(2)
        seen = zeros + ones > 0
        a0, b0 = zeros.sum(axis=0), ones.sum(axis=0)
        self.stop0 = stop_weight(log_kt(a0, b0), np.where(seen, pw, 0).sum(axis=0))
        self.one0 = (b0 + 0.5) / (a0 + b0 + 1)

    def mixed(self, context: np.ndarray, path: np.ndarray, bit: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Mix depths 1 and 0 into the probability ``p`` of depths 2 and more."""
        for stop, one in ((self.stop1[context, path], self.one1[context, path]), (self.stop0[path], self.one0[path])):
            p = stop * np.where(bit == 1, one, 1 - one) + (1 - stop) * p
        return p


def pair_nodes(zeros: np.ndarray, ones: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stop weight, KT probability of a one, ln Pw) of depth-2 nodes, from their counts and their children's ln Pw."""
    pe = log_kt(zeros, ones)
    return stop_weight(pe, product), (ones + 0.5) / (zeros + ones + 1), np.logaddexp(pe, product) - math.log(2)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by key in pieces of about MODEL_ROWS that never cut a three-byte context; node rows (key < 0) come along."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= MODEL_ROWS:
            whole = pa.Table.from_batches(held).combine_chunks()
            group = np.maximum(whole["key"].to_numpy(), -1) >> TRIPLE
            changes = np.flatnonzero(np.diff(group)) + 1
            cut = int(changes[-1]) if len(changes) else 0
            if cut:
                yield whole.slice(0, cut)
            held, size = whole.slice(cut).to_batches(), whole.num_rows - cut if cut else 0
    if held:
        yield pa.Table.from_batches(held)


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and children's ln Pw per depth-2 node (last two context bytes, bit path)."""
    for rows in _whole_groups(batches):
        keys, counts = rows["key"].to_numpy(), rows["n"].to_numpy()
        for _, path, _, _, reps, zeros, ones, pw in deep_nodes(keys, counts):
            place = (keys[reps] >> PAIR) * 256 + path[reps]
            unique, where = np.unique(place, return_inverse=True)
            sums = [pa.array(np.bincount(where, x, len(unique))) for x in (zeros, ones, pw)]
            yield pa.RecordBatch.from_arrays([pa.array(unique), *sums], names=["place", "zeros", "ones", "product"])


def _pair_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        zeros, ones, product = (batch.column(k).to_numpy() for k in (1, 2, 3))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, pair_nodes(zeros, ones, product))], names=["place", "zeros", "ones", "stop", "one", "pw"])


def hash_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(keys.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(bucket, columns of its entries), entries in their given order."""
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    for b, part in zip(names.tolist(), np.split(order, first[1:])):
        yield b, *(c[part] for c in columns)


def pack(keys: np.ndarray) -> bytes:
    """Keys as the differences of neighbours, byte by byte over all of them: in order they take about half the space on disk."""
    if not len(keys):
        return b""
    steps = np.diff(keys.view(np.uint64), prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + steps.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack(data: bytes | None) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    width = data[0]
    steps = np.zeros(((len(data) - 1) // width, 8), np.uint8)
    steps[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1).T
    return np.cumsum(steps.view("<u8").reshape(-1), dtype=np.uint64).view(np.int64)


def _lists(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    """A list column's or packed keys' rows as numpy arrays (empty for null)."""
    column = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_list(column.type):
        return [unpack(x) for x in column.to_pylist()]
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _runs(batches: Iterator[pa.RecordBatch], key: str, lists: tuple[str, ...]) -> Iterator[tuple[int, list[dict]]]:
    """Rows (as dicts, lists as arrays) of consecutive equal ``key``."""
    current, held = None, []
    for batch in batches:
        plain = [n for n in batch.schema.names if n not in lists]
        columns = {n: batch.column(batch.schema.get_field_index(n)).to_pylist() for n in plain} | {n: _lists(batch, n) for n in lists}
        for i in range(batch.num_rows):
            row = {n: c[i] for n, c in columns.items()}
            if held and row[key] != current:
                yield current, held
                held = []
            current = row[key]
            held.append(row)
    if held:
        yield current, held


def _list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else [], kind))


def _one(names: str, *values) -> pa.RecordBatch:
    """A batch of one row; arrays become lists."""
    arrays = [_list_array([v], pa.float64() if v.dtype == np.float64 else pa.int64()) if isinstance(v, np.ndarray) else pa.array([v]) for v in values]
    return pa.RecordBatch.from_arrays(arrays, names=names.split())


def block_of(blocks: int) -> Column:
    """Block of a row, by id and text: rows of one repeated or null id are spread like any others, and both reads of a row agree."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of every row, staged; rows for which ``held_out`` is true are not learned from."""
    with limited_batches(docs.sparkSession, BATCH_BYTES):
        return staged(_scored(docs, held_out, id_col, text_col, block_bytes), "tree-scores")


def _scored(docs: DataFrame, held_out: Column, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    spark = docs.sparkSession
    n = partitions(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    if blocks > n:  # as many for each partition
        blocks = n * round(blocks / n)
    buckets = max(4, blocks // 2)
    numbered = lambda name: F.pmod(name, F.lit(n)).cast("int")  # noqa: E731  blocks and buckets go round the partitions
    rows = rows.withColumn("block", block_of(blocks))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def report(block: int, found: BlockTally) -> Iterator[pa.RecordBatch]:
            for kind, keys, counts in found.totals():
                for bucket, k, c in _by_bucket(hash_bucket(keys, buckets), keys, counts):
                    yield _one("kind bucket block keys counts", kind, bucket, block, pack(k), c)

        current, found = None, BlockTally()
        for batch in batches:
            for block, held, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), byte_column(batch, "text")):
                if block != current:
                    if current is not None:
                        yield from report(current, found)
                    current, found = block, BlockTally()
                found.add((text or b"").lower(), not held)
        if current is not None:
            yield from report(current, found)

    dealt = rows.select("doc_id", "block", "held_out", "text").repartitionById(n, numbered("block")).sortWithinPartitions("block")
    asked = staged(dealt.mapInArrow(drained(tally), TALLY), "tree-tally")

    def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _runs(batches, "bucket", ("keys", "counts")):
            unique, sums = add_up([r["keys"] for r in held], [r["counts"] for r in held])
            yield _one("block kind keys n lp", -1, "w", b"", np.array([sums.sum(), (sums > 0).sum()]), np.zeros(0))
            for r in held:
                yield _one("block kind keys n lp", r["block"], "w", pack(r["keys"]), sums[np.searchsorted(unique, r["keys"])], np.zeros(0))

    by_bucket = lambda df, *more: df.repartitionById(n, numbered("bucket")).sortWithinPartitions("bucket", *more)
    words_answer = staged(by_bucket(asked.where("kind = 'w'")).mapInArrow(drained(word_counts), ANSWER), "tree-words")
    sums = words_answer.where("block = -1").agg(F.sum(F.col("n")[0]), F.sum(F.col("n")[1])).first()
    train_tokens, vocabulary = sums[0] or 0, sums[1] or 0

    def window_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _runs(batches, "bucket", ("keys", "counts")):
            unique, total = add_up([r["keys"] for r in held], [r["counts"] for r in held])
            for i in range(0, len(unique), MODEL_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(unique[i : i + MODEL_ROWS]), pa.array(total[i : i + MODEL_ROWS])], names=["key", "n"])

    counted = staged(by_bucket(asked.where("kind = 'g'")).mapInArrow(window_counts, "key long, n long"), "tree-windows")
    pair = F.shiftright("key", PAIR).alias("pair")
    grouped = counted.select(pair, "key", "n").repartition(n, "pair").sortWithinPartitions("pair", "key")
    sums_of = lambda df, key, *columns: df.groupBy(key).agg(*[F.sum(c).alias(c) for c in columns])
    pair_rows = sums_of(grouped.mapInArrow(_pair_sums, "place long, zeros double, ones double, product double"), "place", "zeros", "ones", "product")
    nodes = staged(pair_rows.mapInArrow(_pair_table, "place long, zeros double, ones double, stop double, one double, pw double"), "tree-nodes")
    upper_place = (F.shiftright("place", 16) * 256 + F.col("place") % 256).alias("place")
    # one row per context byte and bit path, 65,280 at most
    upper_rows = sums_of(nodes.select(upper_place, "zeros", "ones", "pw"), "place", "zeros", "ones", "pw").collect()
    upper = spark.sparkContext.broadcast(UpperTree([(r["place"] >> 8, r["place"] & 255, r["zeros"], r["ones"], r["pw"]) for r in upper_rows]))

    def window_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}  # of the pairs at hand: stop weight and probability of a one by path
        for rows in _whole_groups(batches):
            keys, pairs = rows["key"].to_numpy(), rows["pair"].to_numpy()
            is_node = keys < 0
            stop, one = rows["stop"].to_numpy(), rows["one"].to_numpy()
            here = np.unique(pairs)
            tables = {p: t for p, t in tables.items() if p == here[0]}
            for p in np.unique(pairs[is_node]).tolist():
                at = np.flatnonzero(is_node & (pairs == p))
                tables[p] = np.zeros((2, 256))
                tables[p][:, keys[at] + 256] = stop[at], one[at]
            at = np.flatnonzero(~is_node)
            if not len(at):
                continue
            keys, counts, pairs = keys[at], rows["n"].to_numpy()[at], pairs[at]
            known, where = np.unique(pairs, return_inverse=True)
            both = np.stack([tables[p] for p in known.tolist()])
            lp = np.zeros(len(keys))
            for _, path, bit, p, *_ in deep_nodes(keys, counts):
                stop2, one2 = both[where, 0, path], both[where, 1, path]
                p = stop2 * np.where(bit == 1, one2, 1 - one2) + (1 - stop2) * p
                lp += np.log(upper.value.mixed(keys >> FIRST, path, bit, p))
            for bucket, k, x in _by_bucket(hash_bucket(keys, buckets), keys, lp):
                yield _one("bucket block keys lp", bucket, -1, pack(k), x)

    # a pair's node rows sort before its windows
    double = F.expr("0.0D")
    node_rows = nodes.select(F.shiftright("place", 8).alias("pair"), (F.col("place") % 256 - 256).alias("key"), F.expr("0L").alias("n"), "stop", "one")
    together = node_rows.unionByName(counted.select(pair, "key", "n", double.alias("stop"), double.alias("one"))).repartition(n, "pair").sortWithinPartitions("pair", "key")
    model = together.mapInArrow(drained(window_scores), "bucket long, block long, keys binary, lp array<double>")
    questions = asked.where("kind = 'g'").select("bucket", "block", "keys", F.expr("cast(array() as array<double>)").alias("lp"))

    def window_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _runs(batches, "bucket", ("keys", "lp")):
            known = [r for r in held if r["block"] < 0]
            keys, lp = np.concatenate([r["keys"] for r in known]), np.concatenate([r["lp"] for r in known])
            order = np.argsort(keys)
            keys, lp = keys[order], lp[order]
            for r in held:
                if r["block"] >= 0:
                    yield _one("block kind keys n lp", r["block"], "g", pack(r["keys"]), np.zeros(0, np.int64), lp[np.searchsorted(keys, r["keys"])])

    windows_answer = by_bucket(model.unionByName(questions), "block").mapInArrow(drained(window_answers), ANSWER)
    answers = words_answer.where("block >= 0").unionByName(windows_answer)
    blank = lambda kind: F.expr(f"cast(null as {kind})")
    lists = F.expr("cast(array() as array<long>)")
    # the texts follow their block's answers
    both = answers.select("block", "kind", "keys", "n", "lp", blank("long").alias("doc_id"), blank("boolean").alias("held_out"), blank("string").alias("text")).unionByName(
        rows.select("block", F.lit("x").alias("kind"), blank("binary").alias("keys"), lists.alias("n"), F.expr("cast(array() as array<double>)").alias("lp"), "doc_id", "held_out", "text"))
    placed = both.repartitionById(n, numbered("block")).sortWithinPartitions("block", "kind")
    scored = placed.mapInArrow(_scores, "doc_id long, held_out boolean, n_tokens long, n_known long, n_bytes long, log_counts double, score double")
    base = F.col("log_counts") - F.col("n_tokens") * math.log10(train_tokens + vocabulary + 1)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
        (-F.col("score") * (LN10 / math.log(2)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


class _Table:
    """Values by key: ordered by a hash, with the first entry of each of about as many slots; the next entries by steps, stragglers by binary search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashed = self._hash(keys)
        order = np.argsort(hashed)
        self.hashed, self.values = hashed[order], values[order]
        self.shift = np.uint64(64 - max(8, len(keys).bit_length()))
        slots = (self.hashed >> self.shift).astype(np.int64)
        self.first = np.zeros((1 << (64 - int(self.shift))) + 1, np.int32)
        np.cumsum(np.bincount(slots, minlength=len(self.first) - 1), out=self.first[1:])

    @staticmethod
    def _hash(keys: np.ndarray) -> np.ndarray:
        return keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        hashed = self._hash(keys)
        at = self.first[(hashed >> self.shift).astype(np.int64)]
        wrong = np.flatnonzero(self.hashed[at] != hashed)
        for _ in range(8):
            if not len(wrong):
                break
            at[wrong] += 1
            wrong = wrong[self.hashed[np.minimum(at[wrong], len(self.hashed) - 1)] != hashed[wrong]]
        at[wrong] = np.searchsorted(self.hashed, hashed[wrong])
        return self.values[at]


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Score the documents of each block from the answers sorted before them."""
    block, parts = None, {"w": [], "g": []}
    tables: tuple[_Table, _Table] | None = None
    for batch in batches:
        column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        blocks, kinds = column["block"].to_pylist(), column["kind"].to_pylist()
        keys, counts, lps = _lists(batch, "keys"), _lists(batch, "n"), _lists(batch, "lp")
        texts = byte_column(batch, "text")
        run: list[int] = []
        size = 0

        def flush() -> pa.RecordBatch:
            words, window = tables
            lower = [(texts[i] or b"").lower() for i in run]
            end = words(np.array([END_KEY]))[0]
            n_tokens, n_known = np.ones(len(run), np.int64), np.full(len(run), int(end > 0))
            log_counts, total = np.full(len(run), end), np.zeros(len(run))
            for keys, owner in word_keys(lower):
                logs = words(keys)
                n_tokens += np.bincount(owner, minlength=len(run))
                n_known += np.bincount(owner[logs > 0], minlength=len(run))
                log_counts += np.bincount(owner, logs, len(run))
            for codes, owner in windows(lower):
                total += np.bincount(owner, window(codes), len(run))
            at = pa.array(run)
            return pa.RecordBatch.from_arrays(
                [column["doc_id"].take(at), column["held_out"].take(at), pa.array(n_tokens), pa.array(n_known), pa.array([len(x) for x in lower], pa.int64()),
                 pa.array(log_counts), pa.array(total / LN10)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "n_bytes", "log_counts", "score"],
            )

        for i in range(batch.num_rows):
            if blocks[i] != block:
                if run:
                    yield flush()
                    run, size = [], 0
                block, parts, tables = blocks[i], {"w": [], "g": []}, None
            if kinds[i] != "x":
                parts[kinds[i]].append((keys[i].copy(), (counts[i] if kinds[i] == "w" else lps[i]).copy()))
                continue
            if tables is None:
                (words, n), (window, lp) = (map(np.concatenate, zip(*parts.pop(kind))) for kind in ("w", "g"))
                tables = _Table(words, np.log10(n + 1)), _Table(window, lp)
                del words, n, window, lp
            run.append(i)
            size += len(texts[i] or b"")
            if size >= SLICE:
                yield flush()
                run, size = [], 0
        if run:
            yield flush()
