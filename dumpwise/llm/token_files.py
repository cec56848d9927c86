"""Token-id files with Simple-8b words (operator 13).

Texts become token ids (by the tokenizers library) and one end id each, and are
written in ascending order of their document ids. A file is a Parquet table of
frames; a frame holds whole documents, about ``FRAME_IDS`` ids of them, as one
binary value:

* header: ``S8B1`` and a format word, then as int64 the numbers of documents, ids, words, blocks and escapes;
* per document: its id (int64), whether that is null (a byte), and its number of ids (int64);
* per block of ``BLOCK_WORDS`` words: the number of ids and of escapes before it (int64 each);
* the words (uint64) and the escapes (uint32). All numbers are little-endian.

A word is Simple-8b: the upper four bits select how many ids of which width the
other 60 bits hold. The highest code of a width is the escape: the id itself is
the next of the escape list, so a wide id does not widen its neighbours. The
block offsets let any range of ids be decoded alone and vectorised
(``decode(..., first, last)``); a whole frame is one call.

The job: texts are dealt by ranges of (document id, text), every task encodes
its range and writes one file. Where a range starts among all ids is added up
from the files' own counts, one row per file.

Words between white space are encoded once per worker and kept in a bounded
memo; ``spaces_cut`` proves by the library itself that a tokenizer never joins
or keeps white space (else whole texts are encoded).

Cases: a null text is empty (the end id alone); a null document id comes first;
rows of one id are ordered by a hash of their text; equal rows are written as
often as they occur; an empty table gives no frames; extra columns are ignored.
A text's packed ids must fit one value (2 GB), which is more ids than a string of 2 GB gives in practice.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dumpwise.llm.common import byte_column, partitions
from dumpwise.llm.token_counts import byte_letters
from dumpwise.session import checkpoint_dir

# Ids per word and bits per id of each selector.
SLOTS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
COUNTS = np.array([c for c, _ in SLOTS] + [0, 0])
MAGIC = b"S8B1"
FRAME_IDS = 16_384  # a frame is closed by the document that reaches this many ids
BLOCK_WORDS = 256
MEMO_WORDS = 2_000_000  # words a worker remembers (about 200 bytes each) before it starts afresh
BYTES_PER_TASK = 64 << 20  # of text
FEW_FILES = 1 << 20
PLAIN = "\u0250"  # characters before this one: Latin letters that compose and change case by themselves


# ---------------------------------------------------------------- Simple-8b


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (uint64), where each begins among the ids, and the places of the escaped ids, for uint32 ids.

    At every place the selector with the fewest bits per id is taken, an escape
    counting 32 bits. Selectors that fit under half of the ids are left out of
    the search, which costs space on odd data only.
    """
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    best, pick = np.full(n, np.inf, np.float32), np.zeros(n, np.int8)
    before = np.zeros(n + 61, np.int32)
    for s, (count, width) in enumerate(SLOTS):
        wide = ids >= (1 << min(width, 33)) - 1
        misfits = np.count_nonzero(wide)
        if misfits * 2 > n and width < 30:
            continue
        np.cumsum(wide, dtype=np.int32, out=before[1 : n + 1])
        before[n + 1 :] = misfits
        bits = (before[count : count + n] - before[:n]).astype(np.float32) * np.float32(32) + np.float32(64)
        bits *= np.float32(1 / count)
        short = min(count - 1, n)  # the last places have fewer ids than slots
        bits[n - short :] *= np.float32(count) / np.arange(short, 0, -1, dtype=np.float32)
        better = bits < best
        np.copyto(best, bits, where=better)
        np.copyto(pick, s, where=better, casting="unsafe")
        if not misfits:
            break  # wider slots hold fewer ids
    steps = COUNTS.astype(np.uint8)[pick].tobytes()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += steps[i]
    start = np.array(starts)
    selected = pick[start]
    words = selected.astype(np.uint64) << np.uint64(60)
    padded = np.zeros(n + 60, np.uint64)
    padded[:n] = ids
    escaped = np.zeros(n + 60, bool)
    for s in np.unique(selected):
        count, width = SLOTS[s]
        which = np.nonzero(selected == s)[0]
        code = np.uint64((1 << width) - 1)
        packed, at = words[which], start[which]
        for k in range(count):
            values = padded[at + k]
            over = np.nonzero(values >= code)[0]
            if len(over):
                escaped[at[over] + k] = True
                values[over] = code
            values <<= np.uint64(k * width)
            packed |= values
        words[which] = packed
    return words, start, np.nonzero(escaped)[0]


def decode(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` ids (uint32) of consecutive words; ``escapes`` begins with their first escape."""
    selected = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selected]
    start = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    escaped = np.zeros(len(out), bool)
    for s in np.unique(selected):
        count, width = SLOTS[s]
        which = np.nonzero(selected == s)[0]
        mask = np.uint64((1 << width) - 1)
        values = (words[which, None] >> (np.arange(count) * width).astype(np.uint64)) & mask
        places = start[which, None] + np.arange(count)
        out[places] = values
        escaped[places] = values == mask
    escaped[n:] = False
    out[escaped] = escapes[: np.count_nonzero(escaped)]
    return out[:n].astype(np.uint32)


# ------------------------------------------------------------------- frames


def frame(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """One frame of documents; ``ids`` are little-endian uint32."""
    joined = np.frombuffer(b"".join(ids), "<u4")
    words, starts, escaped = encode(joined)
    before = starts[::BLOCK_WORDS]
    table = np.stack((before, np.searchsorted(escaped, before)), axis=1)
    head = np.array([len(doc_ids), len(joined), len(words), len(table), len(escaped)], "<i8")
    return b"".join([
        MAGIC, (1).to_bytes(4, "little"), head.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is None for d in doc_ids),
        np.array([len(x) // 4 for x in ids], "<i8").tobytes(), table.astype("<i8").tobytes(), words.astype("<u8").tobytes(), joined[escaped].tobytes(),
    ])


class Frame:
    """A frame read back; numbers are views of its bytes."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC or data[4:8] != (1).to_bytes(4, "little"):
            raise ValueError("not a frame of token ids")
        self.n_docs, self.n_ids, n_words, n_blocks, n_escapes = np.frombuffer(data, "<i8", 5, 8).tolist()
        at = 48

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        ids, null, self.sizes = take("<i8", self.n_docs), take("u1", self.n_docs), take("<i8", self.n_docs)
        self.doc_ids = [None if z else d for d, z in zip(ids.tolist(), null.tolist())]
        self.blocks, self.words, self.escapes = take("<i8", 2 * n_blocks).reshape(-1, 2), take("<u8", n_words), take("<u4", n_escapes)
        if at != len(data):
            raise ValueError("a frame of token ids has the wrong length")

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids ``first`` to ``last`` (exclusive): only the blocks that hold them are decoded."""
        last = self.n_ids if last is None else last
        if first >= last:
            return np.empty(0, np.uint32)
        a, b = np.searchsorted(self.blocks[:, 0], [first, last - 1], side="right") - 1
        began, escapes = self.blocks[a]
        words = self.words[a * BLOCK_WORDS : (b + 1) * BLOCK_WORDS]
        return decode(words, self.escapes[escapes:], int(last - began))[first - began :]

    def document(self, i: int) -> np.ndarray:
        end = int(self.sizes[: i + 1].sum())
        return self.ids(end - int(self.sizes[i]), end)


# --------------------------------------------------------------- token ids


def spaces_cut(tokenizer: Tokenizer) -> bool:
    """True where words between ASCII white space can be encoded apart, in any case of A-Z.

    The normaliser must be made of steps that never look across white space (NFC,
    white space to a space, lower-casing) and the first split must take white
    space out; then a probe of every white-space byte checks it by the library.
    """
    spec = json.loads(tokenizer.to_str())
    steps = lambda x, inner: [] if not x else x[inner] if x["type"] == "Sequence" else [x]
    normal, split = steps(spec["normalizer"], "normalizers"), steps(spec["pre_tokenizer"], "pretokenizers")
    whole = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    if any(x["type"] not in ("NFC", "Lowercase") and x != whole for x in normal) or {"type": "Lowercase"} not in normal:
        return False
    if not split or split[0].get("type") != "Split" or split[0].get("behavior") != "Removed" or not split[0].get("invert"):
        return False
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or set(t["content"]) & set(" \t\n\v\f\r") for t in spec["added_tokens"]):
        return False
    ids = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    words = ["a", "B.", "'", "s", "1", "!?", "́", "é"]
    return all(ids(x + gap + y) == ids(x) + ids(y) for x in words for y in words for gap in [*" \t\n\v\f\r", " \r\n\t"])


class Memo(dict):
    """Ids by word; what is not there is worked out and kept, up to ``MEMO_WORDS``."""

    def __init__(self, work: Callable[[bytes], bytes]):
        super().__init__()
        self.work = work

    def __missing__(self, word: bytes) -> bytes:
        ids = self.work(word)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = ids
        return ids


class WordEncoder:
    """Token ids of texts as little-endian uint32 bytes, in one Python worker."""

    # A run of these at a word's end, behind a letter or digit, is a token run of its own.
    TAIL = ".,;:!?"

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.apart = spaces_cut(self.tokenizer)
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.byte_letters = self.tokenizer.model, byte_letters()
        self.packed = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.memo = Memo(self.word)
        self.marks: dict[str, bytes] = {}

    def ids(self, word: str) -> bytes:
        """One word's ids; a lower-case Latin word passes normaliser and splits unchanged and goes to the model at once."""
        if word.isalpha() and max(word) < PLAIN and word.lower() == word:
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.byte_letters)
            return b"".join([self.packed[t.id] for t in self.model.tokenize(letters)])
        return self.library(word)

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: bytes) -> bytes:
        """The ids of one word; a word and its closing marks are looked up apart."""
        text = word.decode()
        core = text.rstrip(self.TAIL)
        if core == text or not core or core[-1] >= PLAIN or not core[-1].isalnum():
            return self.ids(text)
        tail = text[len(core) :]
        if tail not in self.marks and len(self.marks) < 4096:
            self.marks[tail] = self.library(tail)
        return self.memo[core.encode()] + (self.marks.get(tail) or self.library(tail))

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        out = []
        for text in texts:
            if not text:
                out.append(b"")
            elif self.apart:
                # special strings are cut out of the text as it stands, so their case must stay
                low = text.lower()
                words = (text if any(map(low.__contains__, self.special)) else low).split()
                out.append(b"".join(map(self.memo.__getitem__, words)))
            else:
                out.append(self.library(text.decode()))
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder; it outlives a task, so later tasks find the words learnt before."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all texts, each followed by ``end_id``, under ``path`` in ascending order of document ids.

    ``tokenizer_path`` must be readable on every executor; ``path`` is any folder Spark writes to.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.cast("binary").alias("text"), F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("salt"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # measured, so that a task's output stays bounded at any scale
    n = max(partitions(spark), size // BYTES_PER_TASK)
    order = ["doc_id", "tie", "salt"]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)
        shard = TaskContext.get().partitionId()
        number = first = held = 0
        docs_, ids = [], []

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int64()), "frame": pa.array([number], pa.int64()), "first": pa.array([first], pa.int64()),
                "n_ids": pa.array([held], pa.int64()), "n_docs": pa.array([len(docs_)], pa.int64()), "data": pa.array([frame(docs_, ids)], pa.binary()),
            })

        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                piece = batch.slice(i, 64)
                for doc_id, encoded in zip(piece.column(0).to_pylist(), words.encode(byte_column(piece, "text"))):
                    docs_.append(doc_id)
                    ids.append(encoded + end)
                    held += len(encoded) // 4 + 1
                    if held >= FRAME_IDS:
                        yield closed()
                        number, first, held = number + 1, first + held, 0
                        docs_, ids = [], []
        if docs_:
            yield closed()

    dealt.mapInArrow(pack, "shard long, frame long, first long, n_ids long, n_docs long, data binary").write.parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``)."""
    frames = spark.read.parquet(path)
    shards = frames.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row per file
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select("shard", F.coalesce(before, F.lit(0)).alias("before"))
    if frames.select("shard").distinct().count() <= FEW_FILES:
        shards = F.broadcast(shards)  # 16 bytes a file: the frames need not move
    placed = frames.join(shards, "shard").select((F.col("before") + F.col("first")).alias("start"), "data")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                read = Frame(batch.column(1)[i].as_py())
                ids = read.ids().astype("<u4")
                ends = np.cumsum(read.sizes)
                starts = ends - read.sizes
                data = memoryview(ids).cast("B")
                columns = {
                    "doc_id": pa.array(read.doc_ids, pa.int64()), "start": pa.array(starts + batch.column(0)[i].as_py(), pa.int64()), "n_tokens": pa.array(read.sizes, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([ids[a:b] for a, b in zip(starts, ends)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    return placed.mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write ``docs`` as token files into a new folder beside the checkpoints and read them back."""
    spark = docs.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/dumpwise-llm/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, path, tokenizer_path, end_id)
    return read_token_files(spark, path)
