"""Small helpers the operators share: staged tables, hashing and word splitting."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from dumpwise.session import checkpoint_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation, and
    every reader sees the same rows. The folder is new on every call.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/dumpwise-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def limited_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """For the steps run meanwhile, Arrow batches of about ``size`` bytes (one row at least); the setting is restored.

    A batch of 10,000 rows of long texts or lists is held several times over, by the executor and by its Python worker.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count (set by whoever sizes the cluster)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors once, so that Python workers can import it wherever they start."""
    context = spark.sparkContext
    if getattr(context, "_dumpwise_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="dumpwise-ship-")) / "dumpwise.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._dumpwise_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column of an Arrow batch as UTF-8 bytes (no decoding)."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


def drained(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for mapInArrow that hands its output over only after all input of the partition is read.

    A worker that writes much while much input waits in its socket can stall for
    good when both directions fill up. For steps whose output is of the order of
    a partition: it is held in memory until then.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from list(work(batches))

    return run


def table_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows whose first ``keys`` columns are equal; the rows come sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        bounds = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


# Separators become a space and A-Z lower case, so that split() yields the words
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lower-cased text; bytes from 0x80 on stay.
WORD_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """Letters-and-digits words of a text, A-Z lower-cased (empty for null)."""
    return text.translate(WORD_TABLE).split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply) on a uint64 array."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sliced(rows: dict[str, list], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Column lists as Arrow batches of at most ``size`` rows."""
    n = len(next(iter(rows.values()))) if rows else 0
    for i in range(0, n, size):
        yield pa.RecordBatch.from_arrays([pa.array(rows[f.name][i : i + size], f.type) for f in schema], schema=schema)
