"""Session helpers.

Reports need the UTC session time zone (every epoch conversion depends on it)
and AQE. Cluster settings (executors, memory, the checkpoint directory) belong
to whoever submits the job: we read them. The one exception is the shuffle
partition count, sized per job and restored (``sized_shuffles``).
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "dumpwise") -> SparkSession:
    """A local session for tests and the benchmark (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("DUMPWISE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings every report relies on to an existing session.

    UTC for every epoch conversion; AQE with skew handling, which splits large
    partitions of inner joins (and the left side of left joins) when no
    aggregate or window reuses the join's partitioning. Where one does, the
    operator's docstring says what bounds a key's rows. Duplicate JSON keys in
    site documents: the last value counts, as JSON readers commonly do.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A local master may go without: then a scratch folder of this machine is
    picked. On a cluster every executor would write to its own disk, so a
    missing setting is an error there.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master!r} share")
    folder = tempfile.mkdtemp(prefix="dumpwise-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir() or folder


# Target bytes of (compressed) input per shuffle partition before AQE coalescing.
BYTES_PER_SHUFFLE_PARTITION = 128 * 1024 * 1024
SPARK_DEFAULT_SHUFFLE_PARTITIONS = 200


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (file-system metadata only, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


@contextmanager
def sized_shuffles(spark: SparkSession, paths: list[str], partition_bytes: int = BYTES_PER_SHUFFLE_PARTITION) -> Iterator[int]:
    """For one job, size ``spark.sql.shuffle.partitions`` from its input; restored afterwards.

    One partition per ``partition_bytes`` of input, at least Spark's default of
    200, without an upper bound: partitions keep their size however large the
    dump. AQE merges those that turn out small. A session whose setting is not
    the default was tuned by its owner and is left alone.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    n = int(before)
    if n == SPARK_DEFAULT_SHUFFLE_PARTITIONS:
        n = max(n, -(-input_bytes(spark, paths) // partition_bytes))
        spark.conf.set(key, str(n))
    try:
        yield n
    finally:
        spark.conf.set(key, before)
