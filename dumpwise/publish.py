"""Atomic publication of dated reports.

A report lives in ``<root>/date=<date>``; ``<root>/_manifest/date=<date>`` says that
it is published: one row per element (files, rows, bytes), a few kilobytes of
Parquet per date. A job writes into ``<root>/_staging/<date>.<run>`` and then

1. ``write``     the report's files (any clean-up of names included),
2. ``describe``  counts them into the staged manifest entry,
3. ``withdraw``  (overwriting only) moves the old entry, then the old files, into the staging folder,
4. ``move``      renames the files to ``date=<date>``,
5. ``announce``  renames the entry to ``_manifest/date=<date>``,
6. ``clean``     removes the staging folder.

Readers honour the manifest, so a job killed between any two steps leaves
nothing that a lookup takes for a report, and the next run of the job starts
afresh, or only announces what the killed one had already moved. Folders that
start with an underscore are hidden from Spark's scans. A rename of a folder
must be atomic, or at least end before it is reported, as on HDFS or a local
file system; on an object store the entry, written last, is what decides.

A root without a manifest is an old layout: its readers look at the files
alone, and the first publication adopts the dates found there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST, STAGING = "_manifest", "_staging"
ENTRY = "report string, element string, files long, rows long, bytes long, run string"
MODES = ("errorifexists", "error", "overwrite", "ignore", "resume")


class Files:
    """The file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(self.root).getFileSystem(self.conf)

    def path(self, name: str) -> Any:
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def children(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(name))) if self.exists(name) else []

    def make(self, name: str) -> None:
        self.fs.mkdirs(self.path(name))

    def move(self, name: str, to: str) -> None:
        """Rename; a target that exists is an error (some file systems would move into it)."""
        if self.exists(to) or not self.fs.rename(self.path(name), self.path(to)):
            raise OSError(f"{name} could not be renamed to {to}")

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def reached(step: str) -> None:
    """Called between the steps of a publication (tests stop jobs here)."""


def _entry(spark: SparkSession, root: str, data: str, run: str, by_element: bool, count_rows: bool) -> DataFrame:
    """The manifest rows of the files under ``data``: listed and counted by Spark, one row per element."""
    listing = lambda fmt: spark.read.format(fmt).option("recursiveFileLookup", "true").load(data)
    file, size = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    files = listing("binaryFile").select(file, size)
    if count_rows:
        rows = listing("text").select(file).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
        files = files.join(rows, "file", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    else:
        files = files.withColumn("rows", F.lit(None).cast("long"))
    name = F.element_at(F.split("file", "/"), -2)
    for _ in range(2):  # as a URI, then as Spark escapes partition values
        name = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    element = F.regexp_replace(name, "^rse=", "") if by_element else F.lit(None).cast("string")
    found = files.select(element.alias("element"), "rows", "bytes").groupBy("element")
    found = found.agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    # an empty report has no element, but it is one: an entry must not be empty
    empty = spark.range(1).select(F.lit(None).cast("string").alias("element"), *[F.lit(0).cast("long").alias(c) for c in ("files", "rows", "bytes")])
    whole = found.unionByName(empty).groupBy("element").agg(*[F.sum(c).alias(c) for c in ("files", "rows", "bytes")])
    report = F.lit(root.rstrip("/").rsplit("/", 1)[-1])
    return whole.select(report.alias("report"), "element", "files", "rows", "bytes", F.lit(run).alias("run"))


def _adopt(spark: SparkSession, files: Files, by_element: bool) -> None:
    """Start a manifest: dates that an older layout holds become its first entries (their rows are not counted)."""
    if files.exists(f"{files.root}/{MANIFEST}"):
        return
    old = [d for d in files.children(files.root) if d.startswith("date=")]
    made = f"{files.root}/{STAGING}/manifest.{uuid.uuid4().hex}"
    files.make(made)
    for day in old:
        entry = _entry(spark, files.root, f"{files.root}/{day}", "adopted", by_element, False)
        entry.coalesce(1).write.parquet(f"{made}/{day}")
    files.move(made, f"{files.root}/{MANIFEST}")


def recover(spark: SparkSession, root: str, date: str) -> bool:
    """Announce a report whose files a killed job had moved into place already; True if there was one."""
    files = Files(spark, root)
    entry = f"{files.root}/{MANIFEST}/date={date}"
    if files.exists(entry) or not files.exists(f"{files.root}/date={date}"):
        return False
    for run in files.children(f"{files.root}/{STAGING}"):
        stage = f"{files.root}/{STAGING}/{run}"
        if run.startswith(f"{date}.") and files.exists(f"{stage}/entry/_SUCCESS") and not files.exists(f"{stage}/data"):
            files.move(f"{stage}/entry", entry)
            files.remove(stage)
            return True
    return False


def publish(spark: SparkSession, root: str, date: str, write: Callable[[str], None], *, mode: str = "errorifexists",
            by_element: bool = False, count_rows: bool = True) -> bool:
    """Publish what ``write(path)`` writes as the report of ``date``; False if there was nothing left to do.

    ``mode``: ``errorifexists``; ``overwrite`` replaces the date as a whole;
    ``ignore`` and ``resume`` leave a published date as it is, for jobs of several reports that
    are run again. ``by_element``: the report has a folder per element (``rse=X`` or ``X``).
    ``count_rows`` reads the written files once (lines are rows) for the manifest.
    """
    if mode not in MODES:
        raise ValueError(f"a dated report is written whole: mode must be one of {MODES}, not {mode!r}")
    files = Files(spark, root)
    final, entry = f"{files.root}/date={date}", f"{files.root}/{MANIFEST}/date={date}"
    _adopt(spark, files, by_element)
    recovered = recover(spark, root, date)
    there = files.exists(entry) or files.exists(final)
    if mode != "overwrite" and (recovered or (there and mode in ("ignore", "resume"))):
        return False
    if there and mode != "overwrite":
        raise FileExistsError(f"the report {final} exists")
    run = uuid.uuid4().hex
    stage = f"{files.root}/{STAGING}/{date}.{run}"
    reached("write")
    write(f"{stage}/data")
    reached("describe")
    _entry(spark, files.root, f"{stage}/data", run, by_element, count_rows).coalesce(1).write.parquet(f"{stage}/entry")
    reached("withdraw")
    if files.exists(entry):
        files.move(entry, f"{stage}/old_entry")
        reached("withdraw files")
    if files.exists(final):
        files.move(final, f"{stage}/old_data")
    reached("move")
    files.move(f"{stage}/data", final)
    reached("announce")
    files.move(f"{stage}/entry", entry)
    reached("clean")
    files.remove(stage)
    return True


def has_manifest(spark: SparkSession, root: str) -> bool:
    return Files(spark, root).exists(f"{root.rstrip('/')}/{MANIFEST}")


def published_dates(spark: SparkSession, root: str) -> list[str]:
    """All published dates, ascending (one folder listing, an entry per date)."""
    return [d.removeprefix("date=") for d in Files(spark, root).children(f"{root.rstrip('/')}/{MANIFEST}") if d.startswith("date=")]


def read_manifest(spark: SparkSession, root: str, dates: list[str] | None = None) -> DataFrame:
    """``report, element, files, rows, bytes, run, date`` of the published reports of ``dates`` (default: all)."""
    base = f"{root.rstrip('/')}/{MANIFEST}"
    known = set(published_dates(spark, root))
    found = sorted(known if dates is None else known.intersection(dates))
    if not found:
        return spark.createDataFrame([], f"{ENTRY}, date string")
    entries = spark.read.schema(f"{ENTRY}, date string").option("basePath", base).parquet(*[f"{base}/date={d}" for d in found])
    return entries.withColumn("date", F.col("date").cast("string"))
