"""Report sinks: tab-separated text per storage element, single files, ordered files, documents.

The layout contract of the reports:

* per-element reports: one directory per element under the report directory
  (``rse=X`` by default, so Spark prunes it on read; ``strip_partition_prefix``
  renames to bare ``X`` for readers that expect it), tab-separated, no header,
  the element repeated as the first data column (``_rse``) since partition
  columns leave the rows;
* incident reports: one file, ordered, joined from ordered parts; the full consistency
  listing: ordered parts (one file on request);
* accounting: many files, globally ordered by (scope, name);
* times as text in the report's format (``TS_SECONDS`` or ``TS_MILLIS_UTC``).

Save mode defaults to ``errorifexists``: a dated report is written once. Dated reports are
written through ``publish.publish``, which makes them visible in one step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dumpwise.publish import Files, publish

# Timestamp text formats of the reports.
TS_SECONDS = "yyyy-MM-dd HH:mm:ss"
TS_MILLIS_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
SEPARATOR = "\t"


def render(df: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """Timestamp columns as text in ``timestamp_format``, the way the text sink writes them."""
    if timestamp_format is None:
        return df
    return df.select([
        F.date_format(F.col(f.name), timestamp_format).alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def _text_writer(df: DataFrame, mode: str, compression: str | None, timestamp_format: str | None,
                 options: Mapping[str, str] | None):
    w = df.write.mode(mode).option("sep", SEPARATOR).option("header", "false")
    if compression:
        w = w.option("compression", compression)
    if timestamp_format:
        w = w.option("timestampFormat", timestamp_format)
    if options:
        w = w.options(**options)
    return w


def write_per_rse(df: DataFrame, path: str, sort_keys: Sequence[str] = ("scope", "name"), *,
                  distribution: str = "rebalance", one_file_per_rse: bool = False, partitions: int | None = None,
                  mode: str = "errorifexists", compression: str | None = None, timestamp_format: str | None = None,
                  options: Mapping[str, str] | None = None) -> None:
    """Write a per-element report: a directory per ``rse``, rows sorted by ``sort_keys`` in each file.

    ``distribution``:

    * ``rebalance`` (default): hash on ``rse`` through the REBALANCE hint; AQE
      splits an element holding a large share of the rows into several tasks
      (files) of the advisory size and merges small elements; no sampling pass.
    * ``range``: range partitioning on (rse, *sort_keys): files of an element
      are also in key order among each other (file names follow the keys), at
      the price of a sampling pass over the input.
    * ``hash``: one task per element (``one_file_per_rse=True`` means this), for
      readers that only take a directory's first file; a huge element is then one task.
    """
    if one_file_per_rse:
        distribution = "hash"
    out = df.withColumn("_rse", F.col("rse"))
    out = out.select("rse", "_rse", *[c for c in df.columns if c != "rse"])
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if distribution == "hash":
        out = out.repartition(n, "rse")
    elif distribution == "range":
        out = out.repartitionByRange(n, "rse", *sort_keys)
    elif distribution == "rebalance":
        out = out.hint("rebalance", "rse")
    else:
        raise ValueError(f"unknown distribution {distribution!r}")
    out = out.sortWithinPartitions("rse", *sort_keys)
    _text_writer(out, mode, compression, timestamp_format, options).partitionBy("rse").csv(path)


# Codecs whose streams may follow each other in one file.
JOINABLE = {None: "", "none": "", "bzip2": ".bz2", "gzip": ".gz"}
COPY_BUFFER = 4 << 20


def join_parts(spark: SparkSession, parts: str, target: str) -> None:
    """Make the part files of ``parts``, in their order, the one file ``target``; ``parts`` goes.

    The file system joins them itself where it can (a metadata operation on HDFS);
    elsewhere their bytes are streamed one after the other through a buffer of
    ``COPY_BUFFER`` bytes, without decompressing or parsing them.
    """
    files = Files(spark, parts)
    names = sorted((n for n in files.children(parts) if n.startswith("part-")), key=lambda n: int(n.split("-")[1].split(".")[0]))
    paths = [files.path(f"{parts}/{n}") for n in names]
    if len(paths) > 1:
        rest = spark.sparkContext._gateway.new_array(files.jvm.org.apache.hadoop.fs.Path, len(paths) - 1)
        for i, p in enumerate(paths[1:]):
            rest[i] = p
        try:
            files.fs.concat(paths[0], rest)
        except Exception:  # not offered, or not for these files
            joined = files.path(f"{parts}/joined")
            out = files.fs.create(joined, True)
            try:
                for p in paths:
                    source = files.fs.open(p)
                    try:
                        files.jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, COPY_BUFFER, False)
                    finally:
                        source.close()
            finally:
                out.close()
            paths[0] = joined
    if paths:
        files.move(paths[0].toString(), target)
    else:
        files.fs.create(files.path(target), True).close()
    files.remove(parts)


def write_single_file(df: DataFrame, path: str, order_by: Sequence[str] = (), *, mode: str = "errorifexists",
                      compression: str | None = None, timestamp_format: str | None = None,
                      options: Mapping[str, str] | None = None) -> None:
    """One text file, rows in ``order_by`` order (incident reports, the full consistency listing).

    The rows are sorted and written in globally ordered parts by as many tasks as
    the shuffle has, then the parts are joined to one file (``join_parts``), so no task
    holds, sorts or compresses the whole report. Codecs: bzip2, gzip or none.
    """
    spark = df.sparkSession
    if compression not in JOINABLE:
        raise ValueError(f"a single file is joined from parts: compression must be one of {list(JOINABLE)}")
    files = Files(spark, path)
    if files.exists(path):
        if mode == "ignore":
            return
        if mode != "overwrite":
            raise FileExistsError(f"{path} exists")
        files.remove(path)
    parts = f"{path.rstrip('/')}/_parts"
    _text_writer(df.orderBy(*order_by) if order_by else df, "errorifexists", compression, timestamp_format, options).csv(parts)
    join_parts(spark, parts, f"{path.rstrip('/')}/part-00000.csv{JOINABLE[compression]}")
    files.fs.create(files.path(f"{path.rstrip('/')}/_SUCCESS"), True).close()


def write_ordered(df: DataFrame, path: str, order_by: Sequence[str], *, mode: str = "errorifexists",
                  compression: str | None = None, timestamp_format: str | None = None,
                  options: Mapping[str, str] | None = None) -> None:
    """Many files, globally ordered: file ``part-i`` precedes ``part-i+1`` in ``order_by`` order."""
    _text_writer(df.orderBy(*order_by), mode, compression, timestamp_format, options).csv(path)


# Writer options that make a store replace a document of the same id, by a word of the connector's format name.
STORE_OPTIONS = {
    "elasticsearch": {"es.mapping.id": "id", "es.write.operation": "index"},
    "opensearch": {"opensearch.mapping.id": "id", "opensearch.write.operation": "index"},
}
FILE_FORMATS = ("json", "bulk", "parquet", "orc", "csv")
DOCUMENTS_PER_BULK_FILE = 20_000  # a file is one bulk request


def bulk_lines(docs: DataFrame, index: str, id_col: str = "id") -> DataFrame:
    """Documents as a search store's bulk lines: an ``index`` action with the document's id, then the document."""
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), F.col(id_col).alias("_id")).alias("index")))
    return docs.select(F.concat(action, F.lit("\n"), F.to_json(F.struct("*"))).alias("value"))


def write_documents(df: DataFrame, target: str, fmt: str = "json", *, date: str | None = None, mode: str = "overwrite",
                    options: Mapping[str, str] | None = None) -> None:
    """Deliver documents (R9) so that delivering the same date again leaves each id once.

    Files (``json``, ``bulk`` and Spark's other file formats): the documents of ``date`` are
    published as ``<target>/date=<date>`` and replace an earlier delivery of that
    date as a whole (``publish``); a delivery killed half-way leaves the earlier one or
    none, never a part. ``bulk`` writes request files in a search store's bulk
    format, whose actions replace by id as well.

    Any other format is a store's connector (its jar on the cluster, its nodes in
    ``options``): documents are appended with their ``id`` as the store's id, so a
    rerun replaces them; ``options`` may override ``STORE_OPTIONS``.
    """
    if fmt in FILE_FORMATS:
        if date is None:
            raise ValueError("files are replaced by date: pass the documents' date")

        def write(path: str) -> None:
            rows = bulk_lines(df, target.rstrip("/").rsplit("/", 1)[-1]) if fmt == "bulk" else df
            w = rows.write.options(**(options or {}))
            if fmt == "bulk":
                w = w.option("maxRecordsPerFile", DOCUMENTS_PER_BULK_FILE)
            w.format("text" if fmt == "bulk" else fmt).save(path)

        publish(df.sparkSession, target, date, write, mode=mode, count_rows=fmt in ("json", "csv"))
        return
    known = {k: v for word, defaults in STORE_OPTIONS.items() if word in fmt for k, v in defaults.items()}
    df.write.format(fmt).mode("append").options(**(known | dict(options or {}))).save(target)


def strip_partition_prefix(spark: SparkSession, path: str, column: str = "rse") -> list[str]:
    """Rename ``<path>/<column>=X`` directories to ``<path>/X`` (metadata only, one call per element).

    Escaped names stay escaped. Returns the new directory names.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    renamed = []
    for status in fs.listStatus(root):
        src = status.getPath()
        name = src.getName()
        if status.isDirectory() and name.startswith(column + "="):
            dst = jvm.org.apache.hadoop.fs.Path(root, name[len(column) + 1:])
            if fs.exists(dst) or not fs.rename(src, dst):
                raise OSError(f"{src} could not be renamed to {dst}")
            renamed.append(dst.getName())
    return renamed
