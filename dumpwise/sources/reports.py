"""Reading written reports back: the accounting text file and dated report directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dumpwise.operators import consistency, datasets, incidents, replicas
from dumpwise.operators.accounting import accounting_columns
from dumpwise.publish import has_manifest, published_dates, read_manifest

_LONGS = {"bytes", "count", "copies", "updated_at", "created_at", "accessed_at"}


def _text_layout(columns, longs=frozenset(), whole: bool = False) -> T.StructType:
    """Column layout of a written report; a per-element one has ``_rse`` first and no ``rse``."""
    names = list(columns) if whole else ["_rse"] + [c for c in columns if c != "rse"]
    return T.StructType([T.StructField(n, T.LongType() if n in longs else T.StringType(), True) for n in names])


# Layouts of the text reports (times of R3/R4 are text in the report's format; R1 keeps raw
# epoch milliseconds, R6 epoch seconds). The last three are whole reports, by date only.
REPORT_LAYOUTS: dict[str, T.StructType] = {
    "consistency_datasets": _text_layout(consistency.COLUMNS, _LONGS),
    "datasets_per_rse": _text_layout(datasets.COLUMNS, {"bytes"}),
    "replicas_per_rse": _text_layout(replicas.COLUMNS, {"bytes", "copies"}),
    "lost_files": _text_layout(incidents.LOST_COLUMNS, {"updated_at"}, whole=True),
    "suspicious_files": _text_layout(incidents.SUSPICIOUS_COLUMNS, whole=True),
    "consistency_datasets_full": _text_layout(consistency.FULL_COLUMNS, whole=True),
}


def accounting_schema() -> T.StructType:
    """The 54-column schema of the accounting report (string, long and double columns)."""
    strings = {"scope", "name", "datatype", "prod_step", "run_number", "project", "stream_name", "version",
               "campaign"}
    fields = []
    for c in accounting_columns():
        if c in strings:
            t = T.StringType()
        elif "repl_factor" in c:
            t = T.DoubleType()
        else:
            t = T.LongType()
        fields.append(T.StructField(c, t, True))
    return T.StructType(fields)


def read_accounting(spark: SparkSession, path: str) -> DataFrame:
    """A written accounting report (tab-separated, no header) with its fixed schema."""
    return spark.read.schema(accounting_schema()).option("sep", "\t").option("header", "false").csv(path)


def read_dated_reports(spark: SparkSession, root: str, schema: T.StructType | str | None = None,
                       fmt: str = "csv", sep: str = "\t") -> DataFrame:
    """Reports laid out as ``<root>/date=YYYY-MM-DD/rse=X/part-*``.

    ``date`` and ``rse`` come from the directory names, so filters on them prune
    whole directories before any file is opened. ``schema`` may be a
    ``REPORT_LAYOUTS`` key. Under a root with a manifest only published dates are read; a root
    without one is read as it is.
    """
    if isinstance(schema, str) and schema in REPORT_LAYOUTS:
        schema = REPORT_LAYOUTS[schema]
    reader = spark.read.format(fmt).option("basePath", root)
    if fmt == "csv":
        reader = reader.option("sep", sep).option("header", "false")
    if schema is not None:
        reader = reader.schema(schema)
    if not has_manifest(spark, root):
        return reader.load(root)
    dates = published_dates(spark, root)
    if not dates:
        if schema is None:
            raise ValueError(f"{root} has no published report: pass a schema to read it as empty")
        fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        keys = [T.StructField("date", T.DateType()), T.StructField("rse", T.StringType())]
        return spark.createDataFrame([], T.StructType([*fields.fields, *keys]))
    return reader.load([f"{root.rstrip('/')}/date={d}" for d in dates])


def existing_reports(spark: SparkSession, root: str, dates: list[str]) -> DataFrame:
    """``(date, rse)`` of every report directory of ``dates`` holding at least one file, empty files included.

    Under a root with a manifest: the published reports, from the entries of
    ``dates`` alone (one small read, no listing of report files). Else a report
    exists when its directory has a file, as the original lookup decided it. Spark's scans skip empty files, so this uses the file index's
    listing instead (``inputFiles``: file-system metadata Spark already keeps on
    the driver for any file scan; nothing is read). ``dates`` (the lookup
    window, ``lookup.window_dates``) bounds the listing, whatever the length of
    the history. Reports without an element level get ``rse`` NULL.
    """
    if has_manifest(spark, root):
        entries = read_manifest(spark, root, dates).where("files > 0 or element is null")
        return entries.select("date", entries["element"].alias("rse")).distinct()
    from urllib.parse import unquote

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    targets = []
    for d in dates:
        path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/date={d}")
        if path.getFileSystem(conf).exists(path):
            targets.append(str(path))
    if not targets:
        return spark.createDataFrame([], "date string, rse string")
    files = spark.read.format("binaryFile").option("basePath", root).load(targets).inputFiles()
    pairs = set()
    for path in files:
        parts = dict(seg.split("=", 1) for seg in path.split("/") if seg.startswith(("date=", "rse=")))
        if "date" in parts:
            pairs.add((unquote(parts["date"]), unquote(parts["rse"]) if "rse" in parts else None))
    return spark.createDataFrame(sorted(pairs, key=str), "date string, rse string")


def read_element_report(spark: SparkSession, root: str, date: str, rse: str, layout: str) -> DataFrame:
    """One element's report of one date, from ``rse=X`` or from a bare ``X`` directory (``strip_partition_prefix``)."""
    if has_manifest(spark, root) and date not in published_dates(spark, root):
        return spark.createDataFrame([], REPORT_LAYOUTS[layout])
    jvm = spark.sparkContext._jvm
    folders = [f"{root.rstrip('/')}/date={date}/{name}" for name in (f"rse={rse}", rse)]
    there = [f for f in folders if (p := jvm.org.apache.hadoop.fs.Path(f)).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)]
    if not there:
        return spark.createDataFrame([], REPORT_LAYOUTS[layout])
    return spark.read.schema(REPORT_LAYOUTS[layout]).option("sep", "\t").option("header", "false").csv(there[0])
