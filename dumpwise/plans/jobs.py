"""Daily report jobs: load a dump, run a report, write it.

Layout: dumps at ``<dumps>/<date>/<table>``; reports at
``<reports>/<report>/date=<date>/...`` (per-element reports add ``rse=<X>``),
so the lookups (``operators.lookup``) prune by date and element from the
directory names. Reports are published in one step (``publish``): a job killed
at any point leaves no report that a lookup would take, and is simply run again
(``mode="resume"`` keeps the reports it had finished). The lineage of each write is short
(scan -> join -> aggregate -> write), so a lost executor only recomputes its
own tasks; the accounting documents read the written accounting report back,
which also cuts the lineage between the two steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from dumpwise import sinks
from dumpwise.operators import accounting, consistency, datasets, documents, incidents, replicas
from dumpwise.operators import space_usage as su
from dumpwise.plans.joins import profile
from dumpwise.publish import has_manifest, publish, published_dates
from dumpwise.session import prepare, sized_shuffles
from dumpwise.sources.catalog import load_tables
from dumpwise.sources.reports import read_accounting
from dumpwise.sources.space_usage import read_space_reports


def _dump(dumps: str, date: str) -> str:
    return f"{dumps.rstrip('/')}/{date}"


@contextmanager
def _loaded(spark: SparkSession, dumps: str, date: str, tables: list[str], fmt: str) -> Iterator[dict[str, DataFrame]]:
    """A job's dump tables, with the shuffles sized from their volume while it runs."""
    prepare(spark)
    root = _dump(dumps, date)
    with sized_shuffles(spark, [f"{root}/{t}" for t in tables]):
        yield load_tables(spark, root, tables, fmt)


def _root(reports: str, report: str) -> str:
    return f"{reports.rstrip('/')}/{report}"


def _publish(spark: SparkSession, reports: str, report: str, date: str, mode: str, write: Callable[[str], None],
             bare: bool | None = None) -> None:
    """Write a report into staging and publish it; ``bare`` (per-element reports): folders ``X`` instead of ``rse=X``."""

    def staged(path: str) -> None:
        write(path)
        if bare:
            sinks.strip_partition_prefix(spark, path)

    publish(spark, _root(reports, report), date, staged, mode=mode, by_element=bare is not None)


def consistency_job(spark: SparkSession, dumps: str, reports: str, date: str, fmt: str = "parquet",
                    mode: str = "errorifexists", full_single_file: bool = False,
                    compression: str | None = "bzip2", bare_element_dirs: bool = False) -> None:
    """R1 per element and R2 as bzip2 parts, globally ordered (part order = row order).

    ``full_single_file=True`` writes R2 as one file for readers that need it;
    its parts are written in parallel and joined.
    ``bare_element_dirs`` names element directories ``X`` instead of ``rse=X``.
    """
    with _loaded(spark, dumps, date, ["dslocks", "rses", "dids"], fmt) as t:
        elements = profile(t["rses"], "rse")
        per_element = consistency.consistency_datasets(t["dslocks"], t["rses"], t["dids"], elements)
        _publish(spark, reports, "consistency_datasets", date, mode, lambda p: sinks.write_per_rse(per_element, p), bare_element_dirs)
        full = consistency.consistency_datasets_full(t["dslocks"], t["rses"], elements)
        write = sinks.write_single_file if full_single_file else sinks.write_ordered
        _publish(spark, reports, "consistency_datasets_full", date, mode,
                 lambda p: write(full, p, consistency.FULL_COLUMNS, compression=compression))


def datasets_job(spark: SparkSession, dumps: str, reports: str, date: str, fmt: str = "parquet",
                 mode: str = "errorifexists", one_file_per_rse: bool = False,
                 bare_element_dirs: bool = False) -> None:
    """R3 per element, times as ``TS_MILLIS_UTC``.

    A large element has several files; ``one_file_per_rse=True`` serves readers that take only the first.
    """
    with _loaded(spark, dumps, date, ["collection_replicas", "dslocks", "rses"], fmt) as t:
        out = datasets.datasets_per_rse(t["collection_replicas"], t["dslocks"], t["rses"])
        _publish(spark, reports, "datasets_per_rse", date, mode,
                 lambda p: sinks.write_per_rse(out, p, one_file_per_rse=one_file_per_rse, timestamp_format=sinks.TS_MILLIS_UTC), bare_element_dirs)


def replicas_job(spark: SparkSession, dumps: str, reports: str, date: str, fmt: str = "parquet",
                 mode: str = "errorifexists", compression: str | None = "bzip2",
                 bare_element_dirs: bool = False) -> None:
    """R4 per element, bzip2 (the report format; ``compression`` may name another codec or None),
    times as ``TS_SECONDS``, rows by path inside each element."""
    with _loaded(spark, dumps, date, ["replicas", "rses"], fmt) as t:
        out = replicas.replicas_per_rse(t["replicas"], t["rses"])
        _publish(spark, reports, "replicas_per_rse", date, mode,
                 lambda p: sinks.write_per_rse(out, p, sort_keys=("path",), compression=compression, timestamp_format=sinks.TS_SECONDS), bare_element_dirs)


def suspicious_job(spark: SparkSession, dumps: str, reports: str, dump_date: str, start: int, end: int,
                   report_date: str, fmt: str = "parquet", mode: str = "errorifexists",
                   keep_stored_path: bool = False) -> None:
    """R5 as one file ordered by (rse, scope, name)."""
    with _loaded(spark, dumps, dump_date, ["bad_replicas", "replicas", "rses", "rse_protocols"], fmt) as t:
        out = incidents.suspicious_files(t["bad_replicas"], t["replicas"], t["rses"], t["rse_protocols"], start, end,
                                         keep_stored_path)
        _publish(spark, reports, "suspicious_files", report_date, mode, lambda p: sinks.write_single_file(out, p, ("rse", "scope", "name")))


def lost_job(spark: SparkSession, dumps: str, reports: str, dump_date: str, start: int, end: int,
             report_date: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """R6 as one file."""
    with _loaded(spark, dumps, dump_date, ["bad_replicas", "contents_history", "rses"], fmt) as t:
        out = incidents.lost_files(t["bad_replicas"], t["contents_history"], t["rses"], start, end)
        _publish(spark, reports, "lost_files", report_date, mode, lambda p: sinks.write_single_file(out, p))


def accounting_job(spark: SparkSession, dumps: str, reports: str, date: str, fmt: str = "parquet",
                   mode: str = "errorifexists", cut_lineage: bool = False, split_hot_files: bool | None = None) -> None:
    """R7 as many files, globally ordered by (scope, name); optionally checkpointing its largest intermediate."""
    with _loaded(spark, dumps, date, ["replicas", "rses", "rse_metadata", "contents", "dids"], fmt) as t:
        out = accounting.global_accounting(t["replicas"], t["rses"], t["rse_metadata"], t["contents"], t["dids"],
                                           cut_lineage=cut_lineage, split_hot_files=split_hot_files)
        _publish(spark, reports, "global_accounting", date, mode, lambda p: sinks.write_ordered(out, p, ("scope", "name")))


def documents_job(spark: SparkSession, reports: str, date: str, month: str, target: str | None = None,
                  fmt: str = "json", options: Mapping[str, str] | None = None) -> None:
    """R8 + R9: read the published accounting report of ``date`` and deliver its documents, replacing the date's earlier ones.

    ``target`` defaults to ``<reports>/<index>`` for the file formats (``json``, ``bulk``); for a
    connector format pass the index name.
    """
    prepare(spark)
    root = _root(reports, "global_accounting")
    if has_manifest(spark, root) and date not in published_dates(spark, root):
        raise FileNotFoundError(f"no accounting report of {date} is published under {root}")
    docs = documents.accounting_documents(read_accounting(spark, f"{root}/date={date}"), date)
    documents.deliver_documents(docs, target or f"{reports.rstrip('/')}/{documents.index_name(month)}", fmt, options, date=date)


def space_usage_job(spark: SparkSession, documents_path: str, out: str, mode: str = "errorifexists") -> None:
    """R12 + R13 over many site documents: typed rows (Parquet) and violations (JSON)."""
    prepare(spark)
    docs = read_space_reports(spark, documents_path)
    su.space_usage(docs, "source", "text").write.mode(mode).parquet(f"{out.rstrip('/')}/space_usage")
    su.space_usage_violations(docs, "source", "text").write.mode(mode).json(f"{out.rstrip('/')}/violations")
