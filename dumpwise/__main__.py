"""Command line for the daily report jobs.

    python -m dumpwise consistency --dumps D --reports R --date 2026-12-01
    python -m dumpwise datasets    --dumps D --reports R --date 2026-12-01 [--one-file-per-rse]
    python -m dumpwise replicas    --dumps D --reports R --date 2026-12-01
    python -m dumpwise suspicious  --dumps D --reports R --date 2026-12-01 --start S --end E --report-date 2026-12-02
    python -m dumpwise lost        --dumps D --reports R --date 2026-12-01 --start S --end E --report-date 2026-12-02
    python -m dumpwise accounting  --dumps D --reports R --date 2026-12-01 [--cut-lineage] [--split-hot-files]
    python -m dumpwise documents   --reports R --date 2026-12-01 --month 2026-12 [--target T --format F --option K=V ...]
    python -m dumpwise space-usage --documents DIR --out OUT

``--start``/``--end`` are epoch seconds (half-open window). ``--format`` of the
dump defaults to parquet (``--dump-format avro`` needs the spark-avro package).
The session is whatever ``spark-submit`` provides; only UTC and AQE are set.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from dumpwise.plans import jobs


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="dumpwise", description="Daily storage-catalogue report jobs")
    sub = p.add_subparsers(dest="job", required=True)

    def job(name: str, dated: bool = True, dump: bool = True, window: bool = False) -> argparse.ArgumentParser:
        j = sub.add_parser(name)
        if dump:
            j.add_argument("--dumps", required=True)
            j.add_argument("--dump-format", default="parquet")
        if dated:
            j.add_argument("--reports", required=True)
            j.add_argument("--date", required=True)
            j.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite", "resume"])
        if window:
            j.add_argument("--start", type=int, required=True)
            j.add_argument("--end", type=int, required=True)
            j.add_argument("--report-date", required=True)
        return j

    cons = job("consistency")
    cons.add_argument("--full-single-file", action="store_true",
                      help="the full listing as one file, joined from its ordered parts (default: the parts)")
    cons.add_argument("--compression", default="bzip2", help="codec of the full listing (none: uncompressed)")
    sets = job("datasets")
    sets.add_argument("--one-file-per-rse", action="store_true",
                      help="one file per element; by default a large element has several and readers must take all")
    reps = job("replicas")
    reps.add_argument("--compression", default="bzip2", help="codec of the text files (none: uncompressed)")
    for j in (cons, sets, reps):
        j.add_argument("--bare-element-dirs", action="store_true", help="element directories as X instead of rse=X")
    job("suspicious", window=True).add_argument("--keep-stored-path", action="store_true")
    job("lost", window=True)
    acc = job("accounting")
    acc.add_argument("--cut-lineage", action="store_true")
    acc.add_argument("--split-hot-files", action="store_true", default=None,
                     help="merge every file's replicas before the owner join (default: of files found hot)")
    d = sub.add_parser("documents")
    d.add_argument("--reports", required=True)
    d.add_argument("--date", required=True)
    d.add_argument("--month", required=True)
    d.add_argument("--target")
    d.add_argument("--format", default="json")
    d.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                   help="writer option of the format, e.g. nodes and id mapping of a search store (repeatable)")
    s = sub.add_parser("space-usage")
    s.add_argument("--documents", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--mode", default="errorifexists")
    return p


def _options(pairs: list[str]) -> dict[str, str]:
    bad = [p for p in pairs if "=" not in p]
    if bad:
        raise SystemExit(f"--option needs KEY=VALUE, got {bad}")
    return dict(p.split("=", 1) for p in pairs)


def _codec(name: str) -> str | None:
    return None if name.lower() in ("none", "") else name


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"dumpwise-{a.job}").getOrCreate()
    if a.job == "consistency":
        jobs.consistency_job(spark, a.dumps, a.reports, a.date, a.dump_format, a.mode, a.full_single_file,
                             _codec(a.compression), a.bare_element_dirs)
    elif a.job == "datasets":
        jobs.datasets_job(spark, a.dumps, a.reports, a.date, a.dump_format, a.mode, a.one_file_per_rse, a.bare_element_dirs)
    elif a.job == "replicas":
        jobs.replicas_job(spark, a.dumps, a.reports, a.date, a.dump_format, a.mode, _codec(a.compression),
                          a.bare_element_dirs)
    elif a.job == "suspicious":
        jobs.suspicious_job(spark, a.dumps, a.reports, a.date, a.start, a.end, a.report_date, a.dump_format, a.mode,
                            a.keep_stored_path)
    elif a.job == "lost":
        jobs.lost_job(spark, a.dumps, a.reports, a.date, a.start, a.end, a.report_date, a.dump_format, a.mode)
    elif a.job == "accounting":
        jobs.accounting_job(spark, a.dumps, a.reports, a.date, a.dump_format, a.mode, a.cut_lineage,
                            a.split_hot_files)
    elif a.job == "documents":
        jobs.documents_job(spark, a.reports, a.date, a.month, a.target, a.format, _options(a.option))
    elif a.job == "space-usage":
        jobs.space_usage_job(spark, a.documents, a.out, a.mode)
    return 0


if __name__ == "__main__":
    sys.exit(main())
