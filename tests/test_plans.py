"""Physical-plan properties the reports rely on (pushdown, build side, exchange reuse)."""

from __future__ import annotations

import re

import pytest
from catalogue_rows import SF_SMALL

from dumpwise.operators import accounting, datasets, incidents
from dumpwise.sources.catalog import TABLES, load_tables
from dumpwise.sources.fixtures import WINDOW_END, WINDOW_START, FixtureCatalog

DATE = "2026-12-01"


@pytest.fixture(scope="module")
def t(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plandump"))
    c = FixtureCatalog(spark, SF_SMALL)
    for name in TABLES:
        c[name].write.parquet(f"{root}/{name}")
    return load_tables(spark, root)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    """The text of ``df.explain("formatted")`` (scan details are not truncated there)."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _subtrees(plan: str, node: str) -> list[str]:
    """Text of every subtree rooted at a line containing ``node``."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if node in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            sub = [line]
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= depth:
                    break
                sub.append(nxt)
            out.append("\n".join(sub))
    return out


def test_incident_window_and_state_reach_the_scan(t):
    df = incidents.lost_files(t["bad_replicas"], t["contents_history"], t["rses"], WINDOW_START, WINDOW_END)
    plan = _formatted(df)
    assert f"GreaterThan(created_at,{WINDOW_START * 1000 - 1000})" in plan
    assert f"LessThan(created_at,{WINDOW_END * 1000 + 1000})" in plan
    assert "EqualTo(state,L)" in plan and "EqualTo(did_type,D)" in plan


def test_broadcast_side_is_the_dimension(t):
    classified, _ = accounting.prepared_replicas(t["replicas"], t["rses"], t["rse_metadata"])
    plan = _plan(classified)
    broadcasts = _subtrees(plan, "BroadcastExchange")
    assert broadcasts
    assert not any(re.search(r"/replicas[\]/,]", b) for b in broadcasts)


def test_datasets_per_rse_aggregates_on_the_join_partitioning(spark, t):
    # Plan as at scale: no automatic broadcast of the (here tiny) lock table.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = datasets.datasets_per_rse(t["collection_replicas"], t["dslocks"], t["rses"])
        plan = _plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # two exchanges feed the sort-merge join; the list aggregation adds none
    assert "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_single_file_sink_keeps_upstream_parallel(spark, t, tmp_path):
    from dumpwise.sinks import write_single_file

    df = incidents.lost_files(t["bad_replicas"], t["contents_history"], t["rses"], WINDOW_START, WINDOW_END)
    out = df.repartition(1)
    assert "Exchange SinglePartition" in _plan(out) or "RoundRobinPartitioning(1)" in _plan(out)
    write_single_file(df, str(tmp_path / "one"))
    assert len([p for p in (tmp_path / "one").iterdir() if p.name.startswith("part-")]) == 1


def test_report_lookup_prunes_directories_and_shuffles_no_rows(spark, scratch):
    from dumpwise.operators import lookup
    from dumpwise.sources.reports import existing_reports, read_dated_reports

    root = f"{scratch}/lookup"
    rows = [("2026-11-20", "A", 1), ("2026-11-30", "A", 2), ("2026-11-30", "B", 3), ("2026-12-01", "B", 4)]
    spark.createDataFrame(rows, "date string, rse string, v int").write.partitionBy("date", "rse").csv(root, sep="\t")
    reports = read_dated_reports(spark, root, "v int")
    index = existing_reports(spark, root, lookup.window_dates("2026-12-01"))
    every = lookup.latest_reports(reports, "2026-12-01", index=index)
    one = lookup.latest_reports(reports, "2026-12-01", rse="A", index=index)
    assert sorted(r["v"] for r in every.collect()) == [2, 4] and [r["v"] for r in one.collect()] == [2]
    for df, partition in ((every, "date"), (one, "rse")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan" in line)
        filters = scan[scan.index("PartitionFilters"):]
        assert partition in filters and "date" in filters
        # only the small table of newest dates may be exchanged, never the scanned report rows
        above = plan[: plan.index("FileScan")].splitlines()[-6:]
        assert not any("Exchange" in line for line in above), plan
