"""Atomic publication: a job killed between any two steps is invisible and can be run again."""

from __future__ import annotations

import bz2
import gzip
import json
import os

import pytest

from dumpwise import publish as pub
from dumpwise import sinks
from dumpwise.operators import lookup
from dumpwise.sources.reports import existing_reports, read_dated_reports, read_element_report

DAY, BEFORE = "2026-12-01", "2026-11-28"
LAYOUT = "_rse string, scope string, name string"
STEPS = ["write", "describe", "withdraw", "withdraw files", "move", "announce", "clean"]


class Killed(Exception):
    pass


def frame(spark, tag, elements="AB", n=6):
    return spark.range(n).selectExpr(f"element_at(split('{','.join(elements)}', ','), cast(id % {len(elements)} as int) + 1) rse", "concat('s', id % 2) scope", f"concat('{tag}', id) name")


def run(spark, root, tag, mode="errorifexists", date=DAY, **kw):
    return pub.publish(spark, root, date, lambda p: sinks.write_per_rse(frame(spark, tag, **kw), p), mode=mode, by_element=True)


def seen(spark, root, as_of=DAY):
    """What the newest-report lookup finds: {element: tags}."""
    index = existing_reports(spark, root, lookup.window_dates(as_of))
    rows = lookup.latest_reports(read_dated_reports(spark, root, LAYOUT), as_of, index=index)
    out = {}
    for r in rows.collect():
        out.setdefault(r["rse"], set()).add(r["name"].rstrip("0123456789"))
    return out


def stop_at(monkeypatch, step):
    def reached(name):
        if name == step:
            raise Killed(name)

    monkeypatch.setattr(pub, "reached", reached)


@pytest.mark.parametrize("step", [s for s in STEPS if s != "withdraw files"])
def test_killed_first_publication(spark, scratch, monkeypatch, step):
    root = f"{scratch}/r"
    run(spark, root, "old", date=BEFORE)
    stop_at(monkeypatch, step)
    with pytest.raises(Killed):
        run(spark, root, "new")
    published = step == "clean"
    assert seen(spark, root) == ({"A": {"new"}, "B": {"new"}} if published else {"A": {"old"}, "B": {"old"}})
    monkeypatch.undo()
    if published:
        with pytest.raises(FileExistsError):
            run(spark, root, "again")
    else:
        again = run(spark, root, "again")
        # files that were in place already are announced, not written again
        assert again == (step != "announce")
        assert seen(spark, root) == {x: {"new" if step == "announce" else "again"} for x in "AB"}
    assert pub.published_dates(spark, root) == [BEFORE, DAY]


@pytest.mark.parametrize("step", STEPS)
def test_killed_replacement(spark, scratch, monkeypatch, step):
    root = f"{scratch}/r"
    run(spark, root, "first")
    stop_at(monkeypatch, step)
    with pytest.raises(Killed):
        run(spark, root, "second", mode="overwrite")
    # the first report until it is withdrawn, then none, then the second: never a mixture
    want = {"write": "first", "describe": "first", "withdraw": "first", "clean": "second"}.get(step)
    assert seen(spark, root) == ({x: {want} for x in "AB"} if want else {})
    monkeypatch.undo()
    assert run(spark, root, "third", mode="overwrite")
    assert seen(spark, root) == {"A": {"third"}, "B": {"third"}}


def test_a_failing_write_leaves_nothing_visible(spark, scratch):
    root = f"{scratch}/r"

    def write(path):
        sinks.write_per_rse(frame(spark, "half"), path)
        raise Killed("element folders are being renamed")

    with pytest.raises(Killed):
        pub.publish(spark, root, DAY, write, by_element=True)
    assert seen(spark, root) == {} and not os.path.exists(f"{root}/date={DAY}")
    assert run(spark, root, "whole", mode="resume") and not run(spark, root, "other", mode="resume")
    assert seen(spark, root) == {"A": {"whole"}, "B": {"whole"}}


def test_modes(spark, scratch):
    root = f"{scratch}/r"
    run(spark, root, "a")
    with pytest.raises(FileExistsError):
        run(spark, root, "b")
    with pytest.raises(ValueError):
        run(spark, root, "b", mode="append")
    assert not run(spark, root, "b", mode="ignore")
    assert seen(spark, root) == {"A": {"a"}, "B": {"a"}}


def test_manifest_counts_elements(spark, scratch):
    root = f"{scratch}/rep"
    run(spark, root, "x", elements=["A", "B+1", "C D:%/é"], n=9)
    run(spark, root, "y", elements=["A"], n=4, date=BEFORE)
    rows = {(r["date"], r["element"]): (r["report"], r["files"], r["rows"], r["bytes"] > 0) for r in pub.read_manifest(spark, root).where("files > 0").collect()}
    assert rows == {(DAY, e): ("rep", 1, 3, True) for e in ("A", "B+1", "C D:%/é")} | {(BEFORE, "A"): ("rep", 1, 4, True)}
    assert pub.read_manifest(spark, root, [BEFORE]).where("files > 0").count() == 1
    assert pub.read_manifest(spark, root, ["2020-01-01"]).count() == 0
    back = read_dated_reports(spark, root, LAYOUT)
    assert {r["rse"] for r in back.where(f"date = '{DAY}'").collect()} == {"A", "B+1", "C D:%/é"}


def test_bare_folders_are_described_too(spark, scratch):
    root = f"{scratch}/rep"

    def write(path):
        sinks.write_per_rse(frame(spark, "n"), path)
        sinks.strip_partition_prefix(spark, path)

    pub.publish(spark, root, DAY, write, by_element=True)
    assert {(r["element"], r["rows"]) for r in pub.read_manifest(spark, root).where("files > 0").collect()} == {("A", 3), ("B", 3)}


def test_empty_reports_exist(spark, scratch):
    whole = f"{scratch}/whole"
    for day, n in ((BEFORE, 5), (DAY, 0)):
        pub.publish(spark, whole, day, lambda p, n=n: sinks.write_single_file(spark.range(n).selectExpr("concat('v', id) v"), p, ["v"]))
    rows = read_dated_reports(spark, whole, "v string")
    index = existing_reports(spark, whole, lookup.window_dates(DAY))
    assert lookup.latest_reports(rows, DAY, rse_col=None, index=index).count() == 0
    assert lookup.latest_reports(rows, BEFORE, rse_col=None, index=index).count() == 5


def test_older_layouts_are_adopted(spark, scratch):
    root = f"{scratch}/r"
    sinks.write_per_rse(frame(spark, "legacy"), f"{root}/date={BEFORE}")
    assert seen(spark, root) == {"A": {"legacy"}, "B": {"legacy"}} and not pub.has_manifest(spark, root)
    run(spark, root, "new", elements=["B", "C"])
    assert pub.published_dates(spark, root) == [BEFORE, DAY]
    assert seen(spark, root) == {"A": {"legacy"}, "B": {"new"}, "C": {"new"}}
    with pytest.raises(FileExistsError):
        run(spark, root, "x", date=BEFORE)


def test_nothing_published_reads_as_empty(spark, scratch, monkeypatch):
    root = f"{scratch}/r"
    stop_at(monkeypatch, "announce")
    with pytest.raises(Killed):
        run(spark, root, "x")
    assert read_dated_reports(spark, root, LAYOUT).count() == 0
    assert existing_reports(spark, root, [DAY]).count() == 0
    assert read_element_report(spark, root, DAY, "A", "replicas_per_rse").count() == 0
    with pytest.raises(ValueError, match="no published report"):
        read_dated_reports(spark, root)


def test_lookup_reads_entries_not_folders(spark, scratch):
    """13 dates x 300 elements: the index is one small read of the window's entries."""
    root = f"{scratch}/many"
    days = [f"2026-11-{d:02d}" for d in range(10, 23)]
    rows = spark.range(300 * 13).selectExpr("'many' report", "concat('E', id % 300) element", "1L files", "2L rows", "9L bytes", "'r' run", f"element_at(split('{','.join(days)}', ','), cast(id div 300 as int) + 1) date")
    rows.coalesce(1).write.partitionBy("date").parquet(f"{root}/_manifest")
    index = existing_reports(spark, root, lookup.window_dates("2026-11-22", back=12))
    assert index.count() == 3900 and len(index.inputFiles()) == 13
    assert all("/_manifest/" in f for f in index.inputFiles())


# ------------------------------------------------------------------------- single files


@pytest.mark.parametrize("codec, opened", [("bzip2", bz2.open), ("gzip", gzip.open), (None, open)])
def test_single_file_is_joined_from_ordered_parts(spark, scratch, codec, opened):
    df = spark.range(20_000).selectExpr("concat('k', lpad(cast((id * 7919) % 20000 as string), 6, '0')) k", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_single_file(df, f"{scratch}/one", ["k"], compression=codec)
        parts = f"{scratch}/parts"
        sinks.write_ordered(df, parts, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    names = [n for n in os.listdir(f"{scratch}/one") if not n.startswith((".", "_"))]
    assert len(names) == 1 and "_parts" not in os.listdir(f"{scratch}/one")
    data = opened(f"{scratch}/one/{names[0]}", "rb").read()
    joined = b"".join(open(f"{parts}/{n}", "rb").read() for n in sorted(os.listdir(parts)) if n.startswith("part-"))
    assert data == joined and len([n for n in os.listdir(parts) if n.startswith("part-")]) > 3
    lines = data.decode().splitlines()
    assert lines == sorted(lines) and len(lines) == 20_000
    assert spark.read.option("sep", "\t").csv(f"{scratch}/one").count() == 20_000
    with pytest.raises(FileExistsError):
        sinks.write_single_file(df, f"{scratch}/one", ["k"], compression=codec)
    sinks.write_single_file(df.limit(3), f"{scratch}/one", ["k"], mode="overwrite", compression=codec)
    assert spark.read.csv(f"{scratch}/one").count() == 3


def test_joined_bzip2_is_split_by_readers(spark, scratch):
    """Streams that follow each other stay splittable: many tasks read the one file and lose nothing."""
    df = spark.range(120_000).selectExpr("sha2(cast(id as string), 256) k", "id")
    sinks.write_single_file(df, f"{scratch}/big", ["k"], compression="bzip2")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500k")
    try:
        back = spark.read.option("sep", "\t").schema("k string, id long").csv(f"{scratch}/big")
        assert back.rdd.getNumPartitions() > 4
        assert back.agg({"id": "sum"}).first()[0] == 120_000 * 119_999 // 2 and back.count() == 120_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_parts_keep_their_order_past_five_digits(spark, scratch):
    parts = f"{scratch}/p"
    os.makedirs(parts)
    for n in (100_000, 99_999, 7):
        open(f"{parts}/part-{n:05d}-x.csv", "w").write(f"{n}\n")
    sinks.join_parts(spark, parts, f"{scratch}/out.csv")
    assert open(f"{scratch}/out.csv").read() == "7\n99999\n100000\n"
    with pytest.raises(ValueError):
        sinks.write_single_file(spark.range(1), f"{scratch}/z", compression="zstd")


# ----------------------------------------------------------------------------- delivery


def documents(spark, n, tag="d"):
    return spark.range(n).selectExpr("concat('ID', id) id", f"concat('{tag}', id) name", "id * 2 files", "cast(null as string) campaign")


def test_delivery_replaces_a_date(spark, scratch):
    target = f"{scratch}/index-2026-12"
    sinks.write_documents(documents(spark, 5), target, date=DAY)
    sinks.write_documents(documents(spark, 4, "e"), target, date=DAY)
    sinks.write_documents(documents(spark, 3), target, date=BEFORE)
    got = sorted((str(r["date"]), r["id"], r["name"]) for r in spark.read.json(target).collect())
    assert got == [(BEFORE, f"ID{i}", f"d{i}") for i in range(3)] + [(DAY, f"ID{i}", f"e{i}") for i in range(4)]
    with pytest.raises(ValueError, match="replaced by date"):
        sinks.write_documents(documents(spark, 1), target)


@pytest.mark.parametrize("step", STEPS)
def test_killed_delivery(spark, scratch, monkeypatch, step):
    target = f"{scratch}/index"
    sinks.write_documents(documents(spark, 3), target, "bulk", date=DAY)
    stop_at(monkeypatch, step)
    with pytest.raises(Killed):
        sinks.write_documents(documents(spark, 3, "e"), target, "bulk", date=DAY)
    monkeypatch.undo()
    sinks.write_documents(documents(spark, 3, "f"), target, "bulk", date=DAY)
    lines = [json.loads(x) for n in sorted(os.listdir(f"{target}/date={DAY}")) if n.startswith("part-") for x in open(f"{target}/date={DAY}/{n}")]
    assert [x["index"] for x in lines[::2]] == [{"_index": "index", "_id": f"ID{i}"} for i in range(3)]
    assert lines[1::2] == [{"id": f"ID{i}", "name": f"f{i}", "files": 2 * i} for i in range(3)]


def test_connectors_replace_by_id(monkeypatch, spark):
    """The options a store's connector gets; the jar itself is not here."""
    from pyspark.sql.readwriter import DataFrameWriter

    calls = []
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **kw: calls.append(kw) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, path: calls.append(path))
    sinks.write_documents(documents(spark, 1), "idx", "org.elasticsearch.spark.sql", options={"es.nodes": "host"})
    assert calls == [{"es.mapping.id": "id", "es.write.operation": "index", "es.nodes": "host"}, "idx"]
