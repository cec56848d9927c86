"""Keys found hot at run time: same rows, other plan."""

from __future__ import annotations

import pytest
from catalogue_rows import SF_SMALL, rows
from pyspark.sql import functions as F

from dumpwise.operators import accounting, consistency, datasets, incidents
from dumpwise.plans import hot as H
from dumpwise.sources.catalog import load_tables
from dumpwise.sources.fixtures import WINDOW_END, WINDOW_START, FixtureCatalog

TABLES = ["dslocks", "rses", "dids", "collection_replicas", "replicas", "contents", "rse_metadata", "bad_replicas", "contents_history", "rse_protocols"]


@pytest.fixture(scope="module")
def t(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("hot"))
    c = FixtureCatalog(spark, SF_SMALL)
    for name in TABLES:
        c[name].write.parquet(f"{root}/{name}")
    return load_tables(spark, root, TABLES)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_sketch_finds_the_hot_keys(spark):
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) a", "cast(if(id % 3 = 0, null, id % 7) as string) b")
    found = H.hot_keys(df, ["a", "b"], 10_000)
    assert len(found) == 1 and df.where(H.is_hot(["a", "b"], found)).count() == 20_000
    assert H.hot_keys(df, ["a", "b"], 30_000) == [] and H.hot_keys(df.limit(0), ["a"], 1) == []


def test_no_hot_key_leaves_the_plain_plan(t):
    plain = consistency.consistency_datasets(t["dslocks"], t["rses"], t["dids"])
    assert "rangepartitioning" not in plan(plain) and "Union" not in plan(plain)
    classified, unique = accounting.prepared_replicas(t["replicas"], t["rses"], t["rse_metadata"])
    auto = accounting.attribute_to_dataset(classified, t["contents"], unique)
    never = accounting.attribute_to_dataset(classified, t["contents"], unique, split_hot_files=False)
    assert plan(auto).count("Exchange") == plan(never).count("Exchange")


def hot_locks(spark, t):
    """The locks of the fixture and a dataset that holds a third of all: repeated times, NULL accounts and rules, ties."""
    n = t["dslocks"].count() // 2
    lock = t["dslocks"].where("state = 'O'").limit(1)
    values = {"created_at": "cast((id * 7919) % 500 as bigint)", "rule_id": "if(id % 11 = 0, null, concat('r', id % 90))", "account": "if(id % 13 = 0, null, concat('a', id % 40))"}
    many = lock.crossJoin(spark.range(n)).selectExpr(*[f"{values.get(c, c)} {c}" for c in t["dslocks"].columns])
    return t["dslocks"].unionByName(many)


def test_ordered_lists_in_segments(spark, t):
    locks = hot_locks(spark, t)
    few, all_ = 50, 1 << 60
    a = consistency.consistency_datasets(locks, t["rses"], t["dids"], hot_rows=few)
    same(a, consistency.consistency_datasets(locks, t["rses"], t["dids"], hot_rows=all_))
    assert "rangepartitioning" in plan(a) and "Union" in plan(a)
    a = datasets.datasets_per_rse(t["collection_replicas"], locks, t["rses"], hot_rows=few)
    same(a, datasets.datasets_per_rse(t["collection_replicas"], locks, t["rses"], hot_rows=all_))
    assert "rangepartitioning" in plan(a)


def test_no_task_gathers_a_hot_keys_locks(spark, t):
    """Before the last step a hot key lies in ranges of lock time, each a small part of it."""
    locks = hot_locks(spark, t).where("state = 'O'")
    keys = ["scope", "name", "rse_id"]
    hot = H.hot_keys(locks, keys, 200)
    assert len(hot) == 1
    n = locks.where(H.is_hot(keys, hot)).count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # ranges this small would be joined
    try:
        parts = locks.where(H.is_hot(keys, hot)).repartitionByRange(*keys, "created_at", "rule_id", "account").groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in parts.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == n and len(sizes) >= 4 and max(sizes) <= n / 3
    lists = H.ordered_lists(locks, keys, "created_at", ["rule_id", "account"], hot=hot)
    assert max(len(r["locks"]) for r in lists.collect()) == n


def test_hot_files_alone_are_merged_early(spark, t):
    replicas = t["replicas"]
    file = replicas.limit(1).selectExpr("scope s", "name f").first()
    more = replicas.where(f"scope = '{file['s']}' and name = '{file['f']}'").limit(1).crossJoin(spark.range(400)).selectExpr(
        *[{"bytes": "cast(id as bigint) bytes", "accessed_at": "cast(id * 3 as bigint) accessed_at"}.get(c, c) for c in replicas.columns])
    replicas = replicas.unionByName(more)
    classified, unique = accounting.prepared_replicas(replicas, t["rses"], t["rse_metadata"])
    hot = H.hot_keys(classified, ["scope", "name"], 300)
    assert len(hot) <= 1  # the file may lie at an element that is not accounted
    for flag in {unique, False}:
        auto = accounting.attribute_to_dataset(classified, t["contents"], flag, hot_rows=300)
        for other in (True, False):
            same(auto, accounting.attribute_to_dataset(classified, t["contents"], flag, split_hot_files=other))
        assert ("Union" in plan(auto)) == bool(hot)
    # every file hot, for the rows of the whole split path
    same(accounting.attribute_to_dataset(classified, t["contents"], unique, hot_rows=1), accounting.attribute_to_dataset(classified, t["contents"], unique, split_hot_files=False))


@pytest.mark.parametrize("report", ["lost", "suspicious"])
def test_declared_files_filter_the_big_table_below_its_shuffle(spark, t, report, monkeypatch):
    def made():
        if report == "lost":
            return incidents.lost_files(t["bad_replicas"], t["contents_history"], t["rses"], WINDOW_START, WINDOW_END)
        return incidents.suspicious_files(t["bad_replicas"], t["replicas"], t["rses"], t["rse_protocols"], WINDOW_START, WINDOW_END)

    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = made()
        text = plan(df)
        big = "contents_history" if report == "lost" else "/replicas"
        lines = text.splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line and big in line)
        above = [line for line in reversed(lines[:scan]) if "Exchange hashpartitioning" in line or "LeftSemi" in line]
        assert "LeftSemi" in above[0] and "BroadcastHashJoin" in above[0], text
        filtered = rows(df, *df.columns)
        monkeypatch.setattr(incidents, "keep_matching", lambda big, few, on: big)
        assert filtered == rows(made(), *df.columns) and filtered
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_too_many_keys_are_no_filter(spark):
    from dumpwise.plans.joins import keep_matching

    big, few = spark.range(100).selectExpr("id a", "id b"), spark.range(10).selectExpr("id x", "id y")
    assert keep_matching(big, few, {"a": "x", "b": "y"}, max_bytes=100) is big
    assert keep_matching(big, few, {"a": "x", "b": "y"}).count() == 10
