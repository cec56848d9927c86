"""Edge rows of the accounting chain and documents (FIXTURES.md section 3), plus properties."""

from __future__ import annotations

import hashlib

from catalogue_rows import SF_MEDIUM, rows, table
from pyspark.sql import functions as F

from dumpwise.operators import accounting, documents
from dumpwise.sources.fixtures import FixtureCatalog


def test_accounted_rses(spark):
    rses = table(spark, "rses", [
        {"id": "1", "rse": "NOTIER", "rse_type": "DISK"},
        {"id": "2", "rse": "T3DISK", "rse_type": "DISK"},
        {"id": "3", "rse": "T3TAPE", "rse_type": "TAPE"},
        {"id": "4", "rse": "SCRATCH", "rse_type": "DISK"},
        {"id": "5", "rse": accounting.SPECIAL_RSE, "rse_type": "DISK"},
        {"id": "6", "rse": "BARETAPE", "rse_type": "TAPE"},
    ])
    meta = table(spark, "rse_metadata", [
        {"rse_id": "1", "key": "type", "value": "DATADISK"},
        {"rse_id": "2", "key": "type", "value": "DATADISK"}, {"rse_id": "2", "key": "tier", "value": "3"},
        {"rse_id": "3", "key": "type", "value": "DATATAPE"}, {"rse_id": "3", "key": "tier", "value": "3"},
        {"rse_id": "4", "key": "type", "value": "SCRATCHDISK"}, {"rse_id": "4", "key": "tier", "value": "1"},
        {"rse_id": "5", "key": "type", "value": "SCRATCHDISK"}, {"rse_id": "5", "key": "other", "value": "x"},
    ])
    out = {r["rse"]: r["tier"] for r in rows(accounting.accounted_rses(rses, meta))}
    assert out == {"NOTIER": "-2", "T3TAPE": "3", accounting.SPECIAL_RSE: "-2"}


def _chain(spark, replica_rows, content_rows):
    rses = table(spark, "rses", [{"id": "1", "rse": "D1", "rse_type": "DISK"},
                                 {"id": "2", "rse": "T2", "rse_type": "TAPE"}])
    meta = table(spark, "rse_metadata", [{"rse_id": "1", "key": "type", "value": "DATADISK"},
                                         {"rse_id": "1", "key": "tier", "value": "0"},
                                         {"rse_id": "2", "key": "type", "value": "DATATAPE"},
                                         {"rse_id": "2", "key": "tier", "value": "2"}])
    classified = accounting.classified_replicas(table(spark, "replicas", replica_rows),
                                                accounting.accounted_rses(rses, meta))
    return classified, table(spark, "contents", content_rows)


def _parent(ds_scope, ds_name, f):
    return {"scope": ds_scope, "name": ds_name, "did_type": "D", "child_scope": "s", "child_name": f,
            "child_type": "F"}


def test_owner_choice(spark):
    reps = [{"scope": "s", "name": f, "rse_id": "1", "bytes": 10} for f in ("f1", "f2", "f3", "f4")]
    cont = [_parent("a", "z", "f1"), _parent("a.b", "c", "f1"),
            _parent("panda", "x", "f2"),
            _parent("panda", "x", "f3"), _parent("z", "y", "f3")]
    classified, contents = _chain(spark, reps, cont)
    for per_file in (True, False):
        out = {r["fname"]: (r["dscope"], r["dname"])
               for r in rows(accounting.attribute_to_dataset(classified, contents, per_file))}
        assert out == {"f1": ("a.b", "c"), "f3": ("z", "y"), "f4": ("no_scope", "no_name")}


def test_storage_classes_and_factors(spark):
    reps = [
        {"scope": "s", "name": "f1", "rse_id": "1", "bytes": 10, "accessed_at": None},
        {"scope": "s", "name": "f2", "rse_id": "1", "bytes": None, "accessed_at": 5, "tombstone": 1},
        {"scope": "s", "name": "f9", "rse_id": "2", "bytes": 3},  # tape tier 2: no class
    ]
    cont = [_parent("d", "ds", "f1"), _parent("d", "ds", "f2"), _parent("d", "tapeonly", "f9")]
    classified, contents = _chain(spark, reps, cont)
    owned = accounting.attribute_to_dataset(classified, contents)
    usage = {r["dname"]: r for r in rows(accounting.storage_class_usage(owned))}
    assert set(usage) == {"ds"}
    u = usage["ds"]
    assert (u["prim_t0_files"], u["prim_t0_bytes"], u["prim_t0_accessed_files"]) == (1, 10, 1)
    assert (u["secs_t0_files"], u["secs_t0_bytes"], u["tape_t1_files"], u["accessed_at"]) == (1, 0, 0, 5)
    strict = {r["dname"]: r for r in rows(accounting.storage_class_usage(owned, accessed_means_positive=True))}
    assert strict["ds"]["prim_t0_accessed_files"] == 0 and strict["ds"]["secs_t0_accessed_files"] == 1

    usage_df = accounting.storage_class_usage(owned).union(
        accounting.storage_class_usage(owned).withColumn("dname", F.lit("zero")).withColumn("accessed_at", F.lit(0))
    ).union(accounting.storage_class_usage(owned).withColumn("dname", F.lit("missing")))
    dids = table(spark, "dids", [{"scope": "d", "name": "ds", "length": 4, "accessed_at": 2},
                                 {"scope": "d", "name": "zero", "length": 0, "accessed_at": 0}])
    out = {r["name"]: r for r in rows(accounting.replication_factors(usage_df, dids))}
    assert out["ds"]["primary_repl_factor_t0"] == 0.25 and out["ds"]["accessed_at"] == 5
    assert out["zero"]["primary_repl_factor_t0"] is None and out["zero"]["accessed_at"] is None
    assert out["missing"]["primary_repl_factor_t0"] is None and out["missing"]["accessed_at"] is None
    assert out["missing"]["length"] == 0 and out["missing"]["events"] == 0


def test_owner_is_the_smallest_parent(spark):
    """Owners against a plain computation over all parents of each file."""
    c = FixtureCatalog(spark, SF_MEDIUM)
    classified = accounting.classified_replicas(c.replicas, accounting.accounted_rses(c.rses, c.rse_metadata))
    parents = {}
    for r in c.contents.where("did_type = 'D' and child_type = 'F'").collect():
        names = parents.setdefault((r["child_scope"], r["child_name"]), set())
        if r["scope"] != "panda":
            names.add((f"{r['scope'] or 'no_scope'}:{r['name'] or 'no_name'}", r["scope"] or "no_scope", r["name"] or "no_name"))
    want = {}
    for r in classified.collect():
        names = parents.get((r["scope"], r["name"]), {("", "no_scope", "no_name")})
        if names:
            want[r["scope"], r["name"], r["rse"]] = min(names)[1:]
    got = {(r["fscope"], r["fname"], r["rse"]): (r["dscope"], r["dname"])
           for r in accounting.attribute_to_dataset(classified, c.contents).collect()}
    assert got == want


def test_usage_totals_equal_classed_rows(spark):
    c = FixtureCatalog(spark, SF_MEDIUM)
    classified = accounting.classified_replicas(c.replicas, accounting.accounted_rses(c.rses, c.rse_metadata))
    owned = accounting.attribute_to_dataset(classified, c.contents)
    usage = accounting.storage_class_usage(owned)
    total = usage.select(sum(F.col(f"{s}_files") for s, *_ in accounting.CLASSES).alias("n")).agg(F.sum("n")).first()[0]
    classed = owned.filter(
        ((F.col("rse_type") == "DISK") & F.col("tier").isin("0", "1", "2"))
        | ((F.col("rse_type") == "TAPE") & F.col("tier").isin("0", "1"))).count()
    assert total == classed


def test_result_independent_of_shuffle_partitions(spark):
    c = FixtureCatalog(spark, "/root/testdata/sf0.001")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = accounting.global_accounting(c.replicas, c.rses, c.rse_metadata, c.contents, c.dids).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        b = accounting.global_accounting(c.replicas, c.rses, c.rse_metadata, c.contents, c.dids).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


def test_documents(spark):
    report = spark.createDataFrame([], accounting_schema()).union(spark.createDataFrame(
        [tuple(_doc_row().get(c) for c in accounting.accounting_columns())], accounting_schema()))
    docs = documents.accounting_documents(report, "2026-12-01")
    assert len(docs.columns) == 80
    r = docs.first()
    assert r["id"] == hashlib.sha1(b"2026-12-01_mc16_null").hexdigest().upper()
    assert r["total_files"] == 8 and r["disk_files"] == 6 and r["tape_files"] == 2
    assert r["primary_repl_factor"] == 1.5 and r["secondary_repl_factor"] is None
    assert r["datatype_grouped"] == "RAW" and r["timestamp"] == "2026-12-01"


def accounting_schema():
    from dumpwise.sources.reports import accounting_schema as s
    return s()


def _doc_row():
    row = {"scope": "mc16", "name": None, "datatype": "DRAW_X"}
    for c in accounting.accounting_columns():
        if "files" in c or "bytes" in c:
            row[c] = 1
    for s in ("t0", "t1", "t2"):
        row[f"primary_repl_factor_{s}"] = 0.5
        row[f"secondary_repl_factor_{s}"] = 0.5 if s != "t1" else None
    row["tape_repl_factor_t0"] = row["tape_repl_factor_t1"] = 0.0
    return row


def test_unique_name_path_equals_exact_path(spark):
    c = FixtureCatalog(spark, SF_MEDIUM)
    accounted = accounting.accounted_rses(c.rses, c.rse_metadata)
    assert accounting.rse_names_unique(accounted)
    classified = accounting.classified_replicas(c.replicas, accounted)
    fast = accounting.attribute_to_dataset(classified, c.contents, True)
    exact = accounting.attribute_to_dataset(classified, c.contents, False)
    assert fast.exceptAll(exact).count() == 0 and exact.exceptAll(fast).count() == 0
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan.split("BroadcastHashJoin")[0]


def test_report_row_properties(spark):
    from dumpwise.operators import consistency, replicas

    c = FixtureCatalog(spark, SF_MEDIUM)
    n_rses = c.rses.count()
    r1 = consistency.consistency_datasets(c.dslocks, c.rses, c.dids)
    assert r1.agg(F.max("count")).first()[0] <= n_rses
    # per dataset, count equals its number of rows (one per element)
    per_ds = r1.groupBy("scope", "name").agg(F.count("*").alias("n"), F.max("count").alias("c"), F.min("count").alias("m"))
    assert per_ds.filter("n != c or c != m").count() == 0
    r4 = replicas.replicas_per_rse(c.replicas, c.rses)
    assert r4.count() == c.replicas.join(c.rses, c.replicas["rse_id"] == c.rses["id"]).count()


def test_split_hot_files_equals_default(spark):
    c = FixtureCatalog(spark, SF_MEDIUM)
    classified, unique = accounting.prepared_replicas(c.replicas, c.rses, c.rse_metadata)
    base = accounting.attribute_to_dataset(classified, c.contents, unique)
    for flag in (True, False):
        split = accounting.attribute_to_dataset(classified, c.contents, flag, split_hot_files=True)
        assert split.exceptAll(base).count() == 0 and base.exceptAll(split).count() == 0


def test_split_hot_files_on_a_hot_file(spark):
    # One file with thousands of duplicate replica rows on two elements, next to ordinary files.
    hot = [{"scope": "s", "name": "hot", "rse_id": str(1 + i % 2), "bytes": i, "accessed_at": i,
            "tombstone": 1 if i == 7 else None} for i in range(3000)]
    cold = [{"scope": "s", "name": f"f{i}", "rse_id": "1", "bytes": 1} for i in range(20)]
    rses = table(spark, "rses", [{"id": "1", "rse": "D1", "rse_type": "DISK"}, {"id": "2", "rse": "D2", "rse_type": "DISK"}])
    meta = table(spark, "rse_metadata", [{"rse_id": i, "key": "type", "value": "DATADISK"} for i in ("1", "2")])
    classified, unique = accounting.prepared_replicas(table(spark, "replicas", hot + cold), rses, meta)
    contents = table(spark, "contents", [_parent("d", "ds", "hot"), _parent("d", "ds", "f3")])
    base = accounting.attribute_to_dataset(classified, contents, unique)
    split = accounting.attribute_to_dataset(classified, contents, unique, split_hot_files=True)
    assert sorted(map(tuple, base.collect()), key=str) == sorted(map(tuple, split.collect()), key=str)
    got = {(r["fname"], r["rse"]): r for r in rows(split)}
    assert got[("hot", "D2")]["bytes"] == 2999 and got[("hot", "D2")]["type"] == "secondary"
    assert got[("hot", "D1")]["type"] == "primary" and len(got) == 22
