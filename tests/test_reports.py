"""Edge rows of the per-element and incident reports (FIXTURES.md section 3)."""

from __future__ import annotations

import hashlib

from catalogue_rows import rows, table

from dumpwise.operators import consistency, datasets, incidents, replicas

RSES = [{"id": "1", "rse": "A", "rse_type": "DISK"}, {"id": "2", "rse": "B", "rse_type": "DISK"}]
START, END = 1000, 2000


def test_lost_files_fan_out_and_drops(spark):
    bad = table(spark, "bad_replicas", [
        {"scope": "s", "name": "f1", "rse_id": "1", "state": "L", "account": "a", "created_at": 1_500_000,
         "updated_at": 1_600_999},
        {"scope": "s", "name": "f2", "rse_id": "1", "state": "L", "account": "a", "created_at": 1_500_000},
        {"scope": "s", "name": "f3", "rse_id": "1", "state": "L", "account": "a", "created_at": 1_500_000},
        {"scope": "s", "name": "f1", "rse_id": "1", "state": "S", "account": "a", "created_at": 1_500_000},
    ])
    hist = table(spark, "contents_history", [
        {"scope": "d", "name": "ds1", "did_type": "D", "child_scope": "s", "child_name": "f1"},
        {"scope": "d", "name": "ds2", "did_type": "D", "child_scope": "s", "child_name": "f1"},
        {"scope": "d", "name": "c1", "did_type": "C", "child_scope": "s", "child_name": "f3"},
    ])
    out = rows(incidents.lost_files(bad, hist, table(spark, "rses", RSES), START, END), "name")
    assert [(r["fname"], r["name"], r["rse"], r["updated_at"]) for r in out] == [("f1", "ds1", "A", 1600),
                                                                                   ("f1", "ds2", "A", 1600)]


def _suspicious_inputs(spark):
    bad = table(spark, "bad_replicas", [
        {"scope": "mc16", "name": "f1", "rse_id": "2", "state": "S", "created_at": START * 1000},
        {"scope": "mc16", "name": "f1", "rse_id": "2", "state": "S", "created_at": START * 1000 + 5},
        {"scope": "mc16", "name": "f2", "rse_id": "2", "state": "S", "created_at": END * 1000},
        {"scope": "mc16", "name": "f3", "rse_id": "2", "state": "S", "created_at": END * 1000 - 1},
        {"scope": "mc16", "name": "f4", "rse_id": "2", "state": "S", "created_at": 1_500_000},
    ])
    reps = table(spark, "replicas", [
        {"scope": "mc16", "name": "f1", "rse_id": "2"},
        {"scope": "mc16", "name": "f2", "rse_id": "2"},
        {"scope": "mc16", "name": "f3", "rse_id": "2"},
        {"scope": "mc16", "name": "f4", "rse_id": "2", "path": "/stored/f4"},
    ])
    protocols = table(spark, "rse_protocols", [
        {"rse_id": "2", "scheme": "root", "hostname": "h", "prefix": "/p0", "write_lan": "1"},
        {"rse_id": "2", "scheme": "davs", "hostname": "h", "prefix": "/p1", "write_lan": "1"},
        {"rse_id": "2", "scheme": "srm", "hostname": "h", "prefix": "/p2", "write_lan": "0"},
    ])
    return bad, reps, table(spark, "rses", RSES), protocols


def test_suspicious_files_window_protocols_and_stored_path(spark):
    bad, reps, rses, protocols = _suspicious_inputs(spark)
    out = rows(incidents.suspicious_files(bad, reps, rses, protocols, START, END), "name", "path")
    h1 = hashlib.md5(b"mc16:f1").hexdigest()
    h3 = hashlib.md5(b"mc16:f3").hexdigest()
    assert [(r["name"], r["path"]) for r in out] == [
        ("f1", f"davs://h/p1/mc16/{h1[:2]}/{h1[2:4]}/f1"),
        ("f1", f"root://h/p0/mc16/{h1[:2]}/{h1[2:4]}/f1"),
        ("f3", f"davs://h/p1/mc16/{h3[:2]}/{h3[2:4]}/f3"),
        ("f3", f"root://h/p0/mc16/{h3[:2]}/{h3[2:4]}/f3"),
        ("f4", None),
    ]
    kept = rows(incidents.suspicious_files(bad, reps, rses, protocols, START, END, keep_stored_path=True), "path")
    assert {r["path"] for r in kept if r["name"] == "f4"} == {"root://h/p0/stored/f4", "davs://h/p1/stored/f4"}


def test_replicas_per_rse_paths_and_copies(spark):
    reps = table(spark, "replicas", [
        {"scope": "user.a.b", "name": "f", "rse_id": "1", "state": "A", "created_at": 86_400_000},
        {"scope": "mc16", "name": "f1", "rse_id": "1", "state": "A"},
        {"scope": "mc16", "name": "f1", "rse_id": "9", "state": "A"},  # unknown element: counted, not listed
        {"scope": "mc16", "name": "e", "rse_id": "1", "state": "U", "path": ""},
    ])
    out = {r["name"]: r for r in rows(replicas.replicas_per_rse(reps, table(spark, "rses", RSES)))}
    assert set(out) == {"f", "f1", "e"}
    h = hashlib.md5(b"user.a.b:f").hexdigest()
    assert out["f"]["path"] == f"/user/a/b/{h[:2]}/{h[2:4]}/f"
    assert str(out["f"]["created_at"]) == "1970-01-02 00:00:00"
    assert out["f1"]["path"] == "/mc16/45/fc/f1" and out["f1"]["copies"] == 2
    assert out["e"]["path"] == "" and out["e"]["copies"] == 0
    assert list(replicas.replicas_per_rse(reps, table(spark, "rses", RSES)).columns) == list(replicas.COLUMNS)


def _locks(spark):
    return table(spark, "dslocks", [
        {"scope": "d", "name": "ds", "rse_id": "1", "account": "b", "state": "O", "created_at": 2, "rule_id": "r2"},
        {"scope": "d", "name": "ds", "rse_id": "1", "account": "a", "state": "O", "created_at": 1, "rule_id": "r1"},
        {"scope": "d", "name": "ds", "rse_id": "2", "account": "c", "state": "O", "created_at": 5, "rule_id": "r3"},
        {"scope": "d", "name": "gone", "rse_id": "1", "account": "a", "state": "O", "created_at": 1, "rule_id": "r"},
        {"scope": "d", "name": "ds", "rse_id": "2", "account": "x", "state": "S", "created_at": 0, "rule_id": "rx"},
    ])


def test_consistency_datasets(spark):
    dids = table(spark, "dids", [{"scope": "d", "name": "ds", "bytes": None}])
    out = rows(consistency.consistency_datasets(_locks(spark), table(spark, "rses", RSES), dids), "rse")
    assert [(r["rse"], r["accounts"], r["rule_ids"], r["bytes"], r["count"]) for r in out] == [
        ("A", "a,b", "r1,r2", 0, 2), ("B", "c", "r3", 0, 2)]


def test_consistency_datasets_full_wildcards(spark):
    locks = table(spark, "dslocks", [
        {"scope": "d", "name": n, "rse_id": "1", "state": "O"} for n in ("x_dis1", "adis", "dis1", "dis1", "my_sub2")])
    out = rows(consistency.consistency_datasets_full(locks, table(spark, "rses", RSES)))
    assert [r["name"] for r in out] == ["dis1", "dis1"]


def test_datasets_per_rse(spark):
    cr = table(spark, "collection_replicas", [
        {"scope": "d", "name": "free", "rse_id": "1", "did_type": "D", "available_bytes": None, "state": "A"},
        {"scope": "d", "name": "ds", "rse_id": "2", "did_type": "D", "available_bytes": 7, "state": "U"},
        {"scope": "d", "name": "cont", "rse_id": "1", "did_type": "C", "available_bytes": 1, "state": "A"},
    ])
    locks = table(spark, "dslocks", [
        {"scope": "d", "name": "ds", "rse_id": "2", "account": None, "state": "S", "created_at": 1, "rule_id": "r1"},
        {"scope": "d", "name": "ds", "rse_id": "2", "account": "b", "state": "O", "created_at": 2, "rule_id": "r2"},
    ])
    out = {r["name"]: r for r in rows(datasets.datasets_per_rse(cr, locks, table(spark, "rses", RSES)))}
    assert set(out) == {"free", "ds"}
    assert (out["free"]["account"], out["free"]["rule_id"], out["free"]["bytes"]) == ("None", "", 0)
    assert (out["ds"]["account"], out["ds"]["rule_id"], out["ds"]["bytes"]) == ("b", "r1,r2", 7)


def test_datasets_per_rse_shared_element_name(spark):
    rses = table(spark, "rses", [{"id": "1", "rse": "A"}, {"id": "2", "rse": "A"}])
    cr = table(spark, "collection_replicas", [
        {"scope": "d", "name": "ds", "rse_id": "1", "did_type": "D", "available_bytes": 3, "state": "A"},
        {"scope": "d", "name": "ds", "rse_id": "2", "did_type": "D", "available_bytes": 5, "state": "U"},
    ])
    locks = table(spark, "dslocks", [
        {"scope": "d", "name": "ds", "rse_id": "2", "account": "b", "created_at": 2, "rule_id": "r2"},
        {"scope": "d", "name": "ds", "rse_id": "1", "account": "a", "created_at": 1, "rule_id": "r1"},
    ])
    out = rows(datasets.datasets_per_rse(cr, locks, rses))
    assert [(r["rse"], r["account"], r["rule_id"], r["bytes"], r["state"]) for r in out] == [("A", "a,b", "r1,r2", 5, "U")]


def test_datasets_per_rse_hot_key_and_repeated_replicas(spark):
    """One key with thousands of locks, its replica twice in the dump: every lock is listed once per replica row."""
    n = 3000
    locks = [{"scope": "s", "name": "hot", "rse_id": "1", "account": f"a{i}", "rule_id": f"r{i:05d}", "created_at": i} for i in range(n)]
    replica = {"scope": "s", "name": "hot", "rse_id": "1", "did_type": "D", "available_bytes": 5, "state": "A"}
    cold = {**replica, "name": "cold"}
    out = rows(datasets.datasets_per_rse(table(spark, "collection_replicas", [replica, replica, cold]), table(spark, "dslocks", locks),
                                         table(spark, "rses", [{"id": "1", "rse": "D1", "rse_type": "DISK"}])), "name")
    assert [(r["name"], r["account"][:9], r["rule_id"] == "") for r in out] == [("cold", "None", True), ("hot", "a0,a0,a1,", False)]
    assert out[1]["rule_id"] == ",".join(f"r{i:05d}" for i in range(n) for _ in range(2))
