from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from dumpwise.functions import deterministic_path, document_id, grouped_datatype, protocol_prefix


def _one(spark, expr, **cols):
    names = list(cols)
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{n} string" for n in names))
    return df.select(expr.alias("x")).first()["x"]


def test_deterministic_path_known_value(spark):
    assert hashlib.md5(b"mc16:f1").hexdigest().startswith("45fc04b2")
    assert _one(spark, deterministic_path("scope", "name"), scope="mc16", name="f1") == "/mc16/45/fc/f1"


def test_deterministic_path_splits_user_and_group_scopes(spark):
    for scope, first in [("user.a.b", "user/a/b"), ("group.x", "group/x"), ("mc.16", "mc.16")]:
        h = hashlib.md5(f"{scope}:n".encode()).hexdigest()
        got = _one(spark, deterministic_path("scope", "name"), scope=scope, name="n")
        assert got == f"/{first}/{h[:2]}/{h[2:4]}/n"


def test_protocol_prefix_prints_null(spark):
    got = _one(spark, protocol_prefix("a", "b", "c"), a="root", b=None, c="/data")
    assert got == "root://null/data"


def test_document_id_null_name(spark):
    got = _one(spark, document_id("d", "s", "n"), d="2026-12-01", s="mc16", n=None)
    assert got == hashlib.sha1(b"2026-12-01_mc16_null").hexdigest().upper()


# Expected labels: a project with a label decides; otherwise the datatype's label.
PROJECT_LABELS = {
    None: None, "": None, "panda": "panda", "pandax": None, "user.a": "user", "archive9": "archive", "data07x": "data07",
    "sit": "sit", "hc_test": "hc_test", "hc_testx": None, "group": "group", "cond": "cond", "transient": "transient",
    "mc16": None,
}
DATATYPE_LABELS = {
    None: "no_name", "": "", "DAOD_X": "DAOD", "HIST": "HIST", "DESD_1": "DESD", "DPD": "DPD", "RDO": "RDO", "NTUP": "NTUP",
    "DRAW": "RAW", "DNTUP": "DNTUP", "D2ESD": "D2ESD", "D2AOD": "D2AOD", "CALIB_RAW": "RAW", "RAW": "RAW", "AOD": "AOD",
    "DAODRAW": "DAOD", "HISTRAW": "HIST",
}


def test_grouped_datatype_edges(spark):
    cases = [(None, "DRAW_X", "RAW"), (None, "DAOD_RAW", "DAOD"), (None, "X_RAW", "RAW"), (None, None, "no_name"),
             ("transient", "HIST", "transient"), ("user.x", "DRAW", "user"), ("panda", "AOD", "panda"),
             ("mc16", "NTUP_RAW", "NTUP"), ("hc_test", None, "hc_test"), ("cond_x", "DAOD_PHYS", "cond")]
    df = spark.createDataFrame([(p, d) for p, d, _ in cases], "project string, datatype string")
    got = [r["g"] for r in df.select(grouped_datatype("project", "datatype").alias("g")).collect()]
    assert got == [e for *_, e in cases]


def test_grouped_datatype_labels(spark):
    pairs = [(p, d) for p in PROJECT_LABELS for d in DATATYPE_LABELS]
    df = spark.createDataFrame(pairs, "project string, datatype string")
    got = [r["g"] for r in df.select(grouped_datatype("project", "datatype").alias("g")).collect()]
    assert got == [PROJECT_LABELS[p] or DATATYPE_LABELS[d] for p, d in pairs]


def test_epoch_helpers(spark):
    from dumpwise.functions import ms_to_seconds

    df = spark.createDataFrame([(1999,), (-1999,), (None,)], "ms long")
    assert [r[0] for r in df.select(ms_to_seconds(F.col("ms"))).collect()] == [1, -1, None]
