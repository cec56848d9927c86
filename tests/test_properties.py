"""Property tests: random inputs, one Spark job per example batch, checked against Python formulations."""

from __future__ import annotations

import hashlib
import json
import math
import re

from catalogue_rows import rows, table
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dumpwise.functions import deterministic_path
from dumpwise.operators import accounting, incidents
from dumpwise.operators.space_usage import space_usage_violations
from dumpwise.plans import joins

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

words = st.text(alphabet="abcXY.:_-19", min_size=1, max_size=8)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["user.", "group.", "mc", "us", "x.y"]), words, words), min_size=1,
                max_size=40))
def test_deterministic_path_matches_python(spark, pairs):
    data = [(p + s, n) for p, s, n in pairs]
    df = spark.createDataFrame(data, "scope string, name string")
    got = [r[0] for r in df.select(deterministic_path("scope", "name")).collect()]
    want = []
    for scope, name in data:
        h = hashlib.md5(f"{scope}:{name}".encode()).hexdigest()
        d = scope.replace(".", "/") if scope.startswith(("user", "group")) else scope
        want.append(f"/{d}/{h[:2]}/{h[2:4]}/{name}")
    assert got == want


@SETTINGS
@given(st.lists(st.integers(min_value=-5_000, max_value=5_000), min_size=1, max_size=60),
       st.integers(min_value=-4, max_value=4), st.integers(min_value=0, max_value=4))
def test_incident_window_matches_truncated_seconds(spark, ms_values, start, width):
    end = start + width
    bad = table(spark, "bad_replicas", [{"scope": "s", "name": f"f{i}", "rse_id": "1", "state": "L",
                                         "created_at": ms} for i, ms in enumerate(ms_values)])
    got = sorted(r["name"] for r in rows(incidents.declared_between(bad, "L", start, end)))
    want = sorted(f"f{i}" for i, ms in enumerate(ms_values) if start <= math.trunc(ms / 1000) < end)
    assert got == want


scopes = st.sampled_from(["a", "a.b", "panda", "z", "b:x", None])
names = st.sampled_from(["z", "c", "x", "y", None])


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), scopes, names), max_size=30),
       st.lists(st.tuples(st.integers(0, 7), st.sampled_from(["1", "2"]), st.booleans()), min_size=1, max_size=20))
def test_owner_per_file_matches_plain_python(spark, parents, replicas):
    rses = table(spark, "rses", [{"id": "1", "rse": "D1", "rse_type": "DISK"},
                                 {"id": "2", "rse": "D1", "rse_type": "TAPE"}])
    meta = table(spark, "rse_metadata", [{"rse_id": i, "key": "type", "value": "DATADISK"} for i in ("1", "2")])
    reps = table(spark, "replicas", [{"scope": "s", "name": f"f{f}", "rse_id": r, "bytes": f,
                                      "tombstone": 1 if t else None} for f, r, t in replicas])
    cont = table(spark, "contents", [{"scope": s, "name": n, "did_type": "D", "child_scope": "s",
                                      "child_name": f"f{f}", "child_type": "F"} for f, s, n in parents])
    classified = accounting.classified_replicas(reps, accounting.accounted_rses(rses, meta))
    want = {}
    for f, r, t in replicas:
        of_file = [(s or "no_scope", n or "no_name") for g, s, n in parents if g == f]
        owners = [o for o in of_file if o[0] != "panda"] if of_file else [("no_scope", "no_name")]
        if owners:
            owner = min(owners, key=lambda o: f"{o[0]}:{o[1]}")
            kind, rse_type = ("secondary" if t else "primary"), {"1": "DISK", "2": "TAPE"}[r]
            old = want.get(f"f{f}", (*owner, 0, "", ""))
            want[f"f{f}"] = (*owner, f, max(old[3], kind), max(old[4], rse_type))
    got = accounting.attribute_to_dataset(classified, cont).collect()
    assert {r["fname"]: (r["dscope"], r["dname"], r["bytes"], r["type"], r["rse_type"]) for r in got} == want
    assert len(got) == len(want)


# --- site documents against a small independent validator ------------------------------------

_NAME = re.compile(r"^([A-Z0-9]+([_-][A-Z0-9]+)*)$")
_REQUIRED = ["status", "status_message", "total_space", "used_space", "time_stamp", "list_of_paths"]


def _is_int(v):
    return not isinstance(v, bool) and (isinstance(v, int) or (isinstance(v, float) and v.is_integer()))


def _python_rules(text):
    try:
        doc = json.loads(text, object_pairs_hook=_no_duplicates)
    except ValueError:
        return {(None, "invalid_json")}
    if not isinstance(doc, dict):
        return {(None, "root_not_object")}
    out = set()
    for k, v in doc.items():
        if not _NAME.search(k):
            out.add((k, "bad_token_name"))
        elif not isinstance(v, dict):
            out.add((k, "value_not_object"))
        else:
            out |= {(k, f"missing_{f}") for f in _REQUIRED if f not in v}
            checks = {"status": lambda x: isinstance(x, str), "status_message": lambda x: isinstance(x, str),
                      "total_space": _is_int, "used_space": _is_int, "num_files": _is_int, "time_stamp": _is_int,
                      "list_of_paths": lambda x: isinstance(x, list)}
            out |= {(k, f"type_{f}") for f, ok in checks.items() if f in v and not ok(v[f])}
            if "status" in v and v["status"] not in ("online", "offline"):
                out.add((k, "enum_status"))
            paths = v.get("list_of_paths")
            if isinstance(paths, list) and not all(isinstance(p, str) for p in paths):
                out.add((k, "item_type_list_of_paths"))
    return out


def _no_duplicates(pairs):
    keys = [k for k, _ in pairs]
    if len(keys) != len(set(keys)):
        raise ValueError("duplicate key")
    return dict(pairs)


values = st.one_of(st.none(), st.booleans(), st.integers(-10, 10**12), st.sampled_from([1.0, 1.5, 1e3, -2.0]),
                   st.sampled_from(["online", "offline", "down", "5", ""]),
                   st.lists(st.one_of(st.text(max_size=3), st.integers(0, 3), st.none()), max_size=3))
token_value = st.one_of(
    st.dictionaries(st.sampled_from(_REQUIRED + ["num_files", "extra"]), values, max_size=8),
    values)
documents = st.one_of(
    st.dictionaries(st.sampled_from(["SITE1", "SITE_2", "A-B", "lower", "A__B", "_X", "9"]), token_value, max_size=3)
    .map(json.dumps),
    st.sampled_from(["{bad", "[]", "null", "3", '"x"']))


@SETTINGS
@given(st.lists(documents, min_size=1, max_size=25))
def test_space_usage_rules_match_python_validator(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in space_usage_violations(df).collect():
        got.setdefault(r["doc_id"], set()).add((r["token"], r["rule"]))
    for i, text in enumerate(texts):
        assert got.get(i, set()) == _python_rules(text), text


def test_dimension_over_bound_is_not_broadcast(spark):
    fact = spark.range(50).select(F.col("id").cast("string").alias("k"))
    dim = spark.range(10).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v"))
    size = dim.agg(F.sum(joins.row_bytes(dim))).first()[0]
    assert joins.fits(dim, size) and not joins.fits(dim, size - 1)
    assert joins.profile(dim, "k", size) == (True, True) and joins.profile(dim, "v", size - 1) == (False, False)
    hinted = joins.join_dimension(fact, dim, "k")
    plain = joins.join_dimension(fact, dim, "k", small=False)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in plain._jdf.queryExecution().analyzed().toString().lower()
    assert hinted.count() == plain.count() == 10


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(-20, 8), st.integers(0, 99)), min_size=1,
                max_size=40),
       st.integers(0, 15), st.integers(0, 6))
def test_latest_reports_matches_brute_force(spark, reports, back, ahead):
    import datetime as dt

    from dumpwise.operators import lookup

    as_of = dt.date(2026, 12, 1)
    data = [(r, (as_of + dt.timedelta(days=d)).isoformat(), v) for r, d, v in reports]
    df = spark.createDataFrame(data, "rse string, date string, v int")
    got = sorted(tuple(r) for r in lookup.latest_reports(df, as_of, back=back, ahead=ahead).collect())
    lo, hi = (as_of - dt.timedelta(days=back)).isoformat(), (as_of + dt.timedelta(days=ahead)).isoformat()
    inside = [x for x in data if lo <= x[1] <= hi]
    newest = {}
    for r, d, _ in inside:
        newest[r] = max(newest.get(r, d), d)
    want = sorted(x for x in inside if x[1] == newest[x[0]])
    assert got == want
