"""Report lookup (R10, R11) and site space-usage documents (R12, R13)."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from catalogue_rows import rows

from dumpwise.operators import lookup
from dumpwise.operators.space_usage import space_usage, space_usage_violations

AS_OF = dt.date(2026, 12, 1)


def _reports(spark):
    def d(days):
        return (AS_OF + dt.timedelta(days=days)).isoformat()
    data = [("A", d(-13), 1), ("A", d(-14), 2), ("B", d(-14), 3), ("C", d(5), 4), ("C", d(-2), 5), ("C", d(-2), 6)]
    return spark.createDataFrame(data, "rse string, date string, v int")


def test_latest_reports_window(spark):
    got = {(r["rse"], r["v"]) for r in rows(lookup.latest_reports(_reports(spark), AS_OF))}
    assert got == {("A", 1), ("C", 5), ("C", 6)}
    ahead = {(r["rse"], r["v"]) for r in rows(lookup.latest_reports(
        _reports(spark), AS_OF, back=lookup.REPLICA_BACK_DAYS, ahead=lookup.REPLICA_AHEAD_DAYS))}
    assert ahead == {("C", 4)}
    one = {(r["rse"], r["v"]) for r in rows(lookup.latest_reports(_reports(spark), AS_OF, rse="A"))}
    assert one == {("A", 1)}


def test_report_slice(spark):
    day = (AS_OF - dt.timedelta(days=2)).isoformat()
    assert {r["v"] for r in rows(lookup.report_slice(_reports(spark), day, "C"))} == {5, 6}
    full = _reports(spark).selectExpr("date", "v * 10 as v")
    assert {r["v"] for r in rows(lookup.report_slice(_reports(spark), day, "*", full=full))} == {50, 60}
    with pytest.raises(ValueError):
        lookup.report_slice(_reports(spark), day, "*")
    assert rows(lookup.report_slice(_reports(spark), day, "A")) == []


def _incidents(spark):
    rows_ = [("RSE_A", "2026-11-25", 1), ("RSE_B", "2026-11-30", 2), ("RSE_B", "2026-11-30", 3), ("RSE_C", "2026-10-01", 4)]
    return spark.createDataFrame(rows_, "rse string, date string, v int")


def test_newest_whole_report(spark):
    """A whole report is looked up by date only: elements of an older one must not show up."""
    index = spark.createDataFrame([("2026-11-25", None), ("2026-11-30", None)], "date string, rse string")
    for extra in ({}, {"index": index}):
        got = rows(lookup.latest_reports(_incidents(spark), AS_OF, rse_col=None, **extra))
        assert {r["v"] for r in got} == {2, 3}
    empty = spark.createDataFrame([("2026-11-30", None), ("2026-12-01", None)], "date string, rse string")
    assert rows(lookup.latest_reports(_incidents(spark), AS_OF, rse_col=None, index=empty)) == []


def test_full_listing_mark(spark):
    full = spark.createDataFrame([("2026-11-29", "x"), ("2026-11-30", "y")], "date string, name string")
    assert [r["name"] for r in rows(lookup.latest_reports(_reports(spark), AS_OF, rse="*", full=full))] == ["y"]
    with pytest.raises(ValueError):
        lookup.latest_reports(_reports(spark), AS_OF, rse="*")


def _token(**over):
    v = {"status": "online", "status_message": "fine", "total_space": 50, "used_space": 12, "num_files": 3,
         "time_stamp": 1447936989, "list_of_paths": ["/a/"]}
    v.update(over)
    return {k: x for k, x in v.items() if x is not _DROP}


_DROP = object()


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_valid_sample_gives_rows_and_no_violations(spark):
    doc = json.dumps({"SITEDISK": _token(), "SITE_SCRATCH": _token(status="offline", num_files=_DROP),
                      "SITE-TAPE": _token()})
    docs = _docs(spark, [doc])
    out = rows(space_usage(docs), "token")
    assert [r["token"] for r in out] == ["SITE-TAPE", "SITEDISK", "SITE_SCRATCH"]
    assert out[2]["num_files"] is None and out[2]["status"] == "offline" and out[1]["list_of_paths"] == ["/a/"]
    assert rows(space_usage_violations(docs)) == []


def test_violations(spark):
    cases = [
        ("{bad", {(None, "invalid_json")}),
        ("[]", {(None, "root_not_object")}),
        (json.dumps({"lower": _token(), "A__B": _token(), "_A": _token()}),
         {("lower", "bad_token_name"), ("A__B", "bad_token_name"), ("_A", "bad_token_name")}),
        ('{"A": 1}', {("A", "value_not_object")}),
        (json.dumps({"A": _token(time_stamp=_DROP)}), {("A", "missing_time_stamp")}),
        (json.dumps({"A": _token(status="down")}), {("A", "enum_status")}),
        (json.dumps({"A": _token(total_space="5")}), {("A", "type_total_space")}),
        (json.dumps({"A": _token(total_space=1.5)}), {("A", "type_total_space")}),
        (json.dumps({"A": _token(total_space=True)}), {("A", "type_total_space")}),
        ('{"A": {"status": "online", "status_message": "", "total_space": 1.0, "used_space": 1e3, '
         '"time_stamp": -1, "list_of_paths": [], "extra": 1}}', set()),
        (json.dumps({"A": _token(list_of_paths="x")}), {("A", "type_list_of_paths")}),
        (json.dumps({"A": _token(list_of_paths=["x", 1])}), {("A", "item_type_list_of_paths")}),
        (json.dumps({"A": _token(list_of_paths=[None])}), {("A", "item_type_list_of_paths")}),
        (json.dumps({"A": _token(used_space=10**3, total_space=1)}), set()),
        ('{"A": 1, "A": ' + json.dumps(_token()) + '}', set()),
        (json.dumps({"A": _token(total_space=2**63 - 1)}), set()),
        (json.dumps({"A": _token(total_space=2**63, used_space=-10**20)}), {("A", "range_total_space"), ("A", "range_used_space")}),
        (json.dumps({"A": _token(status=None)}), {("A", "type_status"), ("A", "enum_status")}),
    ]
    out = rows(space_usage_violations(_docs(spark, [c[0] for c in cases])))
    for i, (_, expected) in enumerate(cases):
        assert {(r["token"], r["rule"]) for r in out if r["doc_id"] == i} == expected, cases[i][0]


OTHER_SCHEMA = """
{"type": "object", "title": "queues",
 "patternProperties": {
  "^q[0-9]+$": {"type": "object", "additionalProperties": false, "required": ["depth", "mode"],
   "properties": {
    "depth": {"type": "integer", "minimum": 0, "maximum": 100},
    "mode": {"type": ["string", "null"], "enum": ["fifo", "lifo", null], "description": "order"},
    "rate": {"type": "number"}, "on": {"type": "boolean"}, "level": {"enum": [1, 2.5, true, "x"]},
    "tag": {"type": "string", "pattern": "^[a-z]+$"},
    "sizes": {"type": "array", "items": {"type": "integer", "minimum": 1}},
    "owner": {"type": "object", "required": ["name"], "properties": {"name": {"type": "string"}}}}}},
 "additionalProperties": true}
"""


def test_rules_come_from_the_schema_text(spark):
    cases = [
        ('{"q1": {"depth": 1, "mode": "fifo"}, "free": 7}', set()),
        ('{"q1": {"depth": 3.0, "mode": null, "rate": 1.5, "on": true, "level": 2.5, "tag": "ab", "sizes": [1, 2], "owner": {"name": "n"}}}', set()),
        ('{"q1": {}}', {"missing_depth", "missing_mode"}),
        ('{"q1": 5}', {"value_not_object"}),
        ('{"q1": {"depth": -1, "mode": "x"}}', {"minimum_depth", "enum_mode"}),
        ('{"q1": {"depth": 101, "mode": 4}}', {"maximum_depth", "type_mode", "enum_mode"}),
        ('{"q1": {"depth": "1", "mode": null, "rate": "2", "on": 1}}', {"type_depth", "type_rate", "type_on"}),
        ('{"q1": {"depth": 1, "mode": null, "level": 1}}', set()),
        ('{"q1": {"depth": 1, "mode": null, "level": true}}', set()),
        ('{"q1": {"depth": 1, "mode": null, "level": false}}', {"enum_level"}),
        ('{"q1": {"depth": 1, "mode": null, "tag": "A"}}', {"pattern_tag"}),
        ('{"q1": {"depth": 1, "mode": null, "sizes": [1, "2"]}}', {"item_type_sizes"}),
        ('{"q1": {"depth": 1, "mode": null, "sizes": [0]}}', {"item_broken_sizes"}),
        ('{"q1": {"depth": 1, "mode": null, "owner": {}}}', {"missing_owner.name"}),
        ('{"q1": {"depth": 1, "mode": null, "owner": {"name": 1}}}', {"type_owner.name"}),
        ('{"q1": {"depth": 1, "mode": null, "owner": []}}', {"type_owner"}),
        ('{"q1": {"depth": 1, "mode": null, "extra": 1}}', {"unknown_member"}),
    ]
    out = rows(space_usage_violations(_docs(spark, [c[0] for c in cases]), schema=OTHER_SCHEMA))
    for i, (text, expected) in enumerate(cases):
        assert {r["rule"] for r in out if r["doc_id"] == i} == expected, text
    typed = rows(space_usage(_docs(spark, [cases[1][0], cases[6][0]]), schema=OTHER_SCHEMA), "doc_id")
    assert (typed[0]["depth"], typed[0]["rate"], typed[0]["on"], typed[0]["tag"], typed[0]["sizes"]) == (3, 1.5, True, "ab", [1, 2])
    assert (typed[1]["depth"], typed[1]["rate"], typed[1]["on"]) == (None, None, None)


@pytest.mark.parametrize("text", ['{"type": "array"}', '{"type": "object", "patternProperties": {"a": {"type": "string"}}}', '[]',
                                  '{"type": "object", "patternProperties": {"a": {"type": "object", "oneOf": []}}}', '{"type": "objekt"}'])
def test_schemas_that_are_not_understood_are_refused(spark, text):
    with pytest.raises(ValueError):
        space_usage_violations(_docs(spark, ["{}"]), schema=text)
