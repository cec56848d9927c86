"""Helpers of the report tests (a module of its own: every test folder may have its own conftest)."""

from __future__ import annotations

from dumpwise.sources.catalog import SCHEMAS

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


def table(spark, name: str, rows: list[dict]):
    """A catalogue table from hand-made rows (missing columns are NULL)."""
    schema = SCHEMAS[name]
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def rows(df, *order):
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[k] is None, r[k]) for k in order))
    return out
