"""Every registered query against its DuckDB oracle (the driver's check, at sf0.001)."""

from __future__ import annotations

import duckdb
import pytest
from catalogue_rows import SF_SMALL

import __spark_entry__ as entry
from dumpwise.plans import registry
from checks.compare import TABLES, as_text, canon


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(registry.QUERIES) <= set(entry.queries()) and set(registry.ORACLES) <= set(entry.oracle_sql())
    assert len(registry.QUERIES) == 21


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert canon(got) == canon(want)
    # the same pandas dtypes and the same text, so any value hash agrees
    assert {c: str(t) for c, t in got.dtypes.items()} == {c: str(t) for c, t in want.dtypes.items()}
    assert as_text(got) == as_text(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 54 and df.count() > 0
