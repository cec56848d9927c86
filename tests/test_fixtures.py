"""The derived test catalogue reproduces the row counts published in FIXTURES.md section 2."""

from __future__ import annotations

import pytest
from catalogue_rows import SF_MEDIUM, SF_SMALL
from pyspark.sql import functions as F

from dumpwise.operators import accounting, incidents
from dumpwise.sources.fixtures import FixtureCatalog

# FIXTURES.md section 2, (sf0.001, sf0.01).
COUNTS = {
    "rses": (10, 100), "rse_metadata": (19, 189), "rse_protocols": (15, 150), "replicas": (1905, 51731),
    "contents": (3789, 37714), "contents_history": (5961, 59961), "bad_replicas": (1968, 20046),
    "dslocks": (3333, 34118), "collection_replicas": (4951, 58785), "dids": (1384, 13873),
}


@pytest.mark.parametrize("sf,i", [(SF_SMALL, 0), (SF_MEDIUM, 1)])
def test_view_row_counts(spark, sf, i):
    c = FixtureCatalog(spark, sf)
    for view, expected in COUNTS.items():
        assert c[view].count() == expected[i], view
    assert c.replicas.filter(F.col("path").isNotNull()).count() == (380, 10364)[i]
    assert c.dslocks.filter(F.col("state") == "O").count() == (2270, 22739)[i]
    assert c.collection_replicas.filter(F.col("did_type") == "D").count() == (4315, 51368)[i]


def test_derived_counts(spark):
    c = FixtureCatalog(spark, SF_SMALL)
    lost = incidents.lost_files(c.bad_replicas, c.contents_history, c.rses, -(10**12), 10**12)
    assert lost.count() == 25379
    ok = c.dslocks.filter(F.col("state") == "O").join(c.rses, c.dslocks["rse_id"] == c.rses["id"])
    assert ok.groupBy("scope", "name", "rse").count().filter("count > 1").count() == 168
    parents = accounting._file_parents(c.contents)
    only_panda = parents.groupBy("fscope", "fname").agg(F.min(F.col("dscope") == "panda").alias("p")).filter("p")
    assert only_panda.count() == 5
