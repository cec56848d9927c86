from __future__ import annotations

import pytest


@pytest.fixture
def frame(spark):
    """A DataFrame from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
