"""Dataset consistency reports from dataset locks (R1, R2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dumpwise.functions.lists import joined_field
from dumpwise.plans.hot import HOT_ROWS, ordered_lists
from dumpwise.plans.joins import Profile, join_dimension

# An OK lock; name patterns left out of the full listing (``_`` is a one-character wildcard).
LOCK_OK = "O"
FULL_EXCLUDED_PATTERNS = ("%_dis%", "%_sub%")

COLUMNS = ("rse", "scope", "name", "accounts", "bytes", "created_at", "accessed_at", "rule_ids", "count",
           "updated_at")
FULL_COLUMNS = ("rse", "scope", "name")


def ok_locks(dslocks: DataFrame, rses: DataFrame, elements: Profile | None = None) -> DataFrame:
    """OK locks with their storage element name (inner: unknown elements drop)."""
    locks = dslocks.filter(F.col("state") == LOCK_OK)
    return join_dimension(locks, rses.select(F.col("id").alias("rse_id"), "rse"), "rse_id", small=elements and elements.small)


def consistency_datasets(dslocks: DataFrame, rses: DataFrame, dids: DataFrame,
                         elements: Profile | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per (storage element, dataset) with OK locks: accounts and rules in lock order, size, times,
    and ``count`` = number of storage elements holding an OK lock on the dataset.

    ``bytes`` is the dataset's size from ``dids`` (NULL as 0); datasets missing
    from ``dids`` have no row. Times stay raw epoch ms. Columns: ``COLUMNS``.

    Plan: locks aggregate per (scope, name, rse) map-side, those with ``hot_rows`` locks
    or more (found by a sketch) in segments of lock time; the element count is
    a window over each dataset's groups (at most one row per element) and the
    join to ``dids`` reuses that window's partitioning by (scope, name).
    """
    times = {"created_at": F.min("created_at"), "accessed_at": F.max("accessed_at"), "updated_at": F.max("updated_at")}
    grouped = ordered_lists(ok_locks(dslocks, rses, elements), ["scope", "name", "rse"], "created_at", ["rule_id", "account"], times,
                            min_rows=hot_rows)
    counted = grouped.withColumn("count", F.count(F.lit(1)).over(Window.partitionBy("scope", "name")))
    sizes = dids.select("scope", "name", F.coalesce(F.col("bytes"), F.lit(0)).cast("bigint").alias("bytes"))
    return counted.join(sizes, ["scope", "name"]).select(
        "rse", "scope", "name",
        joined_field("locks", "account").alias("accounts"),
        "bytes", "created_at", "accessed_at",
        joined_field("locks", "rule_id").alias("rule_ids"),
        "count", "updated_at",
    )


def consistency_datasets_full(dslocks: DataFrame, rses: DataFrame, elements: Profile | None = None) -> DataFrame:
    """(rse, scope, name) of every OK lock, not distinct, without ``_dis``/``_sub`` names.

    Order (rse, scope, name) is applied by the sink.
    """
    rows = ok_locks(dslocks, rses, elements).select(*FULL_COLUMNS)
    for pattern in FULL_EXCLUDED_PATTERNS:
        rows = rows.filter(~F.col("name").like(pattern))
    return rows
