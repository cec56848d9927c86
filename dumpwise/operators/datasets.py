"""Dataset replicas per storage element, locked or not (R3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpwise.functions.epoch import ms_to_timestamp
from dumpwise.functions.lists import joined_field
from dumpwise.plans.hot import HOT_ROWS, ordered_lists
from dumpwise.plans.joins import Profile, profile

# Dataset DID type; text shown for a dataset replica without lock accounts.
DATASET = "D"
NO_ACCOUNT = "None"

COLUMNS = ("rse", "scope", "name", "account", "bytes", "created_at", "updated_at", "accessed_at", "rule_id",
           "state")


def datasets_per_rse(collection_replicas: DataFrame, dslocks: DataFrame, rses: DataFrame,
                     element_profile: Profile | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per dataset replica with the accounts and rules locking it (any lock state).

    ``account`` lists lock accounts in lock-creation order (``None`` when there
    are none), ``rule_id`` the rules (empty text when none); each list skips
    its own NULLs. ``bytes`` is the replica's available bytes (NULL as 0),
    ``state`` the largest replica state, times are timestamps. Columns: ``COLUMNS``.

    Plan: locks become one list per (scope, name, rse_id) first (a partial,
    map-side aggregate; a hot key ships lists, not rows), so the left join is
    one-to-one unless replicas repeat and a replica's columns are not repeated
    per lock. A key with ``hot_rows`` locks or more (found by a sketch) is listed in
    segments of lock time; its list is the report's content and one row in the end. The
    element join is a broadcast. When element names are unique (checked on the
    element table in the same small job as its size), grouping by (scope, name,
    rse_id, rse) equals grouping by (scope, name, rse) and reuses the join's
    hash partitioning instead of shuffling again; otherwise rows group by name.
    """
    keys = ["scope", "name", "rse_id"]
    reps = collection_replicas.filter(F.col("did_type") == DATASET).select(
        *keys, "available_bytes", "state", "created_at", "accessed_at", "updated_at")
    locks = ordered_lists(dslocks, keys, "created_at", ["rule_id", "account"], min_rows=hot_rows)
    joined = reps.join(locks, keys, "left")
    elements = rses.select(F.col("id").alias("rse_id"), "rse")
    small, unique_names = element_profile or profile(rses, "rse")
    located = joined.join(F.broadcast(elements) if small else elements, "rse_id")
    group_keys = ["scope", "name", "rse_id", "rse"] if unique_names else ["scope", "name", "rse"]
    grouped = located.groupBy(*group_keys).agg(
        F.sort_array(F.flatten(F.collect_list("locks"))).alias("locks"),
        F.max("available_bytes").alias("bytes"),
        F.min("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"),
        F.max("accessed_at").alias("accessed_at"),
        F.max("state").alias("state"),
    )
    accounts = joined_field("locks", "account")
    return grouped.select(
        "rse", "scope", "name",
        F.when(accounts == "", F.lit(NO_ACCOUNT)).otherwise(accounts).alias("account"),
        F.coalesce(F.col("bytes"), F.lit(0)).cast("bigint").alias("bytes"),
        ms_to_timestamp("created_at").alias("created_at"),
        ms_to_timestamp("updated_at").alias("updated_at"),
        ms_to_timestamp("accessed_at").alias("accessed_at"),
        joined_field("locks", "rule_id").alias("rule_id"),
        "state",
    )
