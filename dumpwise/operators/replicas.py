"""Replica inventory per storage element (R4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dumpwise.functions.epoch import ms_to_timestamp
from dumpwise.functions.paths import deterministic_path
from dumpwise.plans.joins import Profile, join_dimension

# An available replica.
AVAILABLE = "A"

COLUMNS = ("rse", "scope", "name", "adler32", "bytes", "created_at", "path", "updated_at", "state",
           "accessed_at", "tombstone", "copies")


def replicas_per_rse(replicas: DataFrame, rses: DataFrame, copies_by_window: bool = False,
                     element_profile: Profile | None = None) -> DataFrame:
    """One row per replica on a known storage element, with its path and number of available copies.

    ``path`` is the stored path, or the deterministic path when none is stored
    (an empty stored path counts as stored). ``copies`` counts available
    replicas of the file over *all* replicas, also those on unknown elements.
    Times become timestamps. Columns: ``COLUMNS``.

    The copy count is a partial (map-side) count per file joined back to the
    replicas (left outer). A file with a huge number of copies ships one
    partial count per map task, and in the join its replica rows sit on the
    side AQE's skew handling splits. ``copies_by_window=True`` counts with a
    window over the file's replicas instead (one shuffle fewer, but a window
    partition cannot be split: it relies on a file having at most one replica
    per element).
    """
    elements = rses.select(F.col("id").alias("rse_id"), "rse")
    small = element_profile and element_profile.small
    if copies_by_window:
        # The window must see replicas on unknown elements too: count first, then join the elements.
        per_file = Window.partitionBy("scope", "name")
        counted = replicas.withColumn(
            "copies", F.count(F.when(F.col("state") == AVAILABLE, F.lit(1))).over(per_file))
        located = join_dimension(counted, elements, "rse_id", small=small)
    else:
        # Counts cover all replicas; rows on unknown elements drop (broadcast join) before the shuffle.
        counts = replicas.filter(F.col("state") == AVAILABLE).groupBy("scope", "name").agg(
            F.count(F.lit(1)).alias("n_available"))
        located = join_dimension(replicas, elements, "rse_id", small=small).join(counts, ["scope", "name"], "left").withColumn(
            "copies", F.coalesce(F.col("n_available"), F.lit(0)))
    return located.select(
        "rse", "scope", "name", "adler32", "bytes",
        ms_to_timestamp("created_at").alias("created_at"),
        F.coalesce(F.col("path"), deterministic_path("scope", "name")).alias("path"),
        ms_to_timestamp("updated_at").alias("updated_at"),
        "state",
        ms_to_timestamp("accessed_at").alias("accessed_at"),
        ms_to_timestamp("tombstone").alias("tombstone"),
        "copies",
    )
