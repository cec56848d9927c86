"""Incident reports over declared bad replicas: lost files (R6) and suspicious files (R5).

Both take a half-open window ``[start, end)`` in epoch **seconds** on the
declaration time, which dumps store in milliseconds. The window is applied
twice: once as a slightly wider range on the raw millisecond column (pushed to
the file scan, so row groups outside the window are skipped) and once exactly
on truncated seconds, so results equal a filter on ``created_at / 1000`` even
for negative times.

The declared files are few beside the table they are joined with (replicas,
contents history): that table is filtered by them at its scan, before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpwise.functions.epoch import ms_to_seconds, seconds_to_ms
from dumpwise.functions.paths import prefixed_path, protocol_prefix, url_path
from dumpwise.plans.joins import Profile, join_dimension, keep_matching

# Bad replica states.
LOST = "L"
SUSPICIOUS = "S"
# Report columns, in file order.
LOST_COLUMNS = ("fscope", "fname", "scope", "name", "rse", "account", "updated_at")
SUSPICIOUS_COLUMNS = ("rse", "scope", "name", "path")
# A protocol usable for LAN writes.
WRITABLE = "1"


def declared_between(bad_replicas: DataFrame, state: str, start: int, end: int) -> DataFrame:
    """Bad replicas of ``state`` declared in ``[start, end)`` (seconds)."""
    ms = F.col("created_at")
    seconds = ms_to_seconds(ms)
    return bad_replicas.filter(
        (F.col("state") == state)
        & (ms > F.lit(seconds_to_ms(start) - 1000)) & (ms < F.lit(seconds_to_ms(end) + 1000))
        & (seconds >= F.lit(int(start))) & (seconds < F.lit(int(end)))
    )


def lost_files(bad_replicas: DataFrame, contents_history: DataFrame, rses: DataFrame,
               start: int, end: int, elements: Profile | None = None) -> DataFrame:
    """Files declared lost in ``[start, end)``, one row per dataset that ever held them.

    Columns: ``fscope, fname, scope, name, rse, account, updated_at`` (seconds).
    A lost file never attached to a dataset has no row; no distinct, no order.
    """
    lost = declared_between(bad_replicas, LOST, start, end).select(
        "scope", "name", "rse_id", "account", ms_to_seconds("updated_at").alias("updated_at"))
    # Storage element first: a broadcast join, so unknown elements drop before the big shuffle.
    lost = join_dimension(lost, rses.select(F.col("id").alias("rse_id"), "rse"), "rse_id",
                          small=elements and elements.small)
    parents = contents_history.filter(F.col("did_type") == "D")
    parents = keep_matching(parents, lost, {"child_scope": "scope", "child_name": "name"}).select(
        F.col("child_scope").alias("fscope"), F.col("child_name").alias("fname"), "scope", "name")
    files = lost.select(F.col("scope").alias("fscope"), F.col("name").alias("fname"), "rse", "account", "updated_at")
    return files.join(parents, ["fscope", "fname"]).select(*LOST_COLUMNS)


def suspicious_files(bad_replicas: DataFrame, replicas: DataFrame, rses: DataFrame, rse_protocols: DataFrame,
                     start: int, end: int, keep_stored_path: bool = False,
                     elements: Profile | None = None) -> DataFrame:
    """Distinct suspicious replicas in ``[start, end)`` with a full URL per writable protocol.

    Columns: ``rse, scope, name, path``. A replica without a stored path gets
    ``scheme://host<prefix>`` + its deterministic path. A replica *with* a
    stored path reports NULL, as the original job did; ``keep_stored_path=True``
    reports the protocol prefix + stored path instead. Each writable protocol
    of the element gives its own row. Order (rse, scope, name) is the sink's job.
    """
    keys = ["scope", "name", "rse_id"]
    # Many declarations of one replica collapse before the join (partial aggregate;
    # its hash partitioning on the join keys is reused by the join with replicas).
    suspicious = declared_between(bad_replicas, SUSPICIOUS, start, end).select(*keys).distinct()
    stored = keep_matching(replicas.select(*keys, F.col("path").alias("stored_path")), suspicious, {k: k for k in keys})
    with_path = suspicious.join(stored, keys)
    protocols = rse_protocols.filter(F.col("write_lan") == WRITABLE).select(
        "rse_id", protocol_prefix("scheme", "hostname", "prefix").alias("url_prefix"))
    with_url = join_dimension(with_path, protocols, "rse_id")
    kept = prefixed_path("url_prefix", "stored_path") if keep_stored_path else F.lit(None).cast("string")
    path = F.when(F.col("stored_path").isNull(), url_path("url_prefix", "scope", "name")).otherwise(kept)
    located = join_dimension(with_url, rses.select(F.col("id").alias("rse_id"), "rse"), "rse_id",
                             small=elements and elements.small)
    return located.select("rse", "scope", "name", path.alias("path")).distinct()
