"""Joins of fact tables to dimension tables, broadcast only behind a size check.

Storage elements, their protocols and their attributes are dimension tables:
their size follows the number of sites (thousands), not the number of files.

``profile`` measures a dimension in one small job: its bytes and, apart from
that, whether a key is unique. A join hints a broadcast of the *dimension* only
if its bytes are within the bound. Beyond it no hint is given and the planner
chooses: it broadcasts a side only under ``spark.sql.autoBroadcastJoinThreshold``
(AQE re-decides from measured sizes), else sort-merge. The hint matters: left
to estimates alone, the planner may broadcast a small-looking *fact* side when
the dimension is a derived frame whose estimate is inflated, and then run the
join in a few tasks. A job profiles each dimension once and passes the result.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parameter: bytes of a dimension that every executor can hold comfortably.
DIMENSION_MAX_BYTES = 64 << 20
_ROW_OVERHEAD = 64


class Profile(NamedTuple):
    """What a job knows about a dimension: small enough to broadcast, key values unique."""

    small: bool
    unique: bool


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in memory: texts by their length, everything else as 8, and an overhead."""
    size = F.lit(_ROW_OVERHEAD)
    for f in df.schema.fields:
        text = isinstance(f.dataType, (T.StringType, T.BinaryType))
        size = size + (F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if text else F.lit(8))
    return size


def profile(dim: DataFrame, key: str, max_bytes: int = DIMENSION_MAX_BYTES) -> Profile:
    """One small job over the dimension: does it fit the bound, is ``key`` unique (and never NULL)."""
    r = dim.agg(F.coalesce(F.sum(row_bytes(dim)), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n"),
                F.count_distinct(F.col(key)).alias("k"), F.count(F.col(key)).alias("nk")).first()
    return Profile(r["bytes"] <= max_bytes, r["k"] == r["nk"] == r["n"])


def fits(df: DataFrame, max_bytes: int = DIMENSION_MAX_BYTES) -> bool:
    """True if ``df`` holds at most ``max_bytes``."""
    return (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= max_bytes


def join_dimension(fact: DataFrame, dim: DataFrame, on: Column | list[str] | str, how: str = "inner",
                   small: bool | None = None) -> DataFrame:
    """Join a fact table to a dimension table; ``small`` is an earlier check's result (None: checked here)."""
    if small is None:
        small = fits(dim)
    return fact.join(F.broadcast(dim) if small else dim, on, how)


def keep_matching(big: DataFrame, few: DataFrame, on: Mapping[str, str], max_bytes: int = DIMENSION_MAX_BYTES) -> DataFrame:
    """Rows of ``big`` whose keys may occur in ``few``, filtered at its scan (``on``: column of ``big`` -> of ``few``).

    A semi-join against the broadcast 64-bit hashes of the few keys, if these are
    within ``max_bytes`` (measured by one job over ``few``); else ``big`` as it is. For joins of a
    fact table with a selection so small that the fact rows need not be shuffled for it, at sizes
    where no automatic broadcast happens. Hashes may collide, so the exact join still follows.
    """
    keys = few.select(F.xxhash64(*on.values()).alias("_wanted")).distinct()
    if not fits(keys, max_bytes):
        return big
    return big.join(F.broadcast(keys), F.xxhash64(*on.keys()) == F.col("_wanted"), "left_semi")
