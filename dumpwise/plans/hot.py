"""Hot keys, found at run time: keys with so many rows that one task should not hold them.

``hot_keys`` runs one frequent-items sketch over the keys' hashes (Spark's
``approx_top_k``: a partial aggregate of bounded size per task, no shuffle of rows).
Every key with more than 1 / 49,000 of all rows is in it; a key it names wrongly only
takes the split path, which is exact for any key. Callers split those keys'
rows off and leave all others on the plain path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpwise.functions.lists import sorted_pairs

# Parameters: rows from which a key is hot, entries of a sketch, and hot keys returned at most (the most frequent).
HOT_ROWS = 1_000_000
SKETCH_ENTRIES = 65_536
MOST_KEYS = 1_000


def hot_keys(rows: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> list[int]:
    """Hashes of the keys with about ``min_rows`` rows or more (one small job, an answer of at most ``MOST_KEYS`` numbers)."""
    sketch = F.expr(f"approx_top_k(_key, {MOST_KEYS}, {SKETCH_ENTRIES})")
    found = rows.select(F.xxhash64(*keys).alias("_key")).agg(sketch.alias("top")).first()["top"] or []
    return [x["item"] for x in found if x["count"] >= min_rows]


def is_hot(keys: Sequence[str], hot: Sequence[int]) -> Column:
    return F.xxhash64(*keys).isin(list(hot))


def ordered_lists(rows: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], extra: Mapping[str, Column] | None = None,
                  hot: Sequence[int] | None = None, min_rows: int = HOT_ROWS) -> DataFrame:
    """Per key ``locks``: the ascending list of ``struct(order as k, *values)``, and the ``extra`` minima and maxima.

    ``extra`` maps a column of ``rows`` to an aggregate of it that may be taken in two steps. The rows of
    hot keys (``hot``, or found here) are cut into ranges of (key, order, values), each range is
    aggregated and sorted by a task of its own, and the sorted segments of a key are only put
    together in the end, so no task reads a hot key's rows and none sorts its list.
    """
    keys, extra = list(keys), dict(extra or {})
    if hot is None:
        hot = hot_keys(rows, keys, min_rows)
    pairs = sorted_pairs(order, *values).alias("locks")
    aggs = [a.alias(c) for c, a in extra.items()]
    if not hot:
        return rows.groupBy(*keys).agg(pairs, *aggs)
    split = F.coalesce(is_hot(keys, hot), F.lit(False))
    plain = rows.where(~split).groupBy(*keys).agg(pairs, *aggs)
    ranges = rows.where(split).repartitionByRange(*keys, order, *values).withColumn("_range", F.spark_partition_id())
    segments = ranges.groupBy(*keys, "_range").agg(pairs, *aggs)
    in_order = F.array_sort(F.collect_list(F.struct("_range", "locks")))
    joined = F.flatten(F.transform(in_order, lambda s: s["locks"])).alias("locks")
    return plain.unionByName(segments.groupBy(*keys).agg(joined, *aggs))
