"""Ordered list fields (lists of accounts and rules in lock order).

A group's values are collected as one ``struct(order, values...)`` list
(``plans.hot.ordered_lists``), so paired lists (account, rule) keep their pairing even on
ties of the order key; each output list then drops its own NULLs, as a plain
``collect_list`` would. Ties on the order key are broken by the values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_pairs(order: str, *values: str) -> Column:
    """Aggregate: ascending (NULLs first) array of ``struct(order, *values)``."""
    return F.sort_array(F.collect_list(F.struct(F.col(order).alias("k"), *[F.col(v) for v in values])))


def joined_field(pairs: Column | str, field: str, sep: str = ",") -> Column:
    """``sep``-joined text of one struct field of a sorted pair list, NULLs skipped."""
    pairs = F.col(pairs) if isinstance(pairs, str) else pairs
    kept = F.filter(pairs, lambda p: p[field].isNotNull())
    return F.array_join(F.transform(kept, lambda p: p[field]), sep)
