"""Epoch-millisecond helpers.

Catalogue dumps store times as epoch milliseconds (LONG). Reports either keep
them raw, show them as timestamps (``ms / 1000`` cast to timestamp) or as whole
seconds (``ms / 1000`` truncated toward zero).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ms_to_timestamp(ms: Column | str) -> Column:
    """Seconds as a fraction, cast to TIMESTAMP (the report convention)."""
    return (_c(ms) / F.lit(1000)).cast("timestamp")


def ms_to_seconds(ms: Column | str) -> Column:
    """Whole epoch seconds, truncated toward zero."""
    return (_c(ms) / F.lit(1000)).cast("bigint")


def seconds_to_ms(seconds: int) -> int:
    """A window bound in seconds as the raw millisecond value stored in dumps."""
    return int(seconds) * 1000
