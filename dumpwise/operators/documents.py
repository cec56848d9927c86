"""Search-ready accounting documents (R8) and their delivery (R9)."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpwise.functions.documents import document_id, grouped_datatype
from dumpwise.sinks import write_documents

# Classes rolled up into each total (kind, tier).
ROLLUPS = {
    "total": [("primary", t) for t in ("t0", "t1", "t2")] + [("secondary", t) for t in ("t0", "t1", "t2")]
    + [("tape", t) for t in ("t0", "t1")],
    "disk": [("primary", t) for t in ("t0", "t1", "t2")] + [("secondary", t) for t in ("t0", "t1", "t2")],
    "primary": [("primary", t) for t in ("t0", "t1", "t2")],
    "secondary": [("secondary", t) for t in ("t0", "t1", "t2")],
    "tape": [("tape", t) for t in ("t0", "t1")],
}
FACTOR_ROLLUPS = ("primary", "secondary", "tape")
# Default index name prefix; the month is appended.
INDEX_PREFIX = "global-accounting-"


def _plus(cols: list[Column]) -> Column:
    # Plain addition: NULL when any part is NULL.
    return functools.reduce(operator.add, cols)


def rollup_columns() -> dict[str, Column]:
    out: dict[str, Column] = {}
    for measures in (("files", "accessed_files"), ("bytes", "accessed_bytes")):
        for group, parts in ROLLUPS.items():
            for m in measures:
                out[f"{group}_{m}"] = _plus([F.col(f"{kind}_{m}_{tier}") for kind, tier in parts])
    for group in FACTOR_ROLLUPS:
        out[f"{group}_repl_factor"] = _plus([F.col(f"{kind}_repl_factor_{tier}") for kind, tier in ROLLUPS[group]])
    return out


def accounting_documents(accounting: DataFrame, date: str) -> DataFrame:
    """The accounting report with 23 roll-ups, ``timestamp`` (= ``date``), ``id`` and ``datatype_grouped``.

    ``id`` is the upper-case hex SHA-1 of ``<date>_<scope>_<name>``. 80 columns.
    """
    stamp = F.lit(date)
    extra = {**rollup_columns(), "timestamp": stamp, "id": document_id(stamp, "scope", "name"),
             "datatype_grouped": grouped_datatype("project", "datatype")}
    return accounting.select("*", *[c.alias(n) for n, c in extra.items()])


def index_name(month: str, prefix: str = INDEX_PREFIX) -> str:
    return f"{prefix}{month}"


def deliver_documents(docs: DataFrame, target: str, fmt: str = "json", options: Mapping[str, str] | None = None,
                      date: str | None = None) -> None:
    """Deliver the documents of ``date`` to ``target`` (an index for a connector format, else a path).

    Delivering a date again replaces its documents: by date in files, by ``id`` in a store.
    """
    write_documents(docs, target, fmt, date=date, options=options)
