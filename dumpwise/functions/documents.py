"""Expressions of the accounting documents: document id and grouped datatype."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Project rules of the grouped datatype, (test, value, label).
# A project rule beats every datatype rule; "transient" beats everything.
PROJECT_OVERRIDE = "transient"
PROJECT_RULES = (
    ("equals", "panda", "panda"),
    ("startswith", "user", "user"),
    ("startswith", "archive", "archive"),
    ("startswith", "data07", "data07"),
    ("startswith", "sit", "sit"),
    ("equals", "hc_test", "hc_test"),
    ("startswith", "group", "group"),
    ("startswith", "cond", "cond"),
)
# Datatype prefixes reported as the prefix (a label ending in RAW then reads RAW).
DATATYPE_PREFIXES = ("DAOD", "HIST", "DESD", "DPD", "RDO", "NTUP", "DRAW", "DNTUP", "D2ESD", "D2AOD")
# The suffix rule and the label of a missing datatype.
RAW_SUFFIX = "RAW"
NO_DATATYPE = "no_name"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def document_id(date: Column | str, scope: Column | str, name: Column | str) -> Column:
    """Upper-case hex SHA-1 of ``<date>_<scope>_<name>``; a NULL part reads ``null``."""
    parts = [F.coalesce(_c(x), F.lit("null")) for x in (date, scope, name)]
    return F.upper(F.sha1(F.concat(parts[0], F.lit("_"), parts[1], F.lit("_"), parts[2])))


def grouped_datatype(project: Column | str, datatype: Column | str) -> Column:
    """Coarse datatype label of a dataset, from its project and datatype."""
    project, datatype = _c(project), _c(datatype)
    out = F.when(project == PROJECT_OVERRIDE, F.lit(PROJECT_OVERRIDE))
    for test, value, label in PROJECT_RULES:
        cond = project == value if test == "equals" else project.startswith(value)
        out = out.when(cond, F.lit(label))
    # No datatype starts with two of the prefixes, so their order does not matter; a prefix
    # label is final unless it ends with the RAW suffix (DRAW), then it reads RAW.
    for prefix in DATATYPE_PREFIXES:
        label = RAW_SUFFIX if prefix.endswith(RAW_SUFFIX) else prefix
        out = out.when(datatype.startswith(prefix), F.lit(label))
    out = out.when(datatype.endswith(RAW_SUFFIX), F.lit(RAW_SUFFIX))
    return out.otherwise(F.coalesce(datatype, F.lit(NO_DATATYPE)))
