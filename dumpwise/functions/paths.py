"""Storage path and URL expressions (built-in Column expressions, no UDF).

A replica without a stored path lives at its *deterministic* path:
``/<scope'>/<h1>/<h2>/<name>`` where ``h1 h2`` are the first two bytes of
MD5(``scope:name``) in lower-case hex and ``scope'`` is the scope with every
``.`` turned into ``/`` for user and group scopes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scope prefixes whose dots become directory levels.
SPLIT_SCOPE_PREFIXES = ("user", "group")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scope_directory(scope: Column | str) -> Column:
    scope = _c(scope)
    split = F.lit(False)
    for prefix in SPLIT_SCOPE_PREFIXES:
        split = split | scope.startswith(prefix)
    return F.when(split, F.replace(scope, F.lit("."), F.lit("/"))).otherwise(scope)


def deterministic_path(scope: Column | str, name: Column | str) -> Column:
    """``/<scope'>/<md5[0:2]>/<md5[2:4]>/<name>``; NULL if scope or name is NULL."""
    scope, name = _c(scope), _c(name)
    digest = F.md5(F.concat(scope, F.lit(":"), name))
    return F.concat(
        F.lit("/"), scope_directory(scope),
        F.lit("/"), F.substring(digest, 1, 2),
        F.lit("/"), F.substring(digest, 3, 2),
        F.lit("/"), name,
    )


def _text(c: Column) -> Column:
    # String formatting of a missing value prints the word null.
    return F.coalesce(c, F.lit("null"))


def protocol_prefix(scheme: Column | str, hostname: Column | str, prefix: Column | str) -> Column:
    """``scheme://hostname<prefix>``, a NULL part printed as ``null``."""
    return F.concat(_text(_c(scheme)), F.lit("://"), _text(_c(hostname)), _text(_c(prefix)))


def url_path(prefix: Column | str, scope: Column | str, name: Column | str) -> Column:
    """Protocol prefix followed by the deterministic path."""
    return F.concat(_c(prefix), deterministic_path(scope, name))


def prefixed_path(prefix: Column | str, path: Column | str) -> Column:
    """Protocol prefix followed by a stored path."""
    return F.concat(_text(_c(prefix)), _text(_c(path)))
