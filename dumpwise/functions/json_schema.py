"""JSON Schema texts compiled into Columns over VARIANT values.

``compile_schema`` reads a schema and gives the broken rules of a value as one
array Column, so a table of documents is validated in one narrow pass and every
broken rule is reported, not only the first. Understood: ``type`` (one or several),
``enum``, ``properties``, ``patternProperties``, ``additionalProperties`` (true or
false), ``required``, ``items``, ``minimum``, ``maximum``, ``pattern``; annotations
(``title``, ``description``, ``$schema``, ``$id``, ``default``, ``examples``) are passed
over. Any other keyword is an error: a rule must not be dropped in silence.

Names of rules, with the path of the field (``a.b``): ``missing_<f>``, ``type_<f>``,
``range_<f>`` (an integer beyond 64 bits, which typed rows cannot hold), ``enum_<f>``,
``minimum_<f>``, ``maximum_<f>``, ``pattern_<f>``, ``unknown_<f>`` (an object has members
its schema does not allow; ``unknown_member`` of a report's token), ``member_<f>`` (a member
breaks the schema of its name's pattern), ``item_type_<f>`` and ``item_broken_<f>`` (of any item). A value of the wrong type breaks
``type`` (and ``enum``) alone. Integers follow JSON Schema: a number without
fractional part (``1.0`` and ``1e3`` are integers, ``1.5`` and ``true`` are not).
"""

from __future__ import annotations

import functools
import json
import operator
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

ANNOTATIONS = {"title", "description", "$schema", "$id", "$comment", "default", "examples"}
TYPES = {"object", "array", "string", "integer", "number", "boolean", "null"}
KEYWORDS = {"type", "enum", "properties", "patternProperties", "additionalProperties", "required", "items", "minimum", "maximum", "pattern"}

_INTEGER_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT")
_FLOAT_TYPES = ("DOUBLE", "FLOAT")


class Schema(NamedTuple):
    """A checked schema node."""

    types: tuple[str, ...]
    enum: tuple | None
    properties: dict[str, Schema]
    patterns: dict[str, Schema]
    additional: bool
    required: tuple[str, ...]
    items: Schema | None
    minimum: float | None
    maximum: float | None
    pattern: str | None


def compile_schema(text: str) -> Schema:
    """The schema of ``text``; ValueError for anything that is not understood."""
    return _node(json.loads(text), "schema")


def _node(raw: dict, where: str) -> Schema:
    if not isinstance(raw, dict):
        raise ValueError(f"{where}: a schema must be an object")
    odd = set(raw) - KEYWORDS - ANNOTATIONS
    types = raw.get("type", [])
    types = tuple([types] if isinstance(types, str) else types)
    if odd or set(types) - TYPES:
        raise ValueError(f"{where}: not understood: {sorted(odd | (set(types) - TYPES))}")
    if not isinstance(raw.get("additionalProperties", True), bool):
        raise ValueError(f"{where}: additionalProperties must be true or false")
    for value in raw.get("enum", []):
        if isinstance(value, (list, dict)):
            raise ValueError(f"{where}: enum values must be plain")
    under = lambda key: {k: _node(v, f"{where}.{k}") for k, v in raw.get(key, {}).items()}
    for name in raw.get("properties", {}):
        if "'" in name:
            raise ValueError(f"{where}: the name {name!r} cannot be addressed")
    return Schema(
        types, tuple(raw["enum"]) if "enum" in raw else None, under("properties"), under("patternProperties"), raw.get("additionalProperties", True),
        tuple(raw.get("required", ())), _node(raw["items"], f"{where}[]") if "items" in raw else None, raw.get("minimum"), raw.get("maximum"), raw.get("pattern"),
    )


# ------------------------------------------------------------------ types of a VARIANT value


def kind_of(x: Column) -> Column:
    return F.schema_of_variant(x)


def is_type(x: Column, name: str) -> Column:
    """Whether the value has the JSON type ``name`` (never NULL; false where there is no value)."""
    t = kind_of(x)
    if name in ("object", "array"):
        found = t.startswith(name.upper())
    elif name in ("integer", "number"):
        whole = t.startswith("DECIMAL(") & t.endswith(",0)") if name == "integer" else t.startswith("DECIMAL(")
        floats = t.isin(*_FLOAT_TYPES)
        if name == "integer":
            floats = floats & ((F.try_variant_get(x, "$", "double") % 1) == 0)
        found = t.isin(*_INTEGER_TYPES) | whole | floats
    else:
        found = t == {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}[name]
    return F.coalesce(found, F.lit(False))


def _any(parts: list[Column]) -> Column:
    return functools.reduce(operator.or_, parts, F.lit(False))


def get(v: Column, field: str) -> Column:
    return F.try_variant_get(v, f"$['{field}']", "variant")


def _equals(x: Column, value) -> Column:
    if value is None:
        return is_type(x, "null")
    if isinstance(value, bool):
        return is_type(x, "boolean") & (F.try_variant_get(x, "$", "boolean") == value)
    if isinstance(value, str):
        return is_type(x, "string") & (F.try_variant_get(x, "$", "string") == value)
    return is_type(x, "number") & (F.try_variant_get(x, "$", "double") == float(value))


# ------------------------------------------------------------------------------ rules


def broken_rules(x: Column, schema: Schema, path: str) -> list[Column]:
    """Texts of the rules that the value ``x`` at ``path`` breaks: each Column is the text or NULL. No value breaks none."""
    there = x.isNotNull()
    rules: list[Column] = []

    def rule(name: str, broken: Column) -> None:
        rules.append(F.when(there & F.coalesce(broken, F.lit(False)), F.lit(f"{name}_{path}")))

    if schema.types:
        rule("type", ~_any([is_type(x, t) for t in schema.types]))
    if "integer" in schema.types:
        rule("range", is_type(x, "integer") & F.try_variant_get(x, "$", "bigint").isNull())
    if schema.enum is not None:
        rule("enum", ~_any([F.coalesce(_equals(x, v), F.lit(False)) for v in schema.enum]))
    number, text = F.try_variant_get(x, "$", "double"), F.try_variant_get(x, "$", "string")
    if schema.minimum is not None:
        rule("minimum", is_type(x, "number") & (number < schema.minimum))
    if schema.maximum is not None:
        rule("maximum", is_type(x, "number") & (number > schema.maximum))
    if schema.pattern is not None:
        rule("pattern", is_type(x, "string") & ~text.rlike(schema.pattern))
    if schema.items is not None:
        items = F.try_variant_get(x, "$", "array<variant>")
        for name, broken in _item_rules(schema.items):
            rule(f"item_{name}", is_type(x, "array") & F.exists(items, broken))
    rules += member_rules(x, schema, path + ".")
    return rules


def _item_rules(schema: Schema) -> Iterator[tuple[str, Callable[[Column], Column]]]:
    """(name, predicate) of what may be wrong with an item (its own members: ``broken``)."""
    if schema.types:
        yield "type", lambda i: ~_any([is_type(i, t) for t in schema.types])
    rest = schema._replace(types=())
    if rest != schema._replace(types=(), enum=None, properties={}, patterns={}, additional=True, required=(), items=None, minimum=None, maximum=None, pattern=None):
        yield "broken", lambda i: _any([r.isNotNull() for r in broken_rules(i, rest, "item")])


def member_rules(v: Column, schema: Schema, prefix: str = "") -> list[Column]:
    """Broken rules of an object's members, named with ``prefix`` (nothing is broken where ``v`` is no object)."""
    if not (schema.properties or schema.patterns or schema.required or not schema.additional):
        return []
    here = is_type(v, "object")
    rules = [F.when(here & get(v, f).isNull(), F.lit(f"missing_{prefix}{f}")) for f in schema.required]
    for f, inner in schema.properties.items():
        rules += [F.when(here, r) for r in broken_rules(get(v, f), inner, prefix + f)]
    members = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    name = prefix.rstrip(".") or "member"
    for pattern, inner in schema.patterns.items():
        rules.append(F.when(here & F.exists(members, _breaks(pattern, inner)), F.lit(f"member_{name}")))
    if not schema.additional:
        rules.append(F.when(here & F.exists(members, lambda e: ~known_member(e["key"], schema)), F.lit(f"unknown_{name}")))
    return rules


def _breaks(pattern: str, schema: Schema) -> Callable[[Column], Column]:
    """Whether a map entry has a name of ``pattern`` and a value that breaks ``schema``."""
    return lambda e: e["key"].rlike(pattern) & _any([r.isNotNull() for r in broken_rules(e["value"], schema, "value")])


def known_member(key: Column, schema: Schema) -> Column:
    """Whether a member of this name has a schema of its own."""
    return _any([key == f for f in schema.properties] + [key.rlike(p) for p in schema.patterns])


# ------------------------------------------------------------------------------- typed


def typed(x: Column, schema: Schema) -> Column:
    """The value in its Spark type (string, bigint, double, boolean, lists of them; else VARIANT); NULL where it is of another type."""
    spark = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}
    kinds = [t for t in schema.types if t != "null"]
    if len(kinds) == 1 and kinds[0] in spark:
        return F.when(is_type(x, kinds[0]), F.try_variant_get(x, "$", spark[kinds[0]]))
    inner = [t for t in schema.items.types if t != "null"] if kinds == ["array"] and schema.items else []
    if len(inner) == 1 and inner[0] in spark:
        whole = F.forall(F.try_variant_get(x, "$", "array<variant>"), lambda i: is_type(i, inner[0]))
        return F.when(is_type(x, "array") & F.coalesce(whole, F.lit(False)), F.try_variant_get(x, "$", f"array<{spark[inner[0]]}>"))
    return x
