"""Site space-usage reports: typed rows (R12) and schema violations (R13).

A site publishes one JSON document mapping space-token names to objects. What a
token must look like is said by a JSON Schema text (``SITE_SCHEMA``, or the caller's),
compiled into Columns (``functions.json_schema``); typed columns and rules both come from
it. Documents are parsed once as VARIANT; tokens come from exploding the root
object. Validation reports **every** broken rule per document and token (not just
the first), in one narrow pass: parse, explode tokens, build the list of broken
rules, explode it. No shuffle.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpwise.functions.json_schema import Schema, compile_schema, get, is_type, known_member, member_rules, typed

# The schema of a site report.
SITE_SCHEMA = """
{"type": "object",
 "patternProperties": {
  "^([A-Z0-9]+([_-][A-Z0-9]+)*)$": {
   "type": "object",
   "properties": {
    "status": {"type": "string", "enum": ["online", "offline"]},
    "status_message": {"type": "string"},
    "total_space": {"type": "integer"},
    "used_space": {"type": "integer"},
    "num_files": {"type": "integer"},
    "time_stamp": {"type": "integer"},
    "list_of_paths": {"type": "array", "items": {"type": "string"}}},
   "required": ["status", "status_message", "total_space", "used_space", "time_stamp", "list_of_paths"]}},
 "additionalProperties": false}
"""


@functools.lru_cache(maxsize=16)
def _schema(text: str) -> Schema:
    """A schema of reports: an object whose members (tokens) are objects with one schema per name pattern."""
    schema = compile_schema(text)
    if schema.types != ("object",) or schema.properties or schema.required or not schema.patterns:
        raise ValueError("a report schema maps token names to objects: type object with patternProperties")
    if any(s.types != ("object",) for s in schema.patterns.values()):
        raise ValueError("the tokens of a report schema must be of type object")
    return schema


def _tokens(reports: DataFrame, doc_col: str, text_col: str) -> DataFrame:
    """One row per (document, token); a document whose root is no object keeps one row with NULL token."""
    parsed = reports.select(F.col(doc_col).alias("doc"), F.try_parse_json(F.col(text_col)).alias("v"))
    entries = F.try_variant_get(F.col("v"), "$", "map<string,variant>")
    return parsed.select(
        "doc",
        F.col("v").isNull().alias("invalid"),
        is_type(F.col("v"), "object").alias("root_is_object"),
        F.explode_outer(entries).alias("token", "value"),
    )


def space_usage(reports: DataFrame, doc_col: str = "doc_id", text_col: str = "text", schema: str = SITE_SCHEMA) -> DataFrame:
    """One typed row per well-named token whose value is an object.

    A field of the wrong type is NULL. Columns: ``doc_col, token`` and the
    schema's properties in their order (a list is NULL unless every item has the
    item type). A property of several name patterns is typed by the first that has it.
    """
    root = _schema(schema)
    tokens = _tokens(reports, doc_col, text_col).filter(
        known_member(F.col("token"), root) & is_type(F.col("value"), "object"))
    fields: dict[str, Schema] = {}
    for s in root.patterns.values():
        fields = s.properties | fields if fields else dict(s.properties)
    cols = [typed(get(F.col("value"), f), s).alias(f) for f, s in fields.items()]
    return tokens.select(F.col("doc").alias(doc_col), "token", *cols)


def _token_rules(token: Column, value: Column, root: Schema) -> Column:
    """Broken rules of a well-named token's object, by the schema of each pattern its name has."""
    rules: list[Column] = []
    for pattern, schema in root.patterns.items():
        rules += [F.when(token.rlike(pattern), r) for r in member_rules(value, schema)]
    return F.array_distinct(F.filter(F.array(*rules), lambda r: r.isNotNull()))


def space_usage_violations(reports: DataFrame, doc_col: str = "doc_id", text_col: str = "text", schema: str = SITE_SCHEMA) -> DataFrame:
    """One row per broken rule: ``doc_col, token, rule`` (token NULL for document-level rules).

    Rules: ``invalid_json, root_not_object, bad_token_name`` (where the schema allows no
    other members), ``value_not_object`` and those of the schema's fields, for ``SITE_SCHEMA``
    ``missing_<field>, type_<field>, range_<field>, enum_status, item_type_list_of_paths``.
    ``range_<field>``: an integer beyond 64 bits, which R12 shows as NULL.
    A value that is not an object gets only ``value_not_object``; a badly named
    token only ``bad_token_name`` (its value is not checked). Of duplicate keys
    the last one counts (a session setting, see ``session.prepare``).
    """
    root = _schema(schema)
    t = _tokens(reports, doc_col, text_col)
    token, value, none = F.col("token"), F.col("value"), F.array().cast("array<string>")
    doc_level = F.when(F.col("invalid"), F.array(F.lit("invalid_json"))).when(
        ~F.col("root_is_object"), F.array(F.lit("root_not_object")))
    token_level = (
        F.when(token.isNull(), none)
        .when(~known_member(token, root), none if root.additional else F.array(F.lit("bad_token_name")))
        .when(~is_type(value, "object"), F.array(F.lit("value_not_object")))
        .otherwise(_token_rules(token, value, root))
    )
    rules = F.coalesce(doc_level, token_level)
    return t.select(F.col("doc").alias(doc_col), "token", F.explode(rules).alias("rule"))
