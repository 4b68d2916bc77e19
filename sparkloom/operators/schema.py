"""Records checked against a schema subset: $ref, type, enum, bounds, lengths, required, properties, items.

A schema is compiled to one expression over a VARIANT that gives the first error of a record, so
checking a table is a projection and nothing is parsed twice.  Booleans are no numbers, whole
decimals no integers; unknown keys are allowed.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TYPES = {
    "object": "schema_of_variant({v}) LIKE 'OBJECT%'",
    "array": "schema_of_variant({v}) LIKE 'ARRAY%'",
    "string": "schema_of_variant({v}) = 'STRING'",
    "integer": "schema_of_variant({v}) = 'BIGINT'",
    "number": "(schema_of_variant({v}) IN ('BIGINT', 'DOUBLE', 'FLOAT') OR schema_of_variant({v}) LIKE 'DECIMAL%')",
    "boolean": "schema_of_variant({v}) = 'BOOLEAN'",
    "null": "is_variant_null({v})",
}


def _quoted(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literal(v: str, x: Any) -> str:
    """Whether the value v equals one of an enum's values."""
    if x is None:
        return f"is_variant_null({v})"
    if isinstance(x, bool):
        return f"({_TYPES['boolean'].format(v=v)} AND try_variant_get({v}, '$', 'boolean') = {str(x).lower()})"
    if isinstance(x, (int, float)):
        return f"({_TYPES['number'].format(v=v)} AND try_variant_get({v}, '$', 'double') = {float(x)!r}D)"
    return f"({_TYPES['string'].format(v=v)} AND try_variant_get({v}, '$', 'string') = {_quoted(x)})"


def first_error(v: str, schema: Mapping[str, Any], refs: Mapping[str, Mapping[str, Any]], path: str = "'$'", depth: int = 0) -> str:
    """SQL for the first error of the VARIANT expression v as 'path rule', or null.

    The order is that of the rules below; a $ref is looked up in refs and replaces its schema.
    """
    while "$ref" in schema:
        schema = refs[schema["$ref"]]
    checks: list[str] = []

    def unless(good: str, rule: str) -> None:
        checks.append(f"CASE WHEN NOT coalesce({good}, false) THEN concat({path}, ' {rule}') END")

    if "type" in schema:
        types = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        unless("(" + " OR ".join(_TYPES.get(t, "true").format(v=v) for t in types) + ")", "type")
    if "enum" in schema:
        unless("(" + " OR ".join(_literal(v, x) for x in schema["enum"]) + ")", "enum")
    number, string = _TYPES["number"].format(v=v), _TYPES["string"].format(v=v)
    for rule, sign in (("minimum", "<"), ("maximum", ">")):
        if rule in schema:
            checks.append(f"CASE WHEN {number} AND try_variant_get({v}, '$', 'double') {sign} {float(schema[rule])!r}D THEN concat({path}, ' {rule}') END")
    if "minLength" in schema:
        checks.append(f"CASE WHEN {string} AND length(try_variant_get({v}, '$', 'string')) < {int(schema['minLength'])} THEN concat({path}, ' minLength') END")
    is_object = _TYPES["object"].format(v=v)
    field = lambda name: f"try_variant_get({v}, {_quoted('$.' + name)}, 'variant')"
    for name in schema.get("required", ()):
        checks.append(f"CASE WHEN {is_object} AND {field(name)} IS NULL THEN concat({path}, {_quoted('.' + name)}, ' required') END")
    for name, sub in (schema.get("properties") or {}).items():
        if isinstance(sub, Mapping):
            inner = first_error(field(name), sub, refs, f"concat({path}, {_quoted('.' + name)})", depth + 1)
            checks.append(f"CASE WHEN {is_object} AND {field(name)} IS NOT NULL THEN {inner} END")
    if isinstance(schema.get("items"), Mapping):
        x, i = f"x{depth}", f"i{depth}"
        inner = first_error(x, schema["items"], refs, f"concat({path}, '[', {i}, ']')", depth + 1)
        errors = f"transform(try_variant_get({v}, '$', 'array<variant>'), ({x}, {i}) -> {inner})"
        checks.append(f"CASE WHEN {_TYPES['array'].format(v=v)} THEN get(filter({errors}, e -> e IS NOT NULL), 0) END")
    return f"coalesce({', '.join(checks)}, cast(null AS string))" if checks else "cast(null AS string)"


def validate_json(rows: DataFrame, column: str, schema: Mapping[str, Any], refs: Mapping[str, Mapping[str, Any]] | None = None) -> DataFrame:
    """rows with `invalid`: the first error of the JSON text in `column`, '$ parse' for what is no JSON, null for what is valid."""
    parsed = rows.withColumn("__variant", F.try_parse_json(column))
    error = F.expr(first_error("__variant", schema, refs or {}))
    return parsed.withColumn("invalid", F.when(F.col("__variant").isNull(), F.lit("$ parse")).otherwise(error)).drop("__variant")
