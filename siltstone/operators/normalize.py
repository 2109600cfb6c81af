"""Raw lines to typed records and rejects, in one narrow pass.

Each line is trimmed, parsed once with only the declared keys kept (as VARIANT,
so that ``2``, ``2.0`` and ``"2"`` stay different), checked rule by rule and
projected to the stored columns. A line that breaks any rule gets a reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import coerce, ids
from siltstone.schema import DEFAULT_FALSE, NULLABLE, OPTIONAL, Entity, Rule

SENTINEL = "~"
_JSON_OPTIONS = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"


def trim_line(value: str) -> str:
    """Drop everything before the first and after the last brace; empty if there is none.

    Most lines need no trimming and skip the pattern.
    """
    return f"""CASE
        WHEN startswith({value}, '{{') AND endswith({value}, '}}') THEN {value}
        ELSE regexp_extract({value}, r'(?s)[{{}}](?:.*[{{}}])?', 0)
    END"""


def parse_pair(line: str, keys: list[str]) -> str:
    """One JSON line to an array: the object with VARIANT fields, then a sentinel.

    Spark's parsers stop after the first value and would take ``{..}{..}``. The
    line is therefore placed in an array in front of a second object carrying the
    line's own hash; see :func:`whole_object`.
    """
    fields = ", ".join(f"`{k}`: variant" for k in [*keys, SENTINEL])
    wrapped = f"""concat('[', {line}, ',{{"{SENTINEL}":', cast(xxhash64({line}) AS string), '}}]')"""
    return f"from_json({wrapped}, 'array<struct<{fields}>>', {_JSON_OPTIONS})"


def whole_object(pair: str, line: str) -> str:
    """The object, or NULL unless the line was exactly one object.

    Only then are there two elements with the right hash in the second.
    """
    found = f"try_variant_get(get({pair}, 1).`{SENTINEL}`, '$', 'bigint')"
    return f"CASE WHEN size({pair}) = 2 AND {found} = xxhash64({line}) THEN get({pair}, 0) END"


def repeats_a_key(found: str, keys: list[str]) -> str:
    """True when one of ``keys`` occurs twice in the ``json_object_keys`` of a line."""
    listed = ", ".join(f"'{k}'" for k in keys)
    known = f"filter({found}, k -> k IN ({listed}))"
    return f"""CASE
        WHEN size({found}) = size(array_distinct({found})) THEN false
        ELSE size({known}) <> size(array_distinct({known}))
    END"""


def _value(rule: Rule) -> str:
    """The rule's coercion; NULL when the value does not fit."""
    v, kind, text = f"_v_{rule.key}", f"_k_{rule.key}", f"_t_{rule.key}"
    if rule.kind == "string":
        return text
    if rule.kind == "bool":
        return coerce.boolean(v, kind)
    if rule.kind in ("int8", "int32", "uint32", "int64"):
        return coerce.integer(v, kind, rule.kind)
    if rule.kind in ("time", "loose_time"):
        return coerce.time(v, kind)
    if rule.kind == "score":
        return coerce.score(v, kind)
    if rule.kind == "ref":
        return coerce.reference(text, v, kind)
    if rule.kind == "uuid":
        return coerce.uuid(text)
    if rule.kind == "enum":
        return coerce.canonical(text, rule.values)
    raise ValueError(f"unknown kind {rule.kind}")


def _problem(rule: Rule) -> str:
    """Reason text when the field breaks its rule, else NULL.

    The type name is NULL for a missing key and VOID for a JSON null.
    """
    kind, value = f"_k_{rule.key}", f"_x_{rule.key}"
    if rule.kind == "ref":
        value += ".decoded_parent_id"
    unfit = f"{value} IS NULL"
    harmless = []
    if rule.presence in (NULLABLE, OPTIONAL):
        harmless.append("'VOID'")
    if rule.kind == "loose_time":
        harmless.append("'BOOLEAN'")
    if harmless:
        unfit += f" AND ({kind} IS NULL OR {kind} NOT IN ({', '.join(harmless)}))"
    if rule.presence in (OPTIONAL, DEFAULT_FALSE):
        return f"CASE WHEN {kind} IS NOT NULL AND {unfit} THEN 'invalid {rule.key}' END"
    return (
        f"CASE WHEN {kind} IS NULL THEN 'missing {rule.key}' "
        f"WHEN {unfit} THEN 'invalid {rule.key}' END"
    )


def _pinned(expression: str) -> str:
    """The expression, computed in the step that names it.

    Filters on the reason would otherwise be rewritten into filters on the whole
    parse and coercion, repeated below every step. A row number never below zero
    makes the step non-deterministic to the optimizer, which then leaves it be.
    """
    return f"CASE WHEN monotonically_increasing_id() >= 0 THEN {expression} END"


def _stored_values(rule: Rule) -> list[str]:
    if rule.stored is None:
        return []
    value = f"_x_{rule.key}"
    if rule.kind == "ref":
        if rule.stored == "parent_id":
            return [f"{value}.*"]
        return [f"{value}.decoded_parent_id AS {rule.stored}"]
    if rule.presence == DEFAULT_FALSE:
        value = f"coalesce({value}, false)"
    if rule.kind == "uuid":
        value = f"nullif({value}, X'')"
    return [f"{value} AS {rule.stored}"]


def normalize(lines: DataFrame, entity: Entity) -> DataFrame:
    """Lines (file_path, value, error) to typed rows with a reason.

    Output: file_path, value, line_hash, reason, then the stored columns. A row is
    a record when ``reason`` is NULL. The id is decoded but not judged: an
    undecodable id leaves ``decoded_reddit_id`` NULL, for the caller to handle
    after filtering.
    """
    keys = [r.key for r in entity.rules]
    checked = [r for r in entity.rules if r.kind != "any"]
    texts = [r.key for r in checked if r.kind in ("string", "ref", "uuid", "enum")]
    kinds = [f"_k_{r.key}" for r in checked]
    carried = ["file_path", "value", "error"]
    # Each step below names what the next one uses more than once, so that Spark
    # evaluates it once instead of inlining it.
    parsed = (
        lines.selectExpr(
            *carried, f"CASE WHEN is_valid_utf8(value) THEN {trim_line('value')} END AS _line"
        )
        .selectExpr(
            *carried, "_line",
            f"{parse_pair('_line', keys)} AS _pair",
            "json_object_keys(_line) AS _keys",
        )
        .selectExpr(
            *carried,
            "xxhash64(_line) AS line_hash",
            f"{whole_object('_pair', '_line')} AS _doc",
            f"{repeats_a_key('_keys', keys)} AS _repeats",
        )
    )
    carried += ["line_hash", "_repeats", "_is_object"]
    typed = parsed.selectExpr("*", "_doc IS NOT NULL AS _is_object").selectExpr(
        *carried,
        *[f"_doc.{r.key} AS _v_{r.key}" for r in checked],
        *[f"schema_of_variant(_doc.{r.key}) AS _k_{r.key}" for r in checked],
    )
    named = typed.selectExpr(
        *carried,
        *kinds,
        *[f"_v_{r.key}" for r in checked if r.kind not in ("string", "uuid", "enum")],
        *[f"{coerce.text(f'_v_{k}', f'_k_{k}')} AS _t_{k}" for k in texts],
    )
    valued = named.selectExpr(*carried, *kinds, *[f"{_value(r)} AS _x_{r.key}" for r in checked])
    reason = f"""CASE
        WHEN error IS NOT NULL THEN error
        WHEN NOT is_valid_utf8(value) THEN 'invalid utf-8'
        WHEN NOT _is_object THEN 'malformed json'
        WHEN _repeats THEN 'repeated key'
        ELSE coalesce({', '.join(_problem(r) for r in checked)})
    END"""
    return valued.selectExpr(
        "file_path", "value", "line_hash",
        f"{_pinned(reason)} AS reason",
        f"{ids.base36_decode('_x_id')} AS decoded_reddit_id",
        *[c for r in checked for c in _stored_values(r)],
    ).select("file_path", "value", "line_hash", "reason", *entity.columns)


def records(normalized: DataFrame, entity: Entity) -> DataFrame:
    """The accepted rows with a valid id, stored columns only."""
    good = F.col("reason").isNull() & F.col("decoded_reddit_id").isNotNull()
    return normalized.where(good).select(*entity.columns)


def rejects(normalized: DataFrame) -> DataFrame:
    """The refused lines as (file_path, line, reason).

    Lines that are not text are kept as base64, so nothing is lost on write.
    """
    line = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(F.base64("value"))
    return normalized.where(F.col("reason").isNotNull()).select(
        "file_path", line.alias("line"), "reason"
    )
