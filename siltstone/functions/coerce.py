"""Lenient and strict coercions of one JSON value held as VARIANT.

Functions take the field (``v``) and its type name (``kind``, from
``schema_of_variant``) as SQL text and return the value's expression, which is
NULL when the value does not fit. VARIANT casts are too generous (true casts to
1, "5" to 5), so each one tests the type name first.
"""

from __future__ import annotations

from siltstone.functions import ids

# Bounds and stored type per integer width.
_INTEGERS = {
    "int8": (-128, 127, "int"),
    "int32": (-2147483648, 2147483647, "int"),
    "uint32": (0, 4294967295, "bigint"),
}


def _read(v: str, target: str) -> str:
    return f"try_variant_get({v}, '$', '{target}')"


def text(v: str, kind: str) -> str:
    return f"CASE WHEN {kind} = 'STRING' THEN {_read(v, 'string')} END"


def boolean(v: str, kind: str) -> str:
    return f"CASE WHEN {kind} = 'BOOLEAN' THEN {_read(v, 'boolean')} END"


def integer(v: str, kind: str, width: str) -> str:
    number = _read(v, "bigint")
    if width == "int64":
        return f"CASE WHEN {kind} = 'BIGINT' THEN {number} END"
    low, high, stored = _INTEGERS[width]
    fits = f"{kind} = 'BIGINT' AND {number} BETWEEN {low}L AND {high}L"
    return f"CASE WHEN {fits} THEN cast({number} AS {stored}) END"


def integer_text(value: str) -> str:
    """Decimal text to BIGINT with an optional sign and nothing else around it."""
    return rf"CASE WHEN {value} RLIKE r'\A[+-]?[0-9]+\z' THEN try_cast({value} AS bigint) END"


def round_half_away(value: str) -> str:
    """Double to the nearest BIGINT, halves away from zero, NULL when out of range."""
    return f"CASE WHEN abs({value}) < 9223372036854775808D THEN cast(round({value}) AS bigint) END"


def time(v: str, kind: str) -> str:
    """Epoch seconds from an integer, a float or integer text."""
    odd = f"""CASE
        WHEN {kind} = 'STRING' THEN {integer_text(_read(v, 'string'))}
        WHEN {kind} = 'DOUBLE' OR startswith({kind}, 'DECIMAL')
            THEN {round_half_away(_read(v, 'double'))}
    END"""
    return f"CASE WHEN {kind} = 'BIGINT' THEN {_read(v, 'bigint')} ELSE {ids.seldom(odd)} END"


def score(v: str, kind: str) -> str:
    """Integer or integer text; floats and booleans do not fit."""
    odd = f"CASE WHEN {kind} = 'STRING' THEN {integer_text(_read(v, 'string'))} END"
    return f"CASE WHEN {kind} = 'BIGINT' THEN {_read(v, 'bigint')} ELSE {ids.seldom(odd)} END"


def reference(value: str, v: str, kind: str) -> str:
    """struct(parent_type, parent_id, decoded_parent_id) from text or an integer.

    ``value`` is the field as text (:func:`text`), named by the caller because
    every part of the struct reads it.
    """
    return f"""CASE
        WHEN {kind} = 'STRING' THEN {ids.ref_from_text(value)}
        WHEN {kind} = 'BIGINT' THEN {ids.seldom(ids.ref_from_int(_read(v, 'bigint')))}
    END"""


def uuid(value: str) -> str:
    """UUID text to 16 bytes; empty text gives empty bytes, to be stored as NULL."""
    return f"CASE WHEN {value} = '' THEN X'' ELSE {ids.uuid_bytes(value)} END"


def canonical(value: str, values: dict[str, str]) -> str:
    """Stored text of an enum spelling, NULL when the spelling is unknown."""
    arms = " ".join(f"WHEN '{spelled}' THEN '{stored}'" for spelled, stored in values.items())
    return f"CASE {value} {arms} END"
