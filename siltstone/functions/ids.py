"""Base-36 ids, reference ids and UUIDs.

Functions here and in ``coerce`` take SQL expressions as text and return one, for
``selectExpr``/``F.expr``: a whole field rule then costs one call to build.
"""

from __future__ import annotations

# The largest signed 64-bit number in base 36, and the magnitude
# of the smallest.
MAX_BASE36 = "1y2p0ij32e8e7"
MIN_BASE36 = "1y2p0ij32e8e8"

_HYPHENATED = "[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"
_UUID_PATTERN = (
    rf"\A([0-9A-Fa-f]{{32}}|{_HYPHENATED}|\{{{_HYPHENATED}\}}|urn:uuid:{_HYPHENATED})\z"
)


def seldom(expression: str) -> str:
    """The same value, by a path that is slower where it runs and costs nothing else.

    Rules for odd values would otherwise be compiled into one method with those for
    plain ones, and the JVM leaves methods beyond 8,000 bytes uncompiled: every line
    would pay for them. A lambda's body is evaluated apart, and Spark compiles the
    projection around it in small methods. To be used within a CASE.
    """
    return f"get(transform(array(true), __odd -> {expression}), 0)"


def base36_decode(text: str) -> str:
    """Base-36 text to BIGINT; NULL where it is not a 64-bit base-36 number.

    ``conv`` alone stops at the first bad digit and fails on overflow, so the
    shape is checked before it runs. Up to 12 digits always fit; signs, padding
    and longer numbers take the second path.
    """
    return rf"""CASE
        WHEN {text} RLIKE r'\A[0-9A-Za-z]{{1,12}}\z' THEN cast(conv({text}, 36, 10) AS bigint)
        WHEN {text} IS NOT NULL THEN {seldom(_odd_base36(text))}
    END"""


def _odd_base36(text: str) -> str:
    digits = rf"lower(regexp_replace({text}, r'\A[+-]?0*', ''))"
    magnitude = f"cast(conv({digits}, 36, 10) AS bigint)"
    return rf"""CASE
        WHEN {text} RLIKE r'\A[+-]?[0-9A-Za-z]+\z' THEN CASE
            WHEN {digits} = '' THEN 0L
            WHEN length({digits}) < 13 OR (length({digits}) = 13 AND {digits} <= '{MAX_BASE36}')
                THEN if(startswith({text}, '-'), -{magnitude}, {magnitude})
            WHEN startswith({text}, '-') AND {digits} = '{MIN_BASE36}'
                THEN -9223372036854775807L - 1L
        END
    END"""


def base36_encode(number: str) -> str:
    """Integer to lower-case base-36 text."""
    return f"lower(conv(cast({number} AS string), 10, 36))"


def ref_from_text(text: str) -> str:
    """``t3_1abc`` style text to struct(parent_type, parent_id, decoded_parent_id).

    The type is the second character and must be a digit; the id follows the
    first underscore. The decoded id is NULL when the text is no reference id.
    Nearly all are a letter, a digit and an id of some digits.
    """
    plain = f"substr({text}, 4)"
    return rf"""CASE
        WHEN {text} RLIKE r'\A[a-z][0-9]_[0-9A-Za-z]{{1,12}}\z' THEN named_struct(
            'parent_type', ascii(substr({text}, 2, 1)) - 48, 'parent_id', {plain},
            'decoded_parent_id', cast(conv({plain}, 36, 10) AS bigint))
        ELSE {seldom(_odd_ref(text))}
    END"""


def _odd_ref(text: str) -> str:
    body = f"substr({text}, instr({text}, '_') + 1)"
    shaped = f"instr({text}, '_') > 2 AND substr({text}, 2, 1) BETWEEN '0' AND '9'"
    return f"""named_struct(
        'parent_type', CASE WHEN {shaped} THEN ascii(substr({text}, 2, 1)) - 48 END,
        'parent_id', CASE WHEN {shaped} THEN {body} END,
        'decoded_parent_id', CASE WHEN {shaped} THEN {_odd_base36(body)} END)"""


def ref_from_int(number: str) -> str:
    """A plain integer reference: no type digit, text is its base-36 form."""
    return f"""named_struct(
        'parent_type', cast(NULL AS int),
        'parent_id', {base36_encode(number)},
        'decoded_parent_id', cast({number} AS bigint))"""


def uuid_bytes(text: str) -> str:
    """UUID text to 16 bytes; empty or malformed text gives NULL."""
    bare = rf"regexp_replace({text}, r'\Aurn:uuid:|[{{}}-]', '')"
    return f"CASE WHEN {text} RLIKE r'{_UUID_PATTERN}' THEN unhex({bare}) END"
