"""Full-text tokens: letter/digit runs, case-folded, single diacritics removed."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

TOKEN_CLASS = r"[\p{L}\p{N}\p{Co}]"

# Combining marks that vanish inside a token (offsets from U+0300).
MARK_OFFSETS = (
    0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 12, 15, 17, 27,
    35, 36, 37, 38, 39, 40, 45, 46, 48, 49,
)
MARKS = "".join(chr(0x300 + offset) for offset in MARK_OFFSETS)

# Letters whose folded form is neither their lower case nor a bare
# ASCII letter.
SYMBOL_FOLDS = {
    "µ": "μ",  # micro sign
    "ſ": "s",  # long s
    "ẛ": "s",  # long s with dot above
    "ς": "σ",  # final sigma
    "ϐ": "β",
    "ϑ": "θ",
    "ϕ": "φ",
    "ϖ": "π",
    "ϰ": "κ",
    "ϱ": "ρ",
    "ϵ": "ε",
    "ι": "ι",
}


@cache
def accent_folds() -> dict[str, str]:
    """Letters made of one ASCII letter and exactly one mark, to that letter.

    Letters with two marks stay as they are.
    """
    folds = dict(SYMBOL_FOLDS)
    for code in range(0x80, 0x2000):
        letter = chr(code)
        parts = unicodedata.normalize("NFD", letter)
        if len(parts) == 2 and parts[0].isascii() and unicodedata.category(parts[1]) == "Mn":
            folds[letter] = parts[0].lower()
    return folds


def fold(text: Column) -> Column:
    """Lower case without single diacritics; plain ASCII text skips the character map."""
    folds = accent_folds()
    lowered = F.lower(text)
    mapped = F.translate(lowered, "".join(folds) + MARKS, "".join(folds.values()))
    return F.when(F.octet_length(text) == F.length(text), lowered).otherwise(mapped)


def tokens(text: Column) -> Column:
    """Array of folded tokens in text order; empty for NULL."""
    found = F.regexp_extract_all(fold(text), F.lit(f"{TOKEN_CLASS}+"), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def query_tokens(spark: SparkSession, text: str) -> list[str]:
    """Tokens of a query string, cut the same way as indexed text."""
    return spark.range(1).select(tokens(F.lit(text)).alias("t")).first()["t"]


def _spellings(letter: str) -> str:
    """Original characters that fold to a letter, for use inside a character class."""
    upper = letter.upper() if len(letter.upper()) == 1 else ""
    accented = [c for c, base in accent_folds().items() if base == letter]
    return letter + upper + "".join(accented)


def _phrase_pattern(phrase: list[str]) -> str:
    """Regular expression for the original spellings of a run of tokens.

    A token that ends in ``*`` stands for all that it begins.
    """
    words = [
        "".join(f"[{_spellings(c)}][{MARKS}]*" for c in token.rstrip("*"))
        + (rf"(?:{TOKEN_CLASS}|[{MARKS}])*" if token.endswith("*") else "")
        for token in phrase
    ]
    return rf"(?:(?!{TOKEN_CLASS}).)+".join(words)


def highlight(text: Column, phrases: list[list[str]], before: str, after: str) -> Column:
    """Original text with every occurrence of the phrases wrapped."""
    longest_first = sorted(phrases, key=len, reverse=True)
    either = "|".join(_phrase_pattern(p) for p in longest_first)
    inside = rf"(?:{TOKEN_CLASS}|[{MARKS}])"
    # The look ahead at the first letter rules out most positions cheaply.
    first = "".join(_spellings(c) for c in sorted({p[0][0] for p in phrases}))
    pattern = f"(?s)(?=[{first}])(?<!{inside})(?:{either})(?!{inside})"

    def literal(s: str) -> str:
        return s.replace("\\", "\\\\").replace("$", "\\$")

    return F.regexp_replace(text, pattern, f"{literal(before)}$0{literal(after)}")
