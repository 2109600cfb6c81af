"""A sorted dictionary of an index batch's terms, in front-coded blocks.

A row is a block of neighbouring terms: its least and largest term, and for each term
how many characters it shares with the one before, the rest of it, and the number of
documents that hold it. Terms are in one file or, in large batches, in a few, each
sorted, so a search for a term or a prefix reads a row group per file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_TERMS = 256
#: Sorts behind every token that starts like it; no token holds it.
LAST = "\U0010ffff"
BLOCK_DDL = (
    "low string, high string, shared array<int>, rest array<string>, "
    "docs array<bigint>, field_docs array<array<bigint>>"
)
TERM_DDL = "term string, docs bigint, field_docs array<bigint>"


def is_prefix(token: str) -> bool:
    """Whether a query token stands for all terms that it begins: ``two*``."""
    return token.endswith("*")


def matches(term: Column, token: str) -> Column:
    return term.startswith(token[:-1]) if is_prefix(token) else term == F.lit(token)


def shared_length(before: str, term: str) -> int:
    most = min(len(before), len(term))
    if before[:most] == term[:most]:
        return most
    return next(i for i in range(most) if before[i] != term[i])


def front_coded(terms: list[str]) -> tuple[list[int], list[str]]:
    """Shared lengths and rests of sorted terms."""
    shared = [0] + [shared_length(a, b) for a, b in zip(terms, terms[1:])]
    return shared, [t[n:] for n, t in zip(shared, terms)]


def spelled_out(shared: list[int], rest: list[str]) -> list[str]:
    out: list[str] = []
    for n, tail in zip(shared, rest):
        out.append((out[-1][:n] if n else "") + tail)
    return out


def _block(rows: list[tuple]) -> dict:
    terms, docs, field_docs = zip(*rows)
    shared, rest = front_coded(list(terms))
    return {
        "low": terms[0], "high": terms[-1], "shared": shared, "rest": rest,
        "docs": list(docs), "field_docs": list(field_docs),
    }


_BLOCK_SCHEMA = pa.schema([
    ("low", pa.string()), ("high", pa.string()), ("shared", pa.list_(pa.int32())),
    ("rest", pa.list_(pa.string())), ("docs", pa.list_(pa.int64())),
    ("field_docs", pa.list_(pa.list_(pa.int64()))),
])


def blocks_of(entries: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """The dictionary of postings (term, field, first): a count per term, then blocks."""
    per_field = [F.count(F.when(F.col("field") == f, 1)) for f in fields]
    counted = entries.groupBy("term").agg(
        F.count(F.when(F.col("first"), 1)).alias("docs"), F.array(*per_field).alias("field_docs")
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(column.to_pylist() for column in batch.columns))
            full = len(held) - len(held) % BLOCK_TERMS
            if full:
                blocks = [_block(held[i : i + BLOCK_TERMS]) for i in range(0, full, BLOCK_TERMS)]
                yield pa.RecordBatch.from_pylist(blocks, _BLOCK_SCHEMA)
                held = held[full:]
        if held:
            yield pa.RecordBatch.from_pylist([_block(held)], _BLOCK_SCHEMA)

    return counted.sortWithinPartitions("term").mapInArrow(code, BLOCK_DDL)


def lookup(blocks: DataFrame, tokens: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and term, docs, field_docs of the terms that match a token.

    Only blocks whose range holds a match are spelled out.
    """
    ranges = F.lit(False)
    for token in tokens:
        low = token.rstrip("*")
        high = low + LAST if is_prefix(token) else low
        ranges = ranges | ((F.col("high") >= low) & (F.col("low") <= high))
    names = [f.name for f in blocks.select(*keep).schema.fields]
    columns = ["shared", "rest", "docs", "field_docs"]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in blocks.select(*keep).schema] + [TERM_DDL])
    exact = {t for t in tokens if not is_prefix(t)}
    prefixes = tuple(t[:-1] for t in tokens if is_prefix(t))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, terms, docs, field_docs = [], [], [], []
            for i, (shared, rest, n, by_field) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in columns))
            ):
                for k, term in enumerate(spelled_out(shared, rest)):
                    if term in exact or (prefixes and term.startswith(prefixes)):
                        at.append(i)
                        terms.append(term)
                        docs.append(n[k])
                        field_docs.append(by_field[k])
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n).take(rows) for n in names]
                + [pa.array(terms, pa.string()), pa.array(docs, pa.int64()),
                   pa.array(field_docs, pa.list_(pa.int64()))],
                names=[*names, "term", "docs", "field_docs"],
            )

    return blocks.where(ranges).select(*keep, *columns).mapInArrow(spell, schema)
