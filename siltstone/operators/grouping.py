"""Task-side grouping of a document's tokens: equal tokens of a field become one posting.

On their way to the task that writes a bucket, postings are packed: a row is a run of
one bucket's postings, sorted by term, as a small Parquet file. It takes a quarter of the
bytes that the rows would.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq

#: Tokens grouped at a time, unless one document has more.
SLICE_TOKENS = 1 << 20
ENTRY_SCHEMA = pa.schema([
    ("term", pa.string()), ("field", pa.string()), ("doc_id", pa.int64()), ("first", pa.bool_()),
    ("tf", pa.int32()), ("positions", pa.list_(pa.int32())), ("doc_len", pa.int32()),
])
ENTRY_DDL = (
    "term string, field string, doc_id bigint, first boolean, tf int, positions array<int>, doc_len int"
)

#: The bucket of the rows that stand for documents, until these are written.
DOC_BUCKET = -1
PACKED_SCHEMA = pa.schema([("term_bucket", pa.int32()), ("packed", pa.binary())])
PACKED_DDL = "term_bucket int, packed binary"
#: Sorted terms by what they share with the one before; places by their bytes.
_CODES = {
    "term": "DELTA_BYTE_ARRAY", "doc_id": "DELTA_BINARY_PACKED",
    "positions.list.element": "BYTE_STREAM_SPLIT",
}
_RUN_FORMAT = {
    "column_encoding": _CODES, "use_dictionary": ["field", "tf", "doc_len"], "compression": "zstd",
    "write_statistics": False, "store_schema": False,
}


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Neighbouring documents, of about ``SLICE_TOKENS`` tokens in all."""
    ends = np.cumsum(batch.column("doc_len").to_numpy(), dtype=np.int64)
    at, done = 0, 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, done + SLICE_TOKENS, side="right")))
        yield batch.slice(at, stop - at)
        at, done = stop, int(ends[stop - 1])


def entries(batch: pa.RecordBatch, fields: tuple[str, ...], with_docs: bool) -> pa.RecordBatch:
    """Postings of documents with their tokens by field (``_t_0``, ``_t_1``...)."""
    lists = [batch.column(f"_t_{i}") for i in range(len(fields))]
    lengths = [x.value_lengths().to_numpy() for x in lists]
    docs = np.arange(batch.num_rows, dtype=np.int64)
    doc = np.concatenate([np.repeat(docs, n) for n in lengths])
    field = np.repeat(np.arange(len(fields)), [n.sum() for n in lengths])
    place = np.concatenate([np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) for n in lengths])
    coded = pa.concat_arrays([x.flatten().cast(pa.string()) for x in lists]).dictionary_encode()
    codes, terms = coded.indices.to_numpy(), coded.dictionary
    key = (doc * len(terms) + codes) * len(fields) + field
    # Stable, so the places of a posting stay in order.
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    head, word = order[starts], key[starts] // len(fields)
    extra = batch.num_rows if with_docs else 0
    rows = pa.array(np.concatenate([doc[head], docs[:extra]]))
    ends = np.concatenate([starts, np.full(extra + 1, len(order))]).astype(np.int32)
    # The first field of a document that has the term, then none for the documents' own rows.
    first = np.concatenate([np.diff(word, prepend=-1) != 0, np.zeros(extra, bool)])
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([terms.take(pa.array(codes[head])), pa.nulls(extra, pa.string())]),
            pa.concat_arrays([
                pa.array(list(fields), pa.string()).take(pa.array(field[head])), pa.nulls(extra, pa.string()),
            ]),
            batch.column("doc_id").take(rows),
            pa.array(first),
            pa.array(np.diff(ends)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(place[order].astype(np.int32))),
            batch.column("doc_len").take(rows),
        ],
        schema=ENTRY_SCHEMA,
    )


def grouper(fields: tuple[str, ...], with_docs: bool):
    """A ``mapInArrow`` function from documents (doc_id, doc_len, tokens by field) to postings."""

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield entries(part, fields, with_docs)

    return group


def packed(rows: pa.Table, buckets: int) -> Iterator[tuple[int, bytes]]:
    """A run per bucket: its postings by term, those of a term in the order they came in."""
    coded = rows["term"].combine_chunks().cast(pa.binary()).dictionary_encode()
    codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    # As ``text_index.term_bucket`` has it.
    home = np.array([zlib.crc32(w) % buckets for w in coded.dictionary.to_pylist()], np.int64)
    by_name = pc.sort_indices(coded.dictionary).to_numpy()
    by_home = by_name[np.argsort(home[by_name], kind="stable")]
    # The place behind the last, which a missing code finds, is that of the documents.
    place = np.append(np.empty(len(home), np.int64), -1)
    place[by_home] = np.arange(len(home))
    order = np.argsort(place[codes], kind="stable")
    of_row = np.append(home, DOC_BUCKET)[codes[order]]
    starts = np.flatnonzero(np.diff(of_row, prepend=DOC_BUCKET - 1))
    ordered = rows.take(pa.array(order))
    for start, stop in zip(starts, [*starts[1:], len(order)]):
        out = pa.BufferOutputStream()
        pq.write_table(ordered.slice(start, stop - start), out, **_RUN_FORMAT)
        yield int(of_row[start]), out.getvalue().to_pybytes()


def packer(buckets: int, fields: tuple[str, ...] | None = None):
    """A ``mapInArrow`` function to packed runs, about ``SLICE_TOKENS`` tokens at a time.

    With ``fields`` it takes documents as ``grouper`` does, and packs their own rows, too;
    without, postings.
    """

    def sealed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        homes, runs = zip(*packed(pa.Table.from_batches(held), buckets))
        return pa.RecordBatch.from_arrays(
            [pa.array(homes, pa.int32()), pa.array(runs, pa.binary())], schema=PACKED_SCHEMA
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches if fields is None else grouper(fields, True)(batches):
            held.append(batch)
            n += batch.num_rows + (pc.sum(batch.column("tf")).as_py() or 0)
            if n >= SLICE_TOKENS:
                yield sealed(held)
                held, n = [], 0
        if n:
            yield sealed(held)

    return pack


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The postings of packed runs, with their bucket."""
    schema = ENTRY_SCHEMA.append(PACKED_SCHEMA.field("term_bucket"))
    for batch in batches:
        for home, run in zip(batch.column("term_bucket").to_pylist(), batch.column("packed")):
            rows = pq.read_table(pa.BufferReader(run.as_buffer()), use_threads=False)
            homes = pa.array(np.full(rows.num_rows, home, np.int32))
            yield from rows.append_column(schema.field("term_bucket"), homes).cast(schema).to_batches()
