"""Token ids of texts in ORC files, in ascending order of the document id.

A file holds a range of document ids, sorted. Its columns are integers and lists of
integers, which ORC writes with run-length encoding in stripes, with an index entry per
group of rows (least and largest value) and a Bloom filter on the document id. Stripes
are read in parallel; a search for ids reads footers and indexes, then only the row
groups that may hold them. A long text takes several rows, so that neither the writer nor
a reader holds more than a row of it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.common import plain_names, slices, stored
from siltstone.llm.packing import FastTokenizer

#: Rows of the input that one file is planned for.
FILE_ROWS = 1 << 14
STRIPE_BYTES = 16 << 20
#: Rows per index entry and per Bloom filter.
GROUP_ROWS = 1000
FALSE_POSITIVES = 0.01
#: Ids per row at most: bounds what readers hold, as Spark hands rows on by the thousand.
ROW_IDS = 1024
#: ``start`` counts the ids before the document within its file, ``at`` those before the
#: row within its document; ``n`` is the length of ``ids``, for readers that want no ids.
FILE_DDL = "file bigint, doc_id bigint, start bigint, at bigint, last boolean, n int, ids array<int>"
FILE_SCHEMA = pa.schema([
    ("file", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("at", pa.int64()),
    ("last", pa.bool_()), ("n", pa.int32()), ("ids", pa.list_(pa.int32())),
])


def in_files(docs: DataFrame, doc_id: str, text: str, file_rows: int) -> DataFrame:
    """``doc_id, text`` in ascending order, a partition per file.

    Equal ids go by a hash of the text, then by place in the input, so an id with very
    many rows fills several files and no task gets them all. Spark reads the input once
    more to choose the ranges; texts are moved once and tokenised once.
    """
    rows, (key, content) = plain_names(docs, doc_id, text)
    files = max(1, -(-rows.count() // file_rows))
    order = ["doc_id", "h", "place"]
    return rows.select(
        F.col(key).cast("bigint").alias("doc_id"), F.col(content).alias("text"),
        F.xxhash64(content).alias("h"), F.monotonically_increasing_id().alias("place"),
    ).repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text")


def token_rows(ordered: DataFrame, tokenizer_path: str, ranks_path: str, end_id: int,
               row_ids: int = ROW_IDS) -> DataFrame:
    """The rows of the files, from ``doc_id, text`` with a partition per file."""

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, start = FastTokenizer(tokenizer_path, ranks_path), 0
        end = np.array([end_id], "<i4").tobytes()
        file = TaskContext.get().partitionId()
        for batch in slices(batches, 256):
            columns: list[list] = [[] for _ in range(5)]
            chunks, lengths = [], [0]
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = tokenizer.ids(text or "") + end
                total = len(ids) // 4
                for at in range(0, total, row_ids):
                    n = min(row_ids, total - at)
                    for column, value in zip(columns, (doc_id, start, at, at + n == total, n)):
                        column.append(value)
                    lengths.append(lengths[-1] + n)
                chunks.append(ids)
                start += total
            values = pa.array(np.frombuffer(b"".join(chunks), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * len(lists), pa.int64())]
                + [pa.array(c, f.type) for c, f in zip(columns, list(FILE_SCHEMA)[1:6])] + [lists],
                schema=FILE_SCHEMA,
            )

    return ordered.mapInArrow(tokenise, FILE_DDL)


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str, ranks_path: str, end_id: int, *,
    doc_id: str = "doc_id", text: str = "text", file_rows: int = FILE_ROWS,
    row_ids: int = ROW_IDS, stripe_bytes: int = STRIPE_BYTES, group_rows: int = GROUP_ROWS,
) -> None:
    """Write the ids of every text, each followed by ``end_id``, to a new folder ``path``.

    A null text is empty: it has the end id alone. Null ids come first. Repeated rows
    are documents of their own; equal ids go by a hash of the text. An empty table gives
    a folder that reads as no rows. Other columns, whatever their names, are not read.
    """
    rows = token_rows(in_files(docs, doc_id, text, file_rows), tokenizer_path, ranks_path, end_id, row_ids)
    (
        rows.write.mode("error")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", group_rows)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", FALSE_POSITIVES)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files. Conditions on ``doc_id`` skip files, stripes and row groups."""
    return spark.read.schema(FILE_DDL).orc(path)


def crc_after(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings in a row, from theirs and the length of the second."""
    zeros = bytes(length)
    return zlib.crc32(zeros, first) ^ zlib.crc32(zeros) ^ second


def row_digests(rows: DataFrame) -> DataFrame:
    """``file, doc_id, start, at, last, n, crc`` of rows of the files: ids become a crc32
    of little-endian 32-bit integers. Narrow, so that stripes are read side by side."""
    kept = ["file", "doc_id", "start", "at", "last"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(kept))
            ends = lists.offsets.to_numpy().astype(np.int64) * 4
            data = memoryview(lists.values.to_numpy().astype("<i4", copy=False)).cast("B")
            crc = [zlib.crc32(data[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(np.diff(ends) // 4), pa.array(crc, pa.int64())],
                names=[*kept, "n", "crc"],
            )

    return rows.select(*kept, "ids").mapInArrow(
        digest, "file bigint, doc_id bigint, start bigint, at bigint, last boolean, n bigint, crc bigint"
    )


def document_digests(digests: DataFrame) -> DataFrame:
    """``file, doc_id, start, n_tokens, ids_crc32`` of each document from ``row_digests``.

    Only documents of several rows are brought together, and of those no ids.
    """

    @F.pandas_udf("long")
    def joined(parts: pd.Series) -> pd.Series:
        def whole(rows: list) -> int:
            crc = 0
            for row in rows:
                crc = crc_after(crc, row["crc"], 4 * row["n"])
            return crc

        return parts.map(whole)

    in_one = (F.col("at") == 0) & F.col("last")
    short = digests.where(in_one).select(
        "file", "doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")
    )
    long = digests.where(~in_one).groupBy("file", "start").agg(
        F.first("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("at", "n", "crc"))).alias("parts"),
    )
    return short.unionByName(
        long.select("file", "doc_id", "start", "n_tokens", joined("parts").alias("ids_crc32"))
    )


def file_offsets(spark: SparkSession, path: str) -> DataFrame:
    """``file, before``: the ids in all files that come before each one.

    Reads two columns of small integers; the running sum is over a row per file.
    """
    totals = read_tokens(spark, path).groupBy("file").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))


def document_table(spark: SparkSession, path: str, folder: str, wanted: Column | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, or of those that ``wanted``
    (a condition on ``doc_id``) names; ``start`` counts the ids of all documents before.

    The files are read once: a few numbers per row are set down in ``folder``, which
    must not exist.
    """
    rows = read_tokens(spark, path)
    digests = stored(row_digests(rows if wanted is None else rows.where(wanted)), folder)
    found = document_digests(digests)
    return found.join(file_offsets(spark, path), "file").select(
        "doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )
