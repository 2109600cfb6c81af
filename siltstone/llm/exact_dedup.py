"""Exact deduplication through an extendible-hash index on shared files.

A text's key is the first 64 bits of its digest. A directory maps the leading bits
of a key to a bucket; it doubles whenever a bucket with too many keys has to be
split. Tasks own ranges of buckets: they chain texts of equal key, compare their
bytes, and write their buckets' entries.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import as_bytes, rows_of, shared_dir, slices, stored, text_hash

#: Leading bits of a key that keys are counted by, and how many more where cells of so
#: many bits have more keys than a bucket takes; together they bound the directory.
CELL_BITS = 16
MORE_BITS = 6
#: Bytes of text that a task gathers before it passes on one row per distinct text.
COMBINE_BYTES = 48 << 20


def normalised(text: bytes | None) -> bytes:
    """A-Z lower-cased, nothing else changed; null is empty."""
    return (text or b"").lower()


def text_key(digest: bytes) -> int:
    return struct.unpack(">q", digest[:8])[0]


@dataclass
class Bucket:
    depth: int
    prefix: int  # its leading ``depth`` bits
    keys: int


class Directory:
    """Leading bits to buckets."""

    def __init__(self, cells: dict[int, int], capacity: int, bits: int = CELL_BITS):
        """``cells``: keys by their first ``bits`` bits."""
        self.depth, self.bits = 0, bits
        self.slots = [Bucket(0, 0, sum(cells.values()))]
        self.cells = cells
        pending = [self.slots[0]]
        while pending:
            bucket = pending.pop()
            if bucket.keys > capacity and bucket.depth < self.bits:
                pending += self._split(bucket)

    def _split(self, bucket: Bucket) -> list[Bucket]:
        if bucket.depth == self.depth:  # each slot becomes two
            self.slots = [b for b in self.slots for _ in range(2)]
            self.depth += 1
        depth = bucket.depth + 1
        halves = [Bucket(depth, bucket.prefix << 1 | bit, 0) for bit in (0, 1)]
        shift = self.bits - depth
        low = halves[0].prefix << shift
        for half in halves:
            first = half.prefix << shift
            half.keys = sum(self.cells.get(c, 0) for c in range(first, first + (1 << shift)))
        span = 1 << (self.depth - depth)
        start = low >> (self.bits - self.depth)
        self.slots[start : start + 2 * span] = [halves[0]] * span + [halves[1]] * span
        return halves

    def bucket_of_cells(self) -> list[tuple[int, int]]:
        """Cell and bucket number; buckets are numbered in key order."""
        number, out, last = -1, [], None
        for cell in range(1 << self.bits):
            bucket = self.slots[cell >> (self.bits - self.depth)]
            if bucket is not last:
                number, last = number + 1, bucket
            out.append((cell, number))
        return out

    def owners(self, tasks: int) -> list[tuple[int, int, int]]:
        """Cell, bucket and owner: tasks own runs of cells with about equally many keys."""
        share, seen, out = max(1, -(-sum(self.cells.values()) // tasks)), 0, []
        for cell, bucket in self.bucket_of_cells():
            out.append((cell, bucket, min(seen // share, tasks - 1)))
            seen += self.cells.get(cell, 0)
        return out


def digests(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, sha, t`` of each row, by its normalised whole text; t: ``text_hash``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [hashlib.sha256(normalised(t)).digest() for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(map(text_key, found), pa.int64()),
                    pa.array(found, pa.binary()), batch.column(2),
                ],
                names=["id", "key", "sha", "t"],
            )

    rows = docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("x"), text_hash(text).alias("t")
    )
    return rows.mapInArrow(read, "id long, key long, sha binary, t long")


def _cell(bits: int = CELL_BITS):
    return F.shiftrightunsigned(F.col("key"), 64 - bits).cast("int")


def directory_of(rows: DataFrame, capacity: int) -> Directory:
    """A directory for rows with a ``key``; equal keys count once.

    What the driver gets is a count for each of at most 2^CELL_BITS cells, or of
    2^(CELL_BITS + MORE_BITS) where such a cell has more keys than a bucket takes. Beyond
    that, buckets grow; what they give stays the same.
    """

    def counted(bits: int) -> dict[int, int]:
        counts = rows.select("key").distinct().groupBy(_cell(bits).alias("cell")).count()
        return {r["cell"]: r["count"] for r in counts.collect()}

    cells, bits = counted(CELL_BITS), CELL_BITS
    fullest = max(cells.values(), default=0)
    # Splitting one cell's few keys is no use where capacity is tiny.
    if fullest > max(capacity, 1000):
        bits += min(MORE_BITS, (fullest // capacity).bit_length())
        cells = counted(bits)
    return Directory(cells, capacity, bits)


def combined(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows with ``key, sha, keep, size, body``: the distinct texts of each task.

    A task passes on a text once for all of its copies in up to ``COMBINE_BYTES``
    of texts, so a frequent text is a few rows per task.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0
        for batch in slices(batches):
            for i, t in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                body = normalised(t)
                found = held.get(body)
                if found is None:
                    held[body] = [i, 1]
                    size += len(body) + 200
                else:
                    found[0] = _larger(found[0], i)
                    found[1] += 1
            if size > COMBINE_BYTES:
                yield from _texts(held)
                held, size = {}, 0
        yield from _texts(held)

    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("t"))
    return rows.mapInArrow(gather, "key long, sha binary, keep long, size long, body binary")


def _larger(a: int | None, b: int | None) -> int | None:
    return a if b is None else b if a is None else max(a, b)


def _texts(held: dict[bytes, list]) -> Iterator[pa.RecordBatch]:
    bodies = list(held)
    for start in range(0, len(bodies), 1000):
        part = bodies[start : start + 1000]
        shas = [hashlib.sha256(b).digest() for b in part]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(map(text_key, shas), pa.int64()), pa.array(shas, pa.binary()),
                pa.array([held[b][0] for b in part], pa.int64()),
                pa.array([held[b][1] for b in part], pa.int64()), pa.array(part, pa.binary()),
            ],
            names=["key", "sha", "keep", "size", "body"],
        )


ENTRIES = "bucket int, key long, chain int, sha binary, keep long, size long"


class ExtendibleIndex:
    """Distinct texts by key in bucket files below a shared folder.

    ``add`` merges rows into the index and returns the entries with, for every
    distinct text, the largest id and the number of rows. With ``keep_texts`` the
    files also hold the texts, so that a later ``add`` compares bytes with them.
    """

    def __init__(self, spark: SparkSession, folder: str, capacity: int = 50_000, keep_texts: bool = True):
        self.spark, self.folder, self.capacity, self.keep_texts = spark, folder, capacity, keep_texts
        self.generation = 0
        self.schema = ENTRIES + (", body binary" if keep_texts else "")

    def entries(self) -> DataFrame | None:
        if not self.generation:
            return None
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/generation-{self.generation}")

    def add(self, texts: DataFrame, keys: DataFrame) -> DataFrame:
        """Add the rows of ``combined``; ``keys`` has the ``key`` of each."""
        old = self.entries()
        columns = ["key", "sha", "keep", "size", "body"]
        if old is not None:
            if not self.keep_texts:
                raise ValueError("an index without texts cannot be added to")
            keys = keys.select("key").union(old.select("key"))
            texts = texts.select(columns).union(old.select(columns))
        directory = directory_of(keys, self.capacity)
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        cells = self.spark.createDataFrame(directory.owners(tasks), "cell int, bucket int, owner int")
        # Three integers for each cell of the directory, whose size has a bound.
        placed = texts.select(columns).withColumn("cell", _cell(directory.bits)).join(F.broadcast(cells), "cell")
        # Rows go to their owner by its number: the directory knows the ranges, so no
        # sample of the texts has to tell them.
        owned = (
            placed.select("bucket", "owner", *columns)
            .repartitionById(tasks, "owner")
            .sortWithinPartitions("bucket", "key")
            .drop("owner")
            .mapInArrow(_own(self.keep_texts), self.schema)
        )
        self.generation += 1
        return stored(owned, f"{self.folder}/generation-{self.generation}")


def _own(keep_texts: bool):
    """Chains of the buckets that a task owns; its rows come in the order of their keys."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: list[list] = []  # entries of the current key: bucket, key, sha, keep, size, body
        done: list[list] = []
        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                bucket, key, sha, keep, size, body = row
                if chain and chain[0][1] != key:
                    done += [[*e[:2], n, *e[2:]] for n, e in enumerate(chain)]
                    chain = []
                for entry in chain:
                    if entry[5] == body:  # bytes decide, not digests
                        entry[3] = _larger(entry[3], keep)
                        entry[4] += size
                        break
                else:
                    chain.append([bucket, key, sha, keep, size, body])
            if done:
                yield _entries(done, keep_texts)
                done = []
        done += [[*e[:2], n, *e[2:]] for n, e in enumerate(chain)]
        if done:
            yield _entries(done, keep_texts)

    return own


def _entries(rows: list[list], keep_texts: bool) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    names = ["bucket", "key", "chain", "sha", "keep", "size", "body"]
    n = 7 if keep_texts else 6
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[i], kinds[i]) for i in range(n)], names=names[:n]
    )


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = 50_000,
    folder: str | None = None, keep_texts: bool = False,
) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` of each row.

    Texts are equal when their bytes are after lower-casing A-Z; null counts as
    empty. The row with the largest id stays; null ids are smaller than others, and
    a group of null ids alone keeps them. Rows that repeat the kept id and text are
    all marked kept. An empty table gives no rows, other columns are not read.
    """
    return _joined(*_indexed(docs, id_column, text, capacity, folder, keep_texts)).select(
        F.col("id").alias(id_column), "keep_id", "group_size", "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _indexed(docs, id_column, text, capacity, folder, keep_texts) -> tuple[DataFrame, DataFrame]:
    """Digests of the rows, and the index entries of their texts."""
    spark = docs.sparkSession
    folder = folder or shared_dir(spark)
    rows = stored(digests(docs, id_column, text), f"{folder}/digests")
    index = ExtendibleIndex(spark, f"{folder}/index", capacity, keep_texts)
    return rows, index.add(combined(docs, id_column, text), rows)


def _joined(rows: DataFrame, entries: DataFrame) -> DataFrame:
    groups = entries.select("sha", F.col("keep").alias("keep_id"), F.col("size").alias("group_size"))
    return rows.join(groups, "sha").withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def keep_one(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = 50_000,
    folder: str | None = None,
) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, also where rows repeat."""
    kept = _joined(*_indexed(docs, id_column, text, capacity, folder, False)).where("kept")
    copies = kept.groupBy("sha", "id", "t").agg(F.count("sha").alias("c"))
    wanted = copies.groupBy("sha").agg(F.min(F.struct("t", "id", "c")).alias("w")).select("w.*")
    return rows_of(docs, wanted, id_column, text)
