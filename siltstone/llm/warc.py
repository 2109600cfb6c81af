"""Web archives: a writer with one gzip member per record, and a splittable reader.

A reading task has a byte range of a file. It looks for the gzip magic, takes a
place for a member only if a record header decodes there, and owns the records
that start inside its range, also where they end beyond it.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import qualified, shared_dir, slices, stored, task_fs, unique_name

MAGIC = b"\x1f\x8b\x08"
BLOCK = 256 << 10
FILE_BYTES = 1 << 30
SPLIT_BYTES = 8 << 20
RECORD_ID = "<urn:page:%s>"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, bytes long, records long"
RECORDS = (
    "path string, offset long, record_id string, record_type string, target_uri string, "
    "refers_to string, payload_bytes long, payload_digest string, digest_ok boolean"
)


# --- Writing ---------------------------------------------------------------


def plan_records(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
    smallest: int = 0,
) -> DataFrame:
    """``key, url, payload, refers_to`` of each row; a null ``refers_to`` is a response.

    Of equal payloads of at least ``smallest`` bytes, the row with the largest key
    is the response and the others refer to it; rows that repeat the largest key
    are responses too, as is a payload of which all keys are null. Shorter payloads
    are always responses. A null payload is empty. Copies are counted before the
    shuffle, and a frequent payload is one row on the other side of the join, so
    adaptive execution can split its rows.
    """
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"),
        F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    first = rows.groupBy("digest").agg(F.max("key").alias("first"))
    refers = F.when(
        (F.octet_length("payload") >= smallest) & ~F.col("key").eqNullSafe(F.col("first")),
        F.col("first"),
    )
    return rows.join(first, "digest").select("key", "url", "payload", refers.alias("refers_to"))


def _safe(value: str) -> str:
    return quote(value, safe="!#$%&'()*+,/:;=?@[]~")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(key: object, url: str | None, payload: bytes, refers_to: object, date: str) -> bytes:
    """A record before compression; a revisit keeps the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {RECORD_ID % ('' if key is None else key)}",
        f"WARC-Target-URI: {_safe(url or '')}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: {RECORD_ID % refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(
    records: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", level: int = 6,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write planned records as ``*.warc.gz`` files; a row per file.

    Each attempt of a task writes files of its own names. Only those of the
    attempts that Spark accepted are in the returned list, which is itself stored,
    so lost executors and repeated attempts neither lose nor double a record.
    """
    spark = records.sparkSession
    base = qualified(spark, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = task_fs(f"{base}/archives")
        fs.create_dir(root, recursive=True)
        out, name, size, count = None, "", 0, 0
        for batch in slices(batches, 200):
            rows = zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                batch.column(2).to_pylist(), batch.column(3).to_pylist(),
            )
            for key, url, payload, refers_to in rows:
                if out is None:
                    name = unique_name("records") + ".warc.gz"
                    out, size, count = fs.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(record_bytes(key, url, payload, refers_to, date)) + packer.flush()
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield _listed(f"{base}/archives/{name}", size, count)
        if out is not None:
            out.close()
            yield _listed(f"{base}/archives/{name}", size, count)

    files = records.select("key", "url", "payload", "refers_to").mapInArrow(write, MANIFEST)
    return stored(files, f"{folder}/manifest")


def _listed(path: str, size: int, count: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [count]})


# --- Reading ---------------------------------------------------------------


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str] = field(default_factory=dict)
    payload_bytes: int = 0
    sha1: object = field(default_factory=hashlib.sha1)


class NotARecord(ValueError):
    """No record starts at this place."""


class LostRecords(RuntimeError):
    """Files gave other numbers of records than were written to them."""


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines)
    return {k.decode("latin-1").strip().lower(): v.decode("utf-8", "replace").strip() for k, _, v in pairs}


class MemberReader:
    """Reads records of one file by position."""

    def __init__(self, stream, size: int):
        self.stream, self.size = stream, size

    def find(self, start: int, end: int) -> int | None:
        """Where the first record at or after ``start`` and before ``end`` begins."""
        at = start
        while at < end:
            self.stream.seek(at)
            block = self.stream.read(min(BLOCK, end - at) + len(MAGIC) - 1)
            found = block.find(MAGIC)
            while found >= 0:
                if at + found < end and self._begins(at + found):
                    return at + found
                found = block.find(MAGIC, found + 1)
            at += BLOCK
        return None

    def _begins(self, at: int) -> bool:
        try:
            next(self._parts(at))
        except (NotARecord, StopIteration):
            return False
        return True

    def _parts(self, at: int) -> Iterator[Record | bytes | int]:
        """The record with its headers, then parts of its block, then where it ends.

        A header may be as long as its member: a url in it has no bound.
        """
        inflate = zlib.decompressobj(31)
        self.stream.seek(at)
        head, record, left, read = bytearray(), None, 0, 0
        while not inflate.eof:
            data = self.stream.read(BLOCK if record or head else 4096)
            if not data:
                raise NotARecord(f"the record at {at} ends early")
            read += len(data)
            try:
                plain = inflate.decompress(data)
            except zlib.error as e:
                raise NotARecord(f"at {at}: {e}") from e
            if record is None:
                known = max(0, len(head) - 3)
                head += plain
                if not b"WARC/1."[: len(head)] == head[:7]:
                    raise NotARecord(f"no record header at {at}")
                ended = head.find(b"\r\n\r\n", known)
                if ended < 0:
                    continue
                record, rest = Record(_fields(bytes(head[:ended]).split(b"\r\n")[1:])), bytes(head[ended + 4 :])
                if "warc-type" not in record.headers or not record.headers.get("content-length", "").isdigit():
                    raise NotARecord(f"the header at {at} lacks a field")
                left = int(record.headers["content-length"])
                position = self.stream.tell()
                yield record
                self.stream.seek(position)
                plain = rest
            if plain and left:
                yield plain[:left]
                left -= min(left, len(plain))
        if record is None or left:
            raise NotARecord(f"the record at {at} ends early")
        yield at + read - len(inflate.unused_data)

    def record(self, at: int) -> tuple[Record, int]:
        """The record at ``at`` with size and digest of its payload, and where it ends.

        The payload streams through, so a long one takes no memory.
        """
        parts = self._parts(at)
        record = next(parts)
        http, in_http = b"", "application/http" in record.headers.get("content-type", "")
        for part in parts:
            if isinstance(part, int):
                return record, part
            if in_http:
                http += part
                top, ended, part = http.partition(b"\r\n\r\n")
                if not ended:
                    continue
                record.http, in_http = _fields(top.split(b"\r\n")[1:]), False
            record.payload_bytes += len(part)
            record.sha1.update(part)
        raise NotARecord(f"the record at {at} ends early")


def _row(path: str, at: int, record: Record) -> tuple:
    h = record.headers
    digest = h.get("warc-payload-digest", "").removeprefix("sha1:").upper()
    if h["warc-type"] == "revisit":  # the payload stands in the record referred to
        size, ok = int(record.http.get("content-length") or 0), None
    else:
        own = base64.b32encode(record.sha1.digest()).decode()
        size, ok, digest = record.payload_bytes, not digest or digest == own, own
    return (
        path, at, h.get("warc-record-id"), h["warc-type"], h.get("warc-target-uri"),
        h.get("warc-refers-to"), size, digest, ok,
    )


def read_archives(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A row (``RECORDS``) per record of the files, given by ``path`` and ``bytes``.

    A place where no record begins is passed over up to the next one, so damage
    costs the damaged record only. Empty and null-sized files give no rows.
    """
    ranges = files.where("bytes > 0").select(
        "path", "bytes",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(split_bytes).cast("bigint"))).alias("start"),
    )
    most = max(1, ranges.count())
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                fs, name = task_fs(path)
                with fs.open_input_file(name) as stream:
                    rows = []
                    for at, record in owned(MemberReader(stream, size), start, min(size, start + split_bytes)):
                        rows.append(_row(path, at, record))
                        if len(rows) == 5000:
                            yield _record_batch(rows, names)
                            rows = []
                    if rows:
                        yield _record_batch(rows, names)

    return ranges.repartition(min(most, 10_000)).mapInArrow(read, RECORDS)


def owned(reader: MemberReader, start: int, end: int) -> Iterator[tuple[int, Record]]:
    """Offset and record of each record that starts in the range."""
    at = reader.find(start, end)
    while at is not None and at < end:
        try:
            record, after = reader.record(at)
        except NotARecord:
            at = reader.find(at + 1, end)
            continue
        yield at, record
        at = after


def _record_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
    )


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")


def round_trip(
    pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url",
    payload: str = "html", smallest: int = 0,
) -> DataFrame:
    """Write pages as archives, read the archives back, and describe each record.

    Fails if a file gives another number of records than were written to it.
    """
    spark = pages.sparkSession
    folder = folder or shared_dir(spark)
    files = write_archives(plan_records(pages, key, url, payload, smallest), folder)
    rows = read_archives(spark, files).select(
        page_of(F.col("record_id")).alias(key), "payload_bytes", "payload_digest", "record_type",
        page_of(F.col("refers_to")).alias("refers_to"), "digest_ok", F.col("path").alias("__path"),
    )
    rows = stored(rows, f"{folder}/read")
    check_counts(rows.select(F.col("__path").alias("path")), files)
    return rows.drop("__path")


def check_counts(rows: DataFrame, files: DataFrame) -> None:
    """Raises ``LostRecords`` unless each file has as many rows as its manifest says."""
    read = rows.groupBy("path").agg(F.count(F.lit(1)).alias("found"))
    found = F.coalesce("found", F.lit(0))
    wrong = files.join(read, "path", "left").where(found != F.col("records"))
    named = wrong.select("path", "records", found.alias("found")).limit(20).collect()
    if named:
        raise LostRecords("; ".join(f"{r['path']}: {r['found']} of {r['records']} records" for r in named))
