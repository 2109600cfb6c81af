"""Task-side decompression, for files that Spark cannot read or cannot report on.

Those are xz and zstd, names that Spark hides, and gz and bz2 where damage is to be
reported instead of failing the job.

Runs inside ``mapInArrow``: files in, batches of raw lines out. A file is
streamed in bounded chunks, so memory follows the decode window and the longest
line, not the file.
"""

from __future__ import annotations

import bz2
import gzip
import lzma
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa

BATCH_BYTES = 4 << 20
XZ_READ_BYTES = 1 << 20
XZ_OUT_BYTES = 4 << 20
# zstd input is fed in small pieces because one piece may expand a lot.
ZSTD_READ_BYTES = 64 << 10
# Fixed value: largest accepted zstd window, 2**31 bytes.
ZSTD_MAX_WINDOW = 2**31

LINE_SCHEMA = pa.schema(
    [("file_path", pa.string()), ("value", pa.binary()), ("error", pa.string())]
)


#: What it means that a file cannot be opened. Anything else, such as a file system
#: that is out of reach, is a failure of the job and not of the file.
UNREADABLE = (FileNotFoundError, PermissionError)


class DamagedFile(Exception):
    """The compressed stream ends early or does not decode."""


def open_file(uri: str):
    """Open a file for reading on whatever file system its URI names."""
    scheme = urlparse(uri).scheme
    if scheme in ("", "file"):
        path = uri[len("file:"):] if scheme else uri
        return open("/" + path.lstrip("/"), "rb")
    import pyarrow.fs

    if scheme in ("s3a", "s3n"):
        uri = "s3" + uri[len(scheme):]
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    return fs.open_input_stream(unquote(path), compression=None)


def xz_chunks(stream) -> Iterator[bytes]:
    """All streams of an xz file, padding between and after them passed over."""
    decoder, ended, piece = None, False, b""
    try:
        while True:
            if not piece and (decoder is None or decoder.needs_input):
                piece = stream.read(XZ_READ_BYTES)
                if not piece:
                    break
            if decoder is None:
                piece = piece.lstrip(b"\0") if ended else piece
                if not piece:
                    continue
                decoder = lzma.LZMADecompressor(lzma.FORMAT_XZ)
            out, piece = decoder.decompress(piece, XZ_OUT_BYTES), b""
            if out:
                yield out
            if decoder.eof:
                decoder, ended, piece = None, True, decoder.unused_data
    except lzma.LZMAError as e:
        raise DamagedFile(str(e)) from e
    if decoder is not None:
        raise DamagedFile("ends early")


def _members(stream, new, failure: type[Exception] | tuple) -> Iterator[bytes]:
    """Decode concatenated members, each by a fresh ``new()``; padding of NULs ends them."""
    decoder, ended = None, False
    try:
        while piece := stream.read(ZSTD_READ_BYTES):
            while piece:
                if decoder is None:
                    piece = piece.lstrip(b"\0") if ended else piece
                    if not piece:
                        break
                    decoder = new()
                out = decoder.decompress(piece)
                if out:
                    yield out
                piece = decoder.unused_data if decoder.eof else b""
                if decoder.eof:
                    decoder, ended = None, True
    except failure as e:
        raise DamagedFile(str(e)) from e
    if decoder is not None:
        raise DamagedFile("ends early")


def gz_chunks(stream) -> Iterator[bytes]:
    return _members(stream, lambda: zlib.decompressobj(31), zlib.error)


def bz2_chunks(stream) -> Iterator[bytes]:
    return _members(stream, bz2.BZ2Decompressor, OSError)


def zstd_chunks(stream) -> Iterator[bytes]:
    import zstandard

    context = zstandard.ZstdDecompressor(max_window_size=ZSTD_MAX_WINDOW)
    frame = None
    try:
        while piece := stream.read(ZSTD_READ_BYTES):
            while piece:
                frame = frame or context.decompressobj()
                out = frame.decompress(piece)
                if out:
                    yield out
                piece = frame.unused_data if frame.eof else b""
                if frame.eof:
                    frame = None
    except zstandard.ZstdError as e:
        raise DamagedFile(str(e)) from e
    if frame is not None:
        raise DamagedFile("incomplete frame")


_CHUNKS = {"xz": xz_chunks, "zst": zstd_chunks, "gz": gz_chunks, "bz2": bz2_chunks}
_MAGIC_READERS = {"gz": gzip.open, "bz2": bz2.open}


# How files of each kind start; zstd also has skippable frames.
_STARTS = {
    "gz": (b"\x1f\x8b",),
    "bz2": (b"BZh",),
    "xz": (b"\xfd7zXZ\x00",),
    "zst": (b"\x28\xb5\x2f\xfd", *(bytes([0x50 + i]) + b"\x2a\x4d\x18" for i in range(16))),
}


class _Peeked:
    """A stream of which the first bytes have been read already."""

    def __init__(self, stream, head: bytes):
        self.stream, self.head = stream, head

    def read(self, size: int = -1) -> bytes:
        if self.head:
            head, self.head = self.head, b""
            return head
        return self.stream.read(size)


def split_lines(chunks: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Group chunks into lists of complete lines (newline only, as in the archives)."""
    rest: list[bytes] = []
    for chunk in chunks:
        head, newline, tail = chunk.rpartition(b"\n")
        if not newline:
            rest.append(tail)
            continue
        yield (b"".join(rest) + head).split(b"\n")
        rest = [tail] if tail else []
    if rest:
        yield [b"".join(rest)]


def _line_batch(path: str, lines: list[bytes]) -> pa.RecordBatch:
    n = len(lines)
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(path), n), pa.array(lines, pa.binary()), pa.nulls(n, pa.string())],
        schema=LINE_SCHEMA,
    )


def _error_batch(path: str, error: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [{"file_path": path, "value": None, "error": error}], schema=LINE_SCHEMA
    )


def _read_one(path: str, fail_on_damage: bool) -> Iterator[pa.RecordBatch]:
    try:
        stream = open_file(path)
    except UNREADABLE as e:
        yield _error_batch(path, f"unreadable file: {e}")
        return
    kind = path.rpartition(".")[2]
    with stream:
        head = stream.read(6)
        if head and not head.startswith(_STARTS[kind]):
            yield _error_batch(path, "unreadable file: wrong header")
            return
        lines, size = [], 0
        try:
            for group in split_lines(_CHUNKS[kind](_Peeked(stream, head))):
                lines += group
                size += sum(map(len, group))
                if size >= BATCH_BYTES:
                    yield _line_batch(path, lines)
                    lines, size = [], 0
        except DamagedFile as e:
            if fail_on_damage:
                raise
            yield _line_batch(path, lines)
            lines = []
            yield _error_batch(path, f"damaged file: {e}")
        if lines:
            yield _line_batch(path, lines)


def line_reader(fail_on_damage: bool):
    """A ``mapInArrow`` function from batches with a ``path`` column to lines."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield from _read_one(path, fail_on_damage)

    return read


def open_check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow`` function: an error row per gz or bz2 file that cannot be opened.

    That is a missing file, a refused one, or one with a wrong header; a byte of
    content shows it. Where the file system cannot be reached this way, nothing is
    said, and Spark's own reader judges the file.
    """
    for batch in batches:
        for path in batch.column("path").to_pylist():
            try:
                stream = open_file(path)
            except UNREADABLE as e:
                yield _error_batch(path, f"unreadable file: {e}")
                continue
            except Exception:
                continue
            with stream, _MAGIC_READERS[path.rpartition(".")[2]](stream) as decoded:
                try:
                    decoded.read(1)
                except EOFError:
                    continue  # starts well and ends early: damage, not a failure to open
                except OSError as e:
                    if e.errno is None:  # from the decoder, not from the file system
                        yield _error_batch(path, f"unreadable file: {e}")
