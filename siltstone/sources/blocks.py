"""Parts of xz and zstd files that can be decoded by themselves.

An xz file ends in an index of its blocks; a zstd file is a row of frames, listed in a
seek table where the writer made one and otherwise found by walking over their block
headers. A part is a run of blocks or frames. It owns the lines that start behind its
first byte, up to one that starts right behind its last: its reader drops the piece of a
line it begins with and reads on into the next part to the end of its last line. So
every line has one owner, wherever the cuts fall.
"""

from __future__ import annotations

import lzma
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa

from siltstone.sources import decoders
from siltstone.sources.decoders import DamagedFile

READ_BYTES = 1 << 20
WALK_BYTES = 4 << 20
OUT_BYTES = 4 << 20
#: What stands for a file that is read as a whole.
WHOLE = -1



class Part(NamedTuple):
    """Part of a file: where its first block or frame begins and the one behind it, its
    compressed size, and the end of the stream (xz) that its last block is in."""

    path: str
    start: int
    stop: int
    size: int
    end: int


PART_DDL = "path string, start bigint, stop bigint, size bigint, end bigint"
PART_SCHEMA = pa.schema([("path", pa.string()), *((n, pa.int64()) for n in ("start", "stop", "size", "end"))])

# Fixed values of the two formats.
XZ_HEADER, XZ_MAGIC, XZ_FOOTER_MAGIC = 12, b"\xfd7zXZ\x00", b"YZ"
ZSTD_MAGIC, SKIPPABLE, SEEKABLE_MAGIC = 0xFD2FB528, 0x184D2A50, 0x8F92EAB1
SEEK_TABLE = 0x184D2A5E


class BadLayout(Exception):
    """The file does not tell its parts; it is read as a whole, which reports damage."""


@dataclass(frozen=True)
class Block:
    """A block of an xz file: where its stream and itself begin, its length and that of its text."""

    header: int
    offset: int
    length: int
    expanded: int


def open_seekable(uri: str):
    """A file for random access, and its size."""
    from urllib.parse import unquote, urlparse

    scheme = urlparse(uri).scheme
    if scheme in ("", "file"):
        stream = decoders.open_file(uri)
        size = stream.seek(0, 2)
        stream.seek(0)
        return stream, size
    import pyarrow.fs

    if scheme in ("s3a", "s3n"):
        uri = "s3" + uri[len(scheme):]
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    stream = fs.open_input_file(unquote(path))
    return stream, stream.size()


def _at(stream, offset: int, length: int) -> bytes:
    stream.seek(offset)
    found = stream.read(length)
    if len(found) != length:
        raise BadLayout
    return found


# --- xz ------------------------------------------------------------------------------


def _number(data: bytes, at: int) -> tuple[int, int]:
    """A number of seven bits a byte, and the place behind it."""
    value = 0
    for i in range(9):
        if at + i >= len(data):
            raise BadLayout
        byte = data[at + i]
        value |= (byte & 0x7F) << (7 * i)
        if not byte & 0x80:
            return value, at + i + 1
    raise BadLayout


def xz_blocks(stream, end: int, least: int = 0) -> list[Block]:
    """Blocks of the streams between two places, from the indexes at the streams' ends.

    From the stream that ``least`` lies in, which is the file's first, to one that ends at
    ``end``, which is the file's size for all of them.
    """
    streams = []
    while end > least:
        if end < 2 * XZ_HEADER or end % 4:
            raise BadLayout
        footer = _at(stream, end - XZ_HEADER, XZ_HEADER)
        if footer == bytes(XZ_HEADER) or footer[-4:] == bytes(4):
            end -= 4  # padding between streams
            continue
        if footer[-2:] != XZ_FOOTER_MAGIC:
            raise BadLayout
        index_size = (struct.unpack("<I", footer[4:8])[0] + 1) * 4
        index_at = end - XZ_HEADER - index_size
        if index_at < XZ_HEADER:
            raise BadLayout
        index = _at(stream, index_at, index_size)
        count, at = _number(index, 1)
        sizes = []
        for _ in range(count):
            unpadded, at = _number(index, at)
            expanded, at = _number(index, at)
            sizes.append((-(-unpadded // 4) * 4, expanded))
        start = index_at - sum(length for length, _ in sizes) - XZ_HEADER
        if start < 0 or index[0] or _at(stream, start, 6) != XZ_MAGIC:
            raise BadLayout
        offset, blocks = start + XZ_HEADER, []
        for length, expanded in sizes:
            blocks.append(Block(start, offset, length, expanded))
            offset += length
        streams.append(blocks)
        end = start
    return [b for blocks in reversed(streams) for b in blocks]


def xz_ends(blocks: list[Block], size: int) -> list[int]:
    """For each block of a file a place where its stream, or padding behind it, ends."""
    ends = [size] * len(blocks)
    for i in range(len(blocks) - 2, -1, -1):
        following = blocks[i + 1]
        ends[i] = ends[i + 1] if following.header == blocks[i].header else following.header
    return ends


def xz_chunks_between(stream, start: int, end: int, size: int) -> Iterator[tuple[int, bytes]]:
    """Text from the block at ``start`` on, each piece with the place of its block.

    Only the indexes of the streams up to ``end`` are read. What follows is decoded as it
    comes, and its place is that of the file's end.
    """
    blocks = xz_blocks(stream, end, start)
    places = [b.offset for b in blocks]
    first = places.index(start) if start else 0
    for number, out in xz_chunks_from(stream, blocks, first):
        yield places[number], out
    if end < size:
        stream.seek(end)
        for out in decoders.xz_chunks(stream):
            yield size, out


def xz_chunks_from(stream, blocks: list[Block], first: int) -> Iterator[tuple[int, bytes]]:
    """Text from block ``first`` on, each piece with the number of its block.

    A decoder that has read a stream's header takes any run of its blocks.
    """
    header, decoder = None, None
    try:
        for number in range(first, len(blocks)):
            block = blocks[number]
            if block.header != header:
                header, decoder = block.header, lzma.LZMADecompressor(lzma.FORMAT_XZ)
                decoder.decompress(_at(stream, header, XZ_HEADER))
            stream.seek(block.offset)
            left, made = block.length, 0
            while left or made < block.expanded:
                data = b""
                if decoder.needs_input:
                    data = stream.read(min(left, READ_BYTES))
                    if not data:
                        raise DamagedFile("ends early")
                    left -= len(data)
                out = decoder.decompress(data, OUT_BYTES)
                made += len(out)
                if out:
                    yield number, out
    except (lzma.LZMAError, EOFError, BadLayout) as e:
        raise DamagedFile(str(e)) from e


# --- zstd ----------------------------------------------------------------------------


def _seek_table(stream, size: int) -> list[int] | None:
    """Starts of the frames from the table at the file's end, if there is one."""
    if size < 17:
        return None
    tail = _at(stream, size - 9, 9)
    frames, descriptor, magic = struct.unpack("<IBI", tail)
    if magic != SEEKABLE_MAGIC or descriptor & 0x7C:
        return None
    entry = 12 if descriptor & 0x80 else 8
    table_size = frames * entry + 9
    if table_size + 8 > size:
        return None
    head = struct.unpack("<II", _at(stream, size - table_size - 8, 8))
    if head != (SEEK_TABLE, table_size):
        return None
    table = _at(stream, size - table_size, frames * entry)
    starts, offset = [], 0
    for i in range(frames):
        starts.append(offset)
        offset += struct.unpack_from("<I", table, i * entry)[0]
    if offset != size - table_size - 8:
        return None
    return starts


class _Window:
    """Reads forward in large pieces; headers lie at most 128 KB apart."""

    def __init__(self, stream, size: int):
        self.stream, self.size, self.start, self.data = stream, size, 0, b""

    def get(self, offset: int, length: int) -> bytes:
        if offset + length > self.size:
            raise BadLayout
        if not self.start <= offset <= offset + length <= self.start + len(self.data):
            self.stream.seek(offset)
            self.start, self.data = offset, self.stream.read(max(length, WALK_BYTES))
        at = offset - self.start
        found = self.data[at : at + length]
        if len(found) != length:
            raise BadLayout
        return found


def _frame_end(window: _Window, offset: int) -> int:
    """The place behind the frame that begins at ``offset``, from its headers."""
    magic = struct.unpack("<I", window.get(offset, 4))[0]
    if magic & ~0xF == SKIPPABLE:
        return offset + 8 + struct.unpack("<I", window.get(offset + 4, 4))[0]
    if magic != ZSTD_MAGIC:
        raise BadLayout
    descriptor = window.get(offset + 4, 1)[0]
    single = descriptor & 0x20
    content = (1 if single else 0, 2, 4, 8)[descriptor >> 6]
    at = offset + 5 + (0 if single else 1) + (0, 1, 2, 4)[descriptor & 3] + content
    last = False
    while not last:
        head = int.from_bytes(window.get(at, 3), "little")
        last, kind, length = bool(head & 1), head >> 1 & 3, head >> 3
        if kind == 3:
            raise BadLayout
        at += 3 + (1 if kind == 1 else length)
    return at + (4 if descriptor & 4 else 0)


def zstd_frames(stream, size: int) -> list[int]:
    """Starts of all frames of a file."""
    starts = _seek_table(stream, size)
    if starts is not None:
        return starts
    window, starts, offset = _Window(stream, size), [], 0
    while offset < size:
        starts.append(offset)
        offset = _frame_end(window, offset)
    if offset != size:
        raise BadLayout
    return starts


def zstd_chunks_from(stream, start: int) -> Iterator[tuple[int, bytes]]:
    """Text from the frame at ``start`` on, each piece with the place of its frame."""
    import zstandard

    context = zstandard.ZstdDecompressor(max_window_size=decoders.ZSTD_MAX_WINDOW)
    stream.seek(start)
    frame, begun, read = None, start, start
    try:
        while piece := stream.read(decoders.ZSTD_READ_BYTES):
            read += len(piece)
            while piece:
                frame = frame or context.decompressobj()
                out = frame.decompress(piece)
                if out:
                    yield begun, out
                piece = frame.unused_data if frame.eof else b""
                if frame.eof:
                    frame, begun = None, read - len(piece)
    except zstandard.ZstdError as e:
        raise DamagedFile(str(e)) from e
    if frame is not None:
        raise DamagedFile("incomplete frame")


# --- parts ---------------------------------------------------------------------------


def _runs(sizes: list[int], part_bytes: int) -> Iterator[tuple[int, int, int]]:
    """First, behind the last, and total size of neighbours that make up a part."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= part_bytes or i == len(sizes) - 1:
            yield first, i + 1, total
            first, total = i + 1, 0


def parts_of(path: str, part_bytes: int) -> list[tuple[str, int, int, int, int]]:
    """The parts of a file, of about ``part_bytes`` each, with the columns of ``Part``."""
    try:
        stream, size = open_seekable(path)
    except decoders.UNREADABLE:
        return [(path, WHOLE, WHOLE, 0, 0)]
    with stream:
        try:
            if path.endswith(".xz"):
                blocks = xz_blocks(stream, size)
                ends, starts = xz_ends(blocks, size), [0, *(b.offset for b in blocks[1:]), size]
                runs = [
                    (starts[a], starts[b], n, ends[b - 1])
                    for a, b, n in _runs([b.length for b in blocks], part_bytes)
                ]
            else:
                starts = [*zstd_frames(stream, size), size]
                lengths = [b - a for a, b in zip(starts, starts[1:])]
                runs = [(starts[a], starts[b], n, starts[b]) for a, b, n in _runs(lengths, part_bytes)]
        except BadLayout:
            runs = []
    if len(runs) <= 1:
        return [(path, WHOLE, WHOLE, size, size)]
    return [(path, *run) for run in runs]


def part_lister(part_bytes: int):
    """A ``mapInArrow`` function from batches with a ``path`` column to parts."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [p for path in batch.column("path").to_pylist() for p in parts_of(path, part_bytes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), PART_SCHEMA)] if rows
                else [pa.array([], f.type) for f in PART_SCHEMA],
                schema=PART_SCHEMA,
            )

    return parts


def owned_lines(
    chunks: Iterator[tuple[int, bytes]], owns: Callable[[int], bool], first: bool
) -> Iterator[list[bytes]]:
    """Lines that a part owns, from its text and what follows it."""
    skipping, rest = not first, []
    for place, chunk in chunks:
        if owns(place):
            if skipping:
                _, newline, chunk = chunk.partition(b"\n")
                if not newline:
                    continue
                skipping = False
            head, newline, tail = chunk.rpartition(b"\n")
            if newline:
                yield (b"".join(rest) + head).split(b"\n")
                rest = []
            if tail:
                rest.append(tail)
        elif skipping:
            return
        else:
            head, newline, _ = chunk.partition(b"\n")
            rest.append(head)
            if newline:
                yield [b"".join(rest)]
                return
    if rest:
        yield [b"".join(rest)]


def _read_part(path: str, start: int, stop: int, end: int | None = None) -> Iterator[list[bytes]]:
    stream, size = open_seekable(path)
    with stream:
        if path.endswith(".xz"):
            chunks = xz_chunks_between(stream, start, size if end is None else end, size)
        else:
            chunks = zstd_chunks_from(stream, start)
        try:
            yield from owned_lines(chunks, lambda place: place < stop, start == 0)
        except (BadLayout, ValueError) as e:
            raise DamagedFile("changed since it was listed") from e


def part_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow`` function from parts to lines. Damage fails the task."""
    for batch in batches:
        for path, start, stop, end in zip(
            *(batch.column(c).to_pylist() for c in ("path", "start", "stop", "end"))
        ):
            if start == WHOLE:
                yield from decoders._read_one(path, True)
                continue
            lines, size = [], 0
            for group in _read_part(path, start, stop, end):
                lines += group
                size += sum(map(len, group))
                if size >= decoders.BATCH_BYTES:
                    yield decoders._line_batch(path, lines)
                    lines, size = [], 0
            if lines:
                yield decoders._line_batch(path, lines)
