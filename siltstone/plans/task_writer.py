"""Task-side writing of one gz, bz2, xz or zstd text file per partition."""

from __future__ import annotations

import bz2
import gzip
import lzma
import os
from collections.abc import Iterator

import pyarrow as pa

#: Lines shrink nearly as much as with the default, 6, in about a tenth of the time.
XZ_PRESET = 1
#: Blocks of 100,000 bytes: faster both ways than the default, 900,000, and still split.
BZ2_LEVEL = 1
COPY_BYTES = 8 << 20


def _located(uri: str):
    """A pyarrow file system and the path on it."""
    import pyarrow.fs

    if uri.startswith(("s3a:", "s3n:")):
        uri = "s3" + uri[3:]
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(uri)


def _create(uri: str):
    """A pyarrow file system with the folder made, and the path on it."""
    fs, path = _located(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    return fs, path


def _compressor(stream, codec: str):
    if codec == "gz":
        return gzip.GzipFile(fileobj=stream, mode="wb")
    if codec == "bz2":
        return bz2.BZ2File(stream, "w", compresslevel=BZ2_LEVEL)
    if codec == "xz":
        return lzma.LZMAFile(stream, "w", preset=XZ_PRESET)
    import zstandard

    return zstandard.ZstdCompressor().stream_writer(stream, closefd=False)


class _Rotated:
    """Compresses every ``block_bytes`` of text by itself, wherever lines end."""

    def __init__(self, raw, codec: str, block_bytes: int | None):
        self.raw, self.codec, self.block_bytes = raw, codec, block_bytes
        self.out, self.room = None, 0

    def write(self, data: bytes) -> None:
        while data:
            if self.out is None:
                self.out, self.room = _compressor(self.raw, self.codec), self.block_bytes or 1 << 62
            self.out.write(data[: self.room])
            data, self.room = data[self.room :], self.room - min(self.room, len(data))
            if not self.room:
                self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def write_partition(
    batches: Iterator[pa.RecordBatch], directory: str, codec: str, tail: bytes = b"",
    block_bytes: int | None = None,
) -> Iterator[pa.RecordBatch]:
    """Write a partition's lines; a repeated task replaces its own file."""
    from pyspark import TaskContext

    context = TaskContext.get()
    extension = {"gz": "gz", "bz2": "bz2", "xz": "xz", "zstd": "zst"}[codec]
    name = f"part-{context.partitionId():05d}.json.{extension}"
    fs, draft = _create(f"{directory}/.{name}.{context.taskAttemptId()}")
    with fs.open_output_stream(draft, compression=None) as raw:
        out = _Rotated(raw, codec, block_bytes)
        for batch in batches:
            out.write("".join(f"{line}\n" for line in batch.column(0).to_pylist()).encode())
        if not raw.tell():
            _compressor(raw, codec).close()  # no line: a file of none
        out.close()
        raw.write(tail)
    path = os.path.join(os.path.dirname(draft), name)
    fs.move(draft, path)
    yield pa.RecordBatch.from_pydict({"path": [path]})


def join_files(paths: list[str], directory: str, name: str) -> None:
    """Put the bytes of some files behind each other into one file."""
    from pyspark import TaskContext

    fs, draft = _create(f"{directory}/.{name}.{TaskContext.get().taskAttemptId()}")
    with fs.open_output_stream(draft, compression=None) as out:
        for path in paths:
            source, place = _located(path)
            with source.open_input_stream(place, compression=None) as stream:
                while data := stream.read(COPY_BYTES):
                    out.write(data)
    fs.move(draft, os.path.join(os.path.dirname(draft), name))
