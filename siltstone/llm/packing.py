"""Vector best-fit packing of tokenised texts into training sequences.

Texts are tokenised and cut where they lie; only the numbers of each piece are
shuffled. A task packs its pieces in blocks, longest first: of the open sequences
that keep every capacity, a piece goes to the best one by the chosen score.
"""

from __future__ import annotations

import base64
import sys
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from siltstone.llm.common import slices

#: Pieces that a task packs together; sequences do not span blocks.
BLOCK_PIECES = 8192
TASK_BITS = 33
LOOK_AHEAD = r"\s+(?!\S)|\s+"
#: White space other than single spaces and line ends, and runs of those.
RUNS = ("  ", " \n", "\n\n", *(chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"))


@dataclass(frozen=True)
class Capacity:
    """What a sequence may hold. ``attention`` limits the sum of squared lengths."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024


class FastTokenizer:
    """Ids of a text as little-endian 32-bit bytes, exactly as the tokenizer gives them.

    The rank file of the same vocabulary gives the same ids sooner, the more so
    with a pattern without look-ahead, which is right where no white space follows
    white space but for one space before a visible character. Texts with the string
    of a special token are given to the tokenizer itself.
    """

    def __init__(self, path: str, ranks_path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        pattern = public_tokenizers.PATTERN
        self.general, self.plain = (
            tiktoken.Encoding("ranks", pat_str=p, mergeable_ranks=ranks, special_tokens={})
            for p in (pattern, pattern.replace(LOOK_AHEAD, r"\s"))
        )

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        elif any(s in text for s in RUNS) or text.endswith(" "):
            found = self.general.encode_ordinary(text)
        else:
            found = self.plain.encode_ordinary(text)
        packed = array("I", found)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()


def cut(length: int, most: int) -> list[tuple[int, int]]:
    """Start and length of each piece of a text of ``length`` ids.

    Only longer texts are cut; all pieces but the first are full.
    """
    if length <= most:
        return [(0, length)]
    first = length % most or most
    return [(0, first), *((start, most) for start in range(first, length, most))]


def pieces(docs: DataFrame, tokenizer_path: str, ranks_path: str, end_id: int, most: int, keep: list[Column],
           text: str = "text") -> DataFrame:
    """``keep`` of each row and ``piece, start, length, ids_crc32`` of each of its pieces.

    A null text is empty: it has the end id alone.
    """
    source = docs.select(F.col(text).alias("__text"), *keep)
    schema = (
        source.drop("__text").schema.add("piece", "integer").add("start", "long")
        .add("length", "long").add("ids_crc32", "long")
    )
    end = np.array([end_id], "<u4").tobytes()

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = FastTokenizer(tokenizer_path, ranks_path)
        for batch in slices(batches):
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(0).to_pylist()):
                ids = tokenizer.ids(text or "") + end
                for k, (at, n) in enumerate(cut(len(ids) // 4, most)):
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(ids[4 * at : 4 * (at + n)]))
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(c.take(at) for c in batch.columns[1:]), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=schema.names,
            )

    return source.mapInArrow(tokenise, schema)


class OpenSequences:
    """Sequences of one block that still have room."""

    def __init__(self, capacity: Capacity, score: str, weights: tuple[float, ...]):
        self.capacity, self.score = capacity, score
        self.weights = np.array(weights)
        self.limit = np.array([capacity.tokens, capacity.documents, capacity.attention], np.int64)
        self.scale = self.limit.astype(float)
        self.left = np.empty((0, 3), np.int64)
        self.number = np.empty(0, np.int64)
        self.count = 0  # of those open
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """Put a piece into the best sequence; its number and the offset there."""
        need = np.array([length, 1, length * length], np.int64)
        left = self.left[: self.count]
        fits = np.flatnonzero((left >= need).all(axis=1))
        if len(fits):
            room = left[fits] / self.scale
            own = need / self.scale
            if self.score == "dot":
                best = np.argmax(room @ (self.weights * own))
            else:
                best = np.argmin(((room - own) ** 2) @ self.weights)
            at = int(fits[best])
        else:
            at = self._open()
        offset = int(self.limit[0] - self.left[at, 0])
        self.left[at] -= need
        return int(self.number[at]), offset

    def _open(self) -> int:
        if self.count == len(self.left):
            more = max(64, self.count)
            self.left = np.concatenate([self.left, np.empty((more, 3), np.int64)])
            self.number = np.concatenate([self.number, np.empty(more, np.int64)])
        at = self.count
        self.left[at], self.number[at] = self.limit, self.made
        self.count += 1
        self.made += 1
        return at

    def close(self, shortest: int) -> None:
        """Drop sequences that no piece of this length or longer fits into."""
        need = np.array([shortest, 1, shortest * shortest], np.int64)
        stay = np.flatnonzero((self.left[: self.count] >= need).all(axis=1))
        self.left[: len(stay)], self.number[: len(stay)] = self.left[stay], self.number[stay]
        self.count = len(stay)


def pack_block(
    lengths: np.ndarray, capacity: Capacity, score: str = "norm",
    weights: tuple[float, ...] = (1.0, 1.0, 1.0),
) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence number and offset of each piece, and how many sequences there are.

    Longest first; equal lengths in the given order. A piece that alone breaks a
    capacity raises ValueError.
    """
    lengths = np.asarray(lengths, np.int64)
    if len(lengths) and (
        lengths.max() > capacity.tokens or lengths.max() ** 2 > capacity.attention or capacity.documents < 1
    ):
        raise ValueError("a piece is larger than a sequence may be")
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    shortest = int(lengths.min()) if len(lengths) else 0
    opened = OpenSequences(capacity, score, weights)
    for n, i in enumerate(order):
        sequence[i], offset[i] = opened.place(int(lengths[i]))
        if n % 256 == 255:
            opened.close(shortest)
    return sequence, offset, opened.made


def pack(
    parts: DataFrame, capacity: Capacity = Capacity(), score: str = "norm",
    weights: tuple[float, ...] = (1.0, 1.0, 1.0), length: str = "length",
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows that have a length.

    Every row is placed, in a sequence that keeps all capacities, gapless from
    offset 0. Rows are dealt out evenly whatever their keys, and a task packs
    ``BLOCK_PIECES`` at a time, so a block leaves a few sequences partly empty. Equal rows are
    pieces of their own. Sequence ids are unique over the whole result. No rows
    give no rows.
    """
    dealt = parts.hint("rebalance").sortWithinPartitions(*parts.columns)
    schema = StructType(parts.schema.fields).add("sequence_id", "long").add("offset", "long")
    column = parts.columns.index(length)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << TASK_BITS
        for block in _blocks(batches):
            sequence, offset, made = pack_block(
                block.column(column).to_numpy(), capacity, score, weights
            )
            for out in block.append_column("sequence_id", pa.array(sequence + first)).append_column(
                "offset", pa.array(offset)
            ).to_batches():
                yield pa.RecordBatch.from_arrays(out.columns, names=schema.names)
            first += made

    return dealt.mapInArrow(place, schema)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in slices(batches, BLOCK_PIECES):
        if rows + batch.num_rows > BLOCK_PIECES:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
        held.append(batch)
        rows += batch.num_rows
    if rows:
        yield pa.Table.from_batches(held)
