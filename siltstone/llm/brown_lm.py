"""Class-based bigram language model (Brown) with exchange clustering.

Word counts come from the whole corpus. The most frequent words are units of
their own, all others share units by their last bytes; exchange clustering puts
units into classes so that neighbouring classes tell most about each other. From
there every word of at least ``least_count`` occurrences is exchanged by itself: its
neighbours' classes are counted in Spark, and all words choose against one table. A text's
probability is that of its classes, one after the other, times that of each word in
its class.

Texts are coded once: tasks hold the numbers of the frequent words, the others stay as
bytes. Each occurrence of such a rare word sends a row with its neighbours' classes and
its place to where the word is counted, and gets its class and count back by that place,
so rare words need no table that a task or the driver would have to hold.
"""

from __future__ import annotations

import contextlib
import ctypes
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import discard, shared_dir, slices, stored

#: The end of a text, which no word is.
END = b""
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 400_000
TASK_BITS = 33
#: Texts that a task cuts into words, and coded texts that it works on, at a time.
CUT_TEXTS = 1500
SLICE = 400


def tidy(task):
    """A ``mapInArrow`` function that gives freed memory back to the system when it ends,
    as its worker lives on beside others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(AttributeError, OSError):
                ctypes.CDLL(None).malloc_trim(0)

    return run


#: Classes within numbers, and as texts store them.
CLASS_BITS = 16
CLASS_TYPE = np.uint16


@dataclass(frozen=True)
class BrownSettings:
    """``head_words`` bounds the words whose counts every task holds; the counts of
    all others are joined. The bigram table has (cluster_words + suffixes)**2 cells."""

    head_words: int = 200_000
    cluster_words: int = 1500
    suffixes: int = 300
    classes: int = 64
    sweeps: int = 6
    add: float = 0.1  # to each count of a word in its class
    prior: float = 10.0  # weight of class frequencies in transitions
    least_count: int | None = None  # words so frequent choose classes; None: units only
    word_sweeps: int = 2

    @property
    def units(self) -> int:
        return self.cluster_words + self.suffixes


def words(text: bytes | None) -> list[bytes]:
    """Words after lower-casing A-Z, parted by space and \\t to \\r; null has none."""
    return (text or b"").lower().split()


class Words:
    """``words`` of a column of texts: the distinct ones, and those of all texts in a row by
    their numbers, with the text of each."""

    def __init__(self, texts: pa.Array):
        found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        flat = found.flatten()
        real = pc.greater(pc.binary_length(flat), 0)  # white space at an end leaves an empty piece
        text = np.repeat(np.arange(len(texts)), found.value_lengths().to_numpy())
        self.text = text[real.to_numpy(zero_copy_only=False)]
        coded = flat.filter(real).dictionary_encode()
        self.numbers = coded.indices.to_numpy()
        self.distinct = coded.dictionary.cast(pa.binary())


# --- Counts over the corpus ------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """``w, n``: how often each word and the end occur in the one text column."""

    def summed(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by("w").aggregate([("n", "sum")]).rename_columns(["w", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, ends = [], 0, 0
        for batch in slices(batches, CUT_TEXTS):
            found = Words(batch.column(0))
            ends += batch.num_rows
            n = np.bincount(found.numbers, minlength=len(found.distinct))
            held.append(pa.table({"w": found.distinct, "n": n}))
            rows += len(n)
            if rows > 2 * HELD_WORDS:
                held = [summed(held)]
                rows = held[0].num_rows
                if rows > HELD_WORDS:
                    yield from held[0].combine_chunks().to_batches()
                    held, rows = [], 0
        if ends:
            held.append(pa.table({"w": pa.array([END], pa.binary()), "n": np.array([ends])}))
            yield from summed(held).combine_chunks().to_batches()

    return texts.mapInArrow(tidy(count), "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))


def _band(n: str) -> Column:
    return F.floor(F.log2(n) * 8).cast("int")


def frequent(counts: DataFrame, most: int) -> tuple[list[tuple[bytes, int]], int]:
    """At most about ``most`` words, those of the highest counts, and a band of counts
    from which on all words are among them. The end always is."""
    bands = sorted(((r[0], r[1]) for r in counts.groupBy(_band("n")).count().collect()), reverse=True)
    total, least = 0, 1 << 30
    for band, size in bands:
        if total + size > most:
            break
        total, least = total + size, band
    chosen = counts.where((_band("n") >= least) | (F.col("w") == F.lit(bytearray(END)))).collect()
    pairs = {bytes(r["w"]): r["n"] for r in chosen}
    pairs.setdefault(END, 0)
    return sorted(pairs.items(), key=lambda p: (p[0] != END, -p[1], p[0])), least


class UnitOf(dict):
    """Unit of a word: its own, or that of its last bytes."""

    def __init__(self, head: list[bytes], settings: BrownSettings):
        super().__init__((w, i) for i, w in enumerate(head[: settings.cluster_words]))
        self.first, self.suffixes = settings.cluster_words, settings.suffixes

    def __missing__(self, word: bytes) -> int:
        return self.first + zlib.crc32(word[-3:]) % self.suffixes


def _add_pairs(total: np.ndarray, units: np.ndarray, u: int) -> None:
    codes = np.asarray(units, np.int64)
    total += np.bincount(codes[:-1] * u + codes[1:], minlength=u * u)


def _arrow_batches(df: DataFrame) -> Iterator[tuple[np.ndarray, ...]]:
    table = df.toArrow()
    yield tuple(table.column(i).to_numpy() for i in range(table.num_columns))


def unit_sizes(counts: DataFrame, head: list[bytes], settings: BrownSettings) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each unit."""
    shared = counts.sparkSession.sparkContext.broadcast(head[: settings.cluster_words])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = UnitOf(shared.value, settings)
        tokens, types = np.zeros(settings.units, np.int64), np.zeros(settings.units, np.int64)
        for batch in slices(batches, 100_000):
            at = np.fromiter(map(unit.__getitem__, batch.column(0).to_pylist()), np.int64, batch.num_rows)
            np.add.at(tokens, at, batch.column(1).to_numpy())
            np.add.at(types, at, 1)
        found = np.flatnonzero(types)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(tokens[found]), pa.array(types[found])], names=["u", "tokens", "types"]
        )

    tokens, types = np.zeros(settings.units), np.zeros(settings.units)
    added = counts.select("w", "n").mapInArrow(add, "u long, tokens long, types long")
    for row in added.groupBy("u").agg(F.sum("tokens"), F.sum("types")).collect():
        tokens[row[0]], types[row[0]] = row[1], row[2]
    return tokens, types


# --- Classes ---------------------------------------------------------------


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def information(table: np.ndarray) -> float:
    """What exchange raises: the log likelihood of class bigrams, up to a constant."""
    return float(_f(table).sum() - _f(table.sum(axis=0)).sum() - _f(table.sum(axis=1)).sum())


def exchange(pairs: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Class of each unit, given how often units follow each other.

    Units start dealt out over the classes in order; one after the other is taken
    out and put where the likelihood is highest, the class it had if equal, until a
    sweep moves none.
    """
    u = len(pairs)
    own = np.arange(u) % classes
    table = np.zeros((classes, classes))
    np.add.at(table, (own[:, None], own[None, :]), pairs)
    used = np.flatnonzero(pairs.sum(axis=0) + pairs.sum(axis=1))
    diagonal = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for i in used:
            out, into, self_ = pairs[i].copy(), pairs[:, i].copy(), pairs[i, i]
            out[i] = into[i] = 0
            right = np.bincount(own, out, classes)
            left = np.bincount(own, into, classes)
            old = own[i]
            table[old, :] -= right
            table[:, old] -= left
            table[old, old] -= self_
            base = _f(table)
            # What the unit follows and what follows it belongs to some class in any case.
            rows, columns = table.sum(axis=1) + left, table.sum(axis=0) + right
            a = _f(table + right[None, :]) - base
            b = _f(table + left[:, None]) - base
            both = _f(table[diagonal, diagonal] + right + left + self_) - base[diagonal, diagonal]
            gain = a.sum(axis=1) - a[diagonal, diagonal] + b.sum(axis=0) - b[diagonal, diagonal] + both
            gain -= _f(rows + right.sum() + self_) - _f(rows) + _f(columns + left.sum() + self_) - _f(columns)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            own[i] = new
            table[new, :] += right
            table[:, new] += left
            table[new, new] += self_
            moved += new != old
        if not moved:
            break
    return own


@dataclass(frozen=True)
class BrownModel:
    """``step[j, k]``: log10 probability of class k after j. ``size[k]``: log10 of what
    counts in class k are divided by; ``total`` and ``whole`` are those without classes."""

    settings: BrownSettings
    head: list[tuple[bytes, int]]
    least_band: int
    unit_class: np.ndarray
    head_class: np.ndarray
    step: np.ndarray
    size: np.ndarray
    tokens: int
    whole: float


def head_units(head: list[tuple[bytes, int]], settings: BrownSettings) -> np.ndarray:
    unit = UnitOf([w for w, _ in head], settings)
    return np.fromiter((unit[w] for w, _ in head), np.int64, len(head))


def model_of(
    settings: BrownSettings, head: list[tuple[bytes, int]], least: int, own: np.ndarray, head_class: np.ndarray,
    table: np.ndarray, class_tokens: np.ndarray, class_types: np.ndarray, total: tuple,
) -> BrownModel:
    often = (class_tokens + 0.5) / (class_tokens.sum() + 0.5 * settings.classes)
    step = (table + settings.prior * often) / (table.sum(axis=1, keepdims=True) + settings.prior)
    return BrownModel(
        settings, head, least, own, head_class, np.log10(step),
        np.log10(class_tokens + settings.add * (class_types + 1)), int(total[0]),
        float(np.log10(total[0] + 0.1 * (total[1] + 1))),
    )


def class_table(pairs: np.ndarray, own: np.ndarray, classes: int) -> np.ndarray:
    table = np.zeros((classes, classes))
    np.add.at(table, (own[:, None], own[None, :]), pairs)
    return table


@dataclass(frozen=True)
class Counted:
    """Counts over the training texts: the stored table of all words, the frequent ones,
    and tokens and distinct words in all."""

    words: DataFrame
    head: list[tuple[bytes, int]]
    least_band: int
    total: tuple


def count_words(texts: DataFrame, settings: BrownSettings, folder: str) -> Counted:
    """Counts of one column of texts."""
    counts = stored(word_counts(texts), f"{folder}/words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
    return Counted(counts, *frequent(counts, settings.head_words), total)


def train_units(coded: DataFrame, counted: Counted, settings: BrownSettings) -> tuple[BrownModel, np.ndarray]:
    """The model of units from coded texts, and its table of classes."""
    units = head_units(counted.head, settings)
    suffix_units = np.arange(settings.cluster_words, settings.units)
    pairs = count_classes(coded.where("__train"), units, suffix_units, settings.units)
    tokens, types = unit_sizes(counted.words, [w for w, _ in counted.head], settings)
    own = exchange(pairs, settings.classes, settings.sweeps)
    table = class_table(pairs, own, settings.classes)
    sizes = np.bincount(own, tokens, settings.classes), np.bincount(own, types, settings.classes)
    return model_of(settings, counted.head, counted.least_band, own, own[units], table, *sizes, counted.total), table


# --- Classes of single words -----------------------------------------------


def suffix_classes(model: BrownModel) -> np.ndarray:
    return model.unit_class[model.settings.cluster_words :]


def packed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary column with each row's run of the values."""
    edges = np.append(0, np.cumsum(sizes * values.itemsize))
    if edges[-1] >= 1 << 31:
        raise ValueError("a batch of texts with more than 2 GB of words")
    buffers = [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(sizes), buffers)


def unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of a ``packed`` column in a row, and how many each row has."""
    edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    size = np.dtype(kind).itemsize
    if data is None or not len(column):
        return np.zeros(0, kind), np.zeros(len(column), np.int64)
    values = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]].view(kind)
    return values, np.diff(edges).astype(np.int64) // size


class Coded:
    """A batch of coded texts as one run of tokens: numbers, classes, and rare words.

    ``flat`` has the number of a frequent word, or -1 - k for the k-th of the text's
    ``__tail``; ``classes`` come from ``__class`` where the texts have it already, and else
    from the words, those of rare ones from their last bytes.
    """

    def __init__(self, batch: pa.RecordBatch, head_class: np.ndarray, suffix_class: np.ndarray):
        tail = batch.column("__tail")
        self.flat, self.sizes = unpacked(batch.column("__seq"), np.int32)
        self.tail = tail.flatten()
        self.tail_sizes = tail.value_lengths().to_numpy()
        self.first = np.cumsum(np.append(0, self.tail_sizes))[:-1]
        self.in_tail = np.flatnonzero(self.flat < 0)
        self.tail_at = np.repeat(self.first, self.sizes)[self.in_tail] - 1 - self.flat[self.in_tail]
        if "__class" in batch.schema.names:
            self.classes = unpacked(batch.column("__class"), CLASS_TYPE)[0].astype(np.int32)
        else:
            self.classes = head_class[np.maximum(self.flat, 0)].astype(np.int32)
            suffix = unpacked(batch.column("__tail_suffix"), np.uint16)[0]
            self.classes[self.in_tail] = suffix_class[suffix[self.tail_at]]


def count_classes(coded: DataFrame, head_class: np.ndarray, suffix_class: np.ndarray, classes: int) -> np.ndarray:
    """How often one class follows another."""
    shared = coded.sparkSession.sparkContext.broadcast((head_class, suffix_class))
    made = "__class" in coded.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_head, of_suffix = shared.value
        total = np.zeros(classes * classes, np.int64)
        for batch in slices(batches, SLICE):
            if made:
                found = unpacked(batch.column(0), CLASS_TYPE)[0]
            else:
                found = Coded(batch, of_head, of_suffix).classes
            _add_pairs(total, np.append(of_head[0], found), classes)
        pairs = np.flatnonzero(total)
        for at in range(0, len(pairs), 100_000):
            some = pairs[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["pair", "n"])

    table = np.zeros(classes * classes)
    # A task gives up to a row per cell, so there are no more tasks than keep all cores busy.
    tasks = 2 * coded.sparkSession.sparkContext.defaultParallelism
    read = coded.select(*(["__class"] if made else ["__seq", "__tail", "__tail_suffix"])).coalesce(tasks)
    for batch in _arrow_batches(read.mapInArrow(tidy(count), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))):
        table[batch[0]] = batch[1]
    return table.reshape(classes, classes)


#: Frequent words whose neighbours travel in one row.
TOGETHER = 256
HELD_TOKENS = 3_000_000
#: Rows of rare words that are decided together, and up to which count a table tells what
#: a class gains.
DECIDED_ROWS = 200_000
DECIDED_WORDS = 8192
TABLED = 24

NEIGHBOURS = "k binary, v long, g long, s int, b binary"
CHOSEN = "kind int, g long, s int, c int, n long"
IN_HEAD, PLACED, STAYED, CHOSE = range(4)


def _narrow(numbers: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the largest takes, that width first."""
    kind = np.min_scalar_type(numbers.max())
    return bytes([kind.itemsize]) + numbers.astype(kind).tobytes()


def _wide(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"u{packed[0]}", offset=1).astype(np.int64)


def neighbour_counts(coded: DataFrame, head_class: np.ndarray, suffix_class: np.ndarray, classes: int) -> DataFrame:
    """Classes after and before words, over the training texts (``NEIGHBOURS``).

    Frequent words come ``TOGETHER`` to a row, counted; each occurrence of a rare word in
    one of its own, with its place, and those of other texts for the place alone.
    """
    shared = coded.sparkSession.sparkContext.broadcast((head_class, suffix_class))
    width = 2 * classes
    names = [c.split(" ")[0] for c in NEIGHBOURS.split(", ")]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def head_rows(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.unique(np.concatenate(held), return_counts=True)
        block = codes // (width * TOGETHER)
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        keys, data = [], []
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(codes)]):
            at = int(block[start])
            keys.append(b"h" + at.to_bytes(4, "big"))
            some = _narrow(codes[start:end] - at * TOGETHER * width)
            data.append(len(some).to_bytes(4, "big") + some + _narrow(counts[start:end]))
        n = len(keys)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, kinds[0]), pa.array(np.zeros(n, np.int64)), pa.nulls(n, kinds[2]),
             pa.nulls(n, kinds[3]), pa.array(data, kinds[4])], names=names,
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_head, of_suffix = shared.value
        held, size = [], 0
        for batch in slices(batches, SLICE):
            if not batch.num_rows:
                continue
            part = Coded(batch, of_head, of_suffix)
            train = batch.column("__train").to_numpy(zero_copy_only=False)
            learned = np.repeat(train, part.sizes)
            # Every text ends with the end, which so comes before each first word.
            before_n = np.append(0, part.flat[:-1])
            before_c = np.append(of_head[0], part.classes[:-1])
            after = learned & (before_n >= 0) & (before_n < len(of_head))
            code = np.int32 if len(of_head) * width < 1 << 31 else np.int64
            held.append(before_n[after].astype(code) * code(width) + part.classes[after].astype(code))
            own = learned & (part.flat >= 0) & (part.flat < len(of_head))
            held.append(part.flat[own].astype(code) * code(width) + code(classes) + before_c[own].astype(code))
            size += len(held[-1])
            if len(part.in_tail):
                yield tail_rows(batch, part, learned, before_c)
            if size > HELD_TOKENS:
                yield from head_rows(held)
                held, size = [], 0
        if size:
            yield from head_rows(held)

    def tail_rows(batch: pa.RecordBatch, part: Coded, learned: np.ndarray, before_c: np.ndarray) -> pa.RecordBatch:
        at = part.in_tail
        v = learned[at].astype(np.int64)
        for more in (part.classes[at], part.classes[at + 1], before_c[at]):
            v = (v << CLASS_BITS) + more
        text = np.repeat(np.arange(len(part.sizes)), part.sizes)[at]
        group, place = batch.column("__gid").to_numpy(), batch.column("__tail_at").to_numpy()
        keys = pc.binary_join_element_wise(pa.scalar(b"w"), part.tail.take(pa.array(part.tail_at)), pa.scalar(b""))
        slot = place[text] + part.tail_at - part.first[text]
        return pa.RecordBatch.from_arrays(
            [keys, pa.array(v), pa.array(group[text]), pa.array(slot, kinds[3]), pa.nulls(len(v), kinds[4])], names=names,
        )

    columns = ["__seq", "__tail", "__train", "__gid", "__tail_at"]
    columns += [c for c in ("__class", "__tail_suffix") if c in coded.columns]
    return coded.select(*columns).mapInArrow(tidy(count), NEIGHBOURS)


def _entries(word: np.ndarray, found: np.ndarray, classes: int) -> tuple[np.ndarray, ...]:
    """Word, class and count of each pair that occurs, by word and class."""
    codes, counts = np.unique(word * classes + found, return_counts=True)
    return codes // classes, codes % classes, counts


def tabled_gains(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What small counts add to a cell's share of the likelihood: by count, neighbour and
    candidate class, for classes after a word and before it."""
    counts = np.arange(TABLED + 1, dtype=float)[:, None, None]
    return tuple(_f(cells[None] + counts) - _f(cells)[None] for cells in (table.T, table))


def best_classes(
    table: np.ndarray, right: tuple[np.ndarray, ...], left: tuple[np.ndarray, ...], old: np.ndarray,
    tabled: tuple[np.ndarray, np.ndarray] | None = None,
) -> np.ndarray:
    """Best class of each word, all others staying. ``right`` and ``left`` have the word,
    class and count of the classes after and before words, by word and class. The class
    that a word has stays if equal.

    Taking a word out changes the row and column of its old class by its own counts. What
    a class gains is read from the table as it is, and mended where that change matters.
    """
    tabled = tabled_gains(table) if tabled is None else tabled
    if len(old) > DECIDED_WORDS:
        out = []
        for first in range(0, len(old), DECIDED_WORDS):
            sides = []
            for w, j, r in (right, left):
                at = slice(*np.searchsorted(w, (first, first + DECIDED_WORDS)))
                sides.append((w[at] - first, j[at], r[at]))
            out.append(best_classes(table, *sides, old[first : first + DECIDED_WORDS], tabled))
        return np.concatenate(out)
    c, n = len(table), len(old)
    gain = np.zeros((n, c))
    sums_after, sums_before = np.zeros(n), np.zeros(n)
    own_after, own_before = np.zeros(n), np.zeros(n)
    for (w, j, r), sums, own in ((right, sums_after, own_after), (left, sums_before, own_before)):
        np.add.at(sums, w, r)
        same = j == old[w]
        own[w[same]] = r[same]
    # cells[j]: by candidate class
    for (w, j, r), cells, small in ((right, table.T, tabled[0]), (left, table, tabled[1])):
        for at in range(0, len(w), 50_000):
            some = slice(at, at + 50_000)
            ww, jj, rr = w[some], j[some], r[some]
            gained = small[np.minimum(rr, TABLED), jj]
            large = np.flatnonzero(rr > TABLED)
            if len(large):
                base = cells[jj[large]]
                gained[large] = _f(base + rr[large, None]) - _f(base)
            starts = np.flatnonzero(np.diff(ww, prepend=-1))
            gain[ww[starts]] += np.add.reduceat(gained, starts)

    def put(w: np.ndarray, at: np.ndarray, plain: np.ndarray, true: np.ndarray, r: np.ndarray) -> None:
        true = np.maximum(true, 0)
        np.add.at(gain, (w, at), _f(true + r) - _f(true) - _f(plain + r) + _f(plain))

    for (w, j, r), cells, own, other in ((right, table, own_after, own_before), (left, table.T, own_before, own_after)):
        o = old[w]
        # In the old class: without the word's own counts.
        plain = cells[o, j]
        put(w, o, plain, plain - r - np.where(j == o, other[w], 0), r)
        # Classes j on this side, as candidates whose cell with the old class the word
        # has counts in from the other side.
        both = np.flatnonzero((j != o) & (other[w] > 0))
        plain = cells[o[both], j[both]]
        put(w[both], j[both], plain, plain - r[both], other[w[both]])
    # A class on both sides gets both counts into one cell.
    _, a, b = np.intersect1d(right[0] * c + right[1], left[0] * c + left[1], assume_unique=True, return_indices=True)
    w, j, r, l_ = right[0][a], right[1][a], right[2][a], left[2][b]
    d = np.maximum(table[j, j] - np.where(j == old[w], r + l_, 0), 0)
    np.add.at(gain, (w, j), _f(d + r + l_) - _f(d + r) - _f(d + l_) + _f(d))
    rows = np.arange(n)
    for sums, margin in ((sums_after, table.sum(axis=1)), (sums_before, table.sum(axis=0))):
        whole, at = np.unique(sums, return_inverse=True)
        gain -= (_f(margin[None] + whole[:, None]) - _f(margin)[None])[at]
        plain = margin[old]
        rest = np.maximum(plain - sums, 0)
        gain[rows, old] += _f(plain + sums) - _f(plain) - _f(rest + sums) + _f(rest)
    best = gain.argmax(axis=1)
    return np.where(gain[rows, best] > gain[rows, old] + 1e-9, best, old)


def _whole_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows in pieces that do not part the rows of one word."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < DECIDED_ROWS:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column("k").combine_chunks()
        last = keys[len(keys) - 1]
        cut = len(keys) - pc.sum(pc.equal(keys, last)).as_py()
        if cut:
            yield table.slice(0, cut)
        held, rows = table.slice(cut).to_batches(), len(keys) - cut
    if rows:
        yield pa.Table.from_batches(held)


def chosen_classes(
    neighbours: DataFrame, rare: DataFrame, table: np.ndarray, head_class: np.ndarray, least_count: float
) -> DataFrame:
    """What words choose (``CHOSEN``): a row per frequent word (its number in ``g``); one per
    occurrence of a rare word, with its place, its class, or -1 for that of its last
    bytes, and its count; and per task and class the tokens (``n``) and distinct words
    (``g``) of the rare ones that stayed with their last bytes and of those that chose."""
    shared = neighbours.sparkSession.sparkContext.broadcast((table, head_class))
    classes = len(table)
    width, mask = 2 * classes, (1 << CLASS_BITS) - 1
    # The count of a word stands among its occurrences.
    known = rare.select(
        F.concat(F.lit(bytearray(b"w")), "w").alias("k"), (-F.col("n")).alias("v"),
        F.lit(None).cast("long").alias("g"), F.lit(None).cast("int").alias("s"), F.lit(None).cast("binary").alias("b"),
    )

    def rows_of(kind: int, g, s, c, n) -> pa.RecordBatch:
        size = len(c)
        columns = [pa.array(np.full(size, kind, np.int32))]
        for values, t in ((g, pa.int64()), (s, pa.int32()), (c, pa.int32()), (n, pa.int64())):
            columns.append(pa.nulls(size, t) if values is None else pa.array(np.asarray(values), t))
        return pa.RecordBatch.from_arrays(columns, names=["kind", "g", "s", "c", "n"])

    class Heads:
        """Sums a block of frequent words at a time; what they choose waits in ``done``."""

        def __init__(self, cells: np.ndarray, of_head: np.ndarray, tabled):
            self.cells, self.of_head, self.tabled = cells, of_head, tabled
            self.key, self.total, self.done = None, None, []

        def add(self, keys: list[bytes], counts: list[bytes]) -> None:
            for key, data in zip(keys, counts):
                if key != self.key:
                    self.decide()
                    self.key, self.total = key, np.zeros(TOGETHER * width, np.int64)
                end = 4 + int.from_bytes(data[:4], "big")
                self.total[_wide(data[4:end])] += _wide(data[end:])

        def decide(self) -> None:
            if self.key is None:
                return
            first = int.from_bytes(self.key[1:], "big") * TOGETHER
            own = self.of_head[first : first + TOGETHER]
            counts = self.total.reshape(TOGETHER, width)[: len(own)]
            sides = []
            for side in (counts[:, :classes], counts[:, classes:]):
                w, j = np.nonzero(side)
                sides.append((w, j, side[w, j]))
            best = best_classes(self.cells, *sides, own, self.tabled)
            self.done.append(rows_of(IN_HEAD, np.arange(first, first + len(own)), None, best, None))
            self.key = None

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, of_head = shared.value
        tabled = tabled_gains(cells)
        heads = Heads(cells, of_head, tabled)
        sums = np.zeros((2, 2, classes), np.int64)

        def without_heads() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = pc.sum(pc.starts_with(batch.column(0), pattern=b"h")).as_py() or 0
                if n:
                    first = batch.slice(0, n)
                    heads.add(first.column(0).to_pylist(), first.column(4).to_pylist())
                if n < batch.num_rows:
                    yield batch.slice(n)

        for part in _whole_words(without_heads()):
            word = part.column("k").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
            v = part.column("v").to_numpy()
            size = int(word[-1]) + 1
            count, old = np.zeros(size, np.int64), np.zeros(size, np.int64)
            count[word[v < 0]] = -v[v < 0]
            seen = np.flatnonzero(v >= 0)
            w, v = word[seen], v[seen]
            before, after, was = (v >> (CLASS_BITS * i) & mask for i in range(3))
            old[w] = was
            chooses = count >= least_count
            learned = np.flatnonzero((v >> 3 * CLASS_BITS > 0) & chooses[w])
            number = np.cumsum(chooses) - 1  # of those that choose
            sides = [_entries(number[w[learned]], found[learned], classes) for found in (after, before)]
            best = old.copy()
            if chooses.any():
                best[chooses] = best_classes(cells, *sides, old[chooses], tabled)
            group, slot = (part.column(c).combine_chunks().fill_null(0).to_numpy()[seen] for c in ("g", "s"))
            yield rows_of(PLACED, group, slot, np.where(chooses, best, -1)[w], count[w])
            for i, those in enumerate((~chooses & (count > 0), chooses)):
                np.add.at(sums[i, 0], best[those], 1)
                np.add.at(sums[i, 1], best[those], count[those])
        heads.decide()
        yield from heads.done
        for i, kind in enumerate((STAYED, CHOSE)):
            found = np.flatnonzero(sums[i, 0])
            if len(found):
                yield rows_of(kind, sums[i, 0, found], None, found, sums[i, 1, found])

    together = neighbours.unionByName(known).repartition("k").sortWithinPartitions("k")
    return together.mapInArrow(tidy(choose), CHOSEN)


def with_classes(
    coded: DataFrame, placed: DataFrame, head_class: np.ndarray, suffix_class: np.ndarray, add: float
) -> DataFrame:
    """Coded texts with the class of each token, ``__class``, from the words' choices.

    A group of texts meets the rows of its rare words. The first time that also tells
    what their counts add to the scores, and of the rare words those stay that choose.
    """
    shared = coded.sparkSession.sparkContext.broadcast((head_class, suffix_class))
    first_time = "__tail_counts" in coded.columns
    out = coded.drop("__tail_counts", "__tail_suffix")
    if first_time:
        schema = out.schema.add("__class", "binary")
    else:
        schema = out.schema
    names = schema.names
    nowhere = len(head_class)  # stands for rare words that never choose

    def put(texts: pa.Table, rows: pa.Table) -> pa.Table:
        of_head, of_suffix = shared.value
        batch = texts.sort_by("__uid").combine_chunks().to_batches()[0] if texts.num_rows else None
        if batch is None:
            return pa.Table.from_batches([], schema=texts.schema)
        part = Coded(batch, of_head, of_suffix)
        chosen, count = np.full(len(part.tail), -1, np.int32), np.zeros(len(part.tail), np.int64)
        at = rows.column("s").to_numpy()
        chosen[at], count[at] = rows.column("c").to_numpy(), rows.column("n").to_numpy()
        columns = {n: batch.column(n) for n in batch.schema.names}
        classes = part.classes
        known = (part.flat >= 0) & (part.flat < nowhere)
        classes[known] = of_head[part.flat[known]]
        tokens = chosen[part.tail_at]
        classes[part.in_tail] = np.where(tokens >= 0, tokens, classes[part.in_tail])
        if first_time:
            times = unpacked(batch.column("__tail_counts"), np.int32)[0]
            text = np.repeat(np.arange(len(part.sizes)), part.tail_sizes)
            logs = np.bincount(text, times * np.log10(count + add), len(part.sizes))
            met = np.bincount(text, times * (count > 0), len(part.sizes)).astype(np.int64)
            columns["__logs"] = pa.array(columns["__logs"].to_numpy() + logs)
            columns["__known"] = pa.array(columns["__known"].to_numpy() + met)
            # Only words that choose stay, numbered anew within their texts and the group.
            stays = chosen >= 0
            upto = np.cumsum(stays)
            sizes = np.bincount(text[stays], minlength=len(part.sizes))
            first = np.cumsum(np.append(0, sizes))[:-1]
            number = -1 - (upto - 1 - first[text]) if len(text) else upto
            flat = part.flat.copy()
            flat[part.in_tail] = np.where(stays[part.tail_at], number[part.tail_at], nowhere)
            columns["__seq"] = packed(flat, part.sizes)
            columns["__tail"] = pa.ListArray.from_arrays(
                pa.array(np.append(first, sizes.sum()), pa.int32()), part.tail.filter(pa.array(stays)))
            columns["__tail_at"] = pa.array(first, pa.int32())
        columns["__class"] = packed(classes.astype(CLASS_TYPE), part.sizes)
        return pa.table([columns[n] for n in names], names=names)

    return coded.groupBy("__gid").cogroup(placed.select(F.col("g").alias("__gid"), "s", "c", "n").groupBy("__gid")).applyInArrow(put, schema)


class Groups:
    """Coded texts stored in buckets of their groups, so that they stay where they lie when
    rows of rare words come to them. A bucketed table has a name, for a while."""

    def __init__(self, spark, folder: str):
        self.spark, self.folder, self.names = spark, folder, {}

    def stored(self, df: DataFrame, part: str) -> DataFrame:
        self.names[part] = f"coded_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (
            df.write.format("parquet").bucketBy(buckets, "__gid").sortBy("__gid")
            .option("path", f"{self.folder}/{part}").saveAsTable(self.names[part])
        )
        return self.spark.table(self.names[part])

    def discard(self, part: str) -> None:
        discard(self.spark, f"{self.folder}/{part}")

    def by_path(self, part: str) -> DataFrame:
        """A stored part as plain files; all names are given up, other files stay."""
        schema = self.spark.table(self.names[part]).schema
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{part}")


def exchange_words(
    coded: DataFrame, model: BrownModel, counted: Counted, table: np.ndarray, groups: Groups
) -> tuple[BrownModel, DataFrame]:
    """The model with a class chosen for each frequent enough word, and ``coded`` (stored as
    the part ``coded-0``) with the class of each token. A sweep that does not raise the
    likelihood is undone."""
    s, folder, part = model.settings, groups.folder, "coded-0"
    suffix = suffix_classes(model)
    rare = counted.words.where(_band("n") < counted.least_band).select("w", "n")
    head_class = model.head_class.astype(np.int64)
    chooses = np.array([n for _, n in counted.head]) >= (s.least_count or np.inf)
    chooses[0] = s.least_count is not None  # the end
    least = np.inf if s.least_count is None else s.least_count
    now, stayed, chose = coded, np.zeros((2, s.classes)), np.zeros((2, s.classes))
    for sweep in range(1, (s.word_sweeps if s.least_count is not None else 1) + 1):
        near = neighbour_counts(now, head_class, suffix, s.classes)
        chosen = chosen_classes(near, rare, table, head_class, least)
        path = f"{folder}/chosen-{sweep}"
        chosen = stored(chosen, path)
        moved = chosen.where(F.col("kind") == IN_HEAD).select("g", "c").toArrow()
        at, to = moved["g"].to_numpy(), moved["c"].to_numpy()
        new_class = head_class.copy()
        new_class[at[chooses[at]]] = to[chooses[at]]
        sums = {STAYED: np.zeros((2, s.classes)), CHOSE: np.zeros((2, s.classes))}
        summed = chosen.where(F.col("kind") >= STAYED).groupBy("kind", "c").agg(F.sum("n"), F.sum("g"))
        for kind, c, n, kinds in summed.collect():
            sums[kind][:, c] = n, kinds
        placed = chosen.where(F.col("kind") == PLACED)
        made = f"coded-{sweep}"
        next_ = groups.stored(with_classes(now, placed, new_class, suffix, s.add), made)
        new_table = count_classes(next_.where("__train"), new_class, suffix, s.classes)
        better = s.least_count is not None and information(new_table) > information(table)
        if better or sweep == 1:
            if not better and s.least_count is not None:
                # Their counts are wanted all the same, their choices are not.
                none = placed.withColumn("c", F.lit(-1))
                made = "coded-none"
                next_ = groups.stored(with_classes(now, none, head_class, suffix, s.add), made)
                stayed = sums[STAYED] + by_suffix(rare, least, suffix)
            else:
                stayed, chose = (sums[STAYED], sums[CHOSE]) if sweep == 1 else (stayed, sums[CHOSE])
                head_class, table = new_class, new_table
            # The texts as they were, and what led here, are not read again.
            groups.discard(part)
            now, part = next_, made
        discard(coded.sparkSession, path)
        rare = rare.where(F.col("n") >= (s.least_count or 0))
        if not better:
            break
        coded.sparkSession.sparkContext._jvm.System.gc()  # lets Spark delete finished shuffles
    numbers = np.array([n for _, n in counted.head], float)
    tokens = np.bincount(head_class, numbers, s.classes) + stayed[0] + chose[0]
    types = np.bincount(head_class, numbers > 0, s.classes) + stayed[1] + chose[1]
    model = model_of(
        s, counted.head, counted.least_band, model.unit_class, head_class, table, tokens, types, counted.total
    )
    return model, groups.by_path(part)


def by_suffix(rare: DataFrame, least: float, suffix: np.ndarray) -> np.ndarray:
    """Tokens and distinct words by class of the last bytes, of rare words that choose."""
    classes = F.array(*(F.lit(int(c)) for c in suffix))
    number = (F.crc32(F.substring("w", -3, 3)) % len(suffix) + 1).cast("int")
    out = np.zeros((2, int(suffix.max()) + 1 if len(suffix) else 1))
    found = rare.where(F.col("n") >= least).groupBy(F.element_at(classes, number).alias("c"))
    for c, n, kinds in found.agg(F.sum("n"), F.count("n")).collect():
        out[:, c] = n, kinds
    return out


# --- Scores ----------------------------------------------------------------


#: Tokens and texts of a group, which a task holds when it puts classes in.
GROUP_TOKENS = 300_000
GROUP_TEXTS = 1024


def coded_texts(
    docs: DataFrame, head: list[tuple[bytes, int]], settings: BrownSettings, training: Column, keep: list[Column], text: str
) -> DataFrame:
    """``keep`` of each row, a number of its own and one of its group, what its frequent
    words add to the scores, and its words: numbers of frequent ones, places in
    ``__tail`` of others. ``__tail_at`` is the place of its tail in the group's."""
    shared = docs.sparkSession.sparkContext.broadcast((head, settings.add))
    source = docs.select(F.col(text).alias("__text"), *keep, F.coalesce(training, F.lit(False)).alias("__train"))
    kinds = (
        "__uid long, __gid long, n_tokens long, __known long, __logs double, "
        "__seq binary, __tail array<binary>, __tail_at int, __tail_counts binary, __tail_suffix binary"
    )
    schema = source.drop("__text").schema
    for field in source.sparkSession.createDataFrame([], kinds).schema:
        schema = schema.add(field)
    names = schema.names

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_, add = shared.value
        number = {w: i for i, (w, _) in enumerate(words_)}
        counts = np.array([n for _, n in words_], float)
        logs = np.log10(counts + add)
        uid = group = TaskContext.get().partitionId() << TASK_BITS
        tokens = tails = 0
        for batch in slices(batches, CUT_TEXTS):
            n = batch.num_rows
            found = Words(batch.column(0))
            distinct = found.distinct.to_pylist()
            of_word = np.fromiter((number.get(w, -1) for w in distinct), np.int32, len(distinct))
            flat = of_word[found.numbers]
            rare = np.flatnonzero(flat < 0)
            # The distinct rare words of each text, and which of them each occurrence is.
            kinds = max(1, len(of_word))
            pairs, which, times = np.unique(
                found.text[rare] * kinds + found.numbers[rare], return_inverse=True, return_counts=True
            )
            tail_sizes = np.bincount(pairs // kinds, minlength=n)
            first = np.cumsum(np.append(0, tail_sizes))
            flat[rare] = -1 - (which - first[found.text[rare]])
            words_of = pairs % kinds
            tail = pa.ListArray.from_arrays(pa.array(first, pa.int32()), found.distinct.take(pa.array(words_of)))
            suffix = np.zeros(kinds, np.uint16)
            for i in np.unique(words_of).tolist():
                suffix[i] = zlib.crc32(distinct[i][-3:]) % settings.suffixes
            # Each text's words, then the end.
            sizes = np.bincount(found.text, minlength=n) + 1
            seq = np.full(int(sizes.sum()), number[END], np.int32)
            seq[np.arange(len(flat)) + found.text] = flat
            text = np.repeat(np.arange(n), sizes)
            often = seq >= 0
            known = np.bincount(text[often], counts[seq[often]] > 0, n).astype(np.int64)
            head_logs = np.bincount(text[often], logs[seq[often]], n)
            groups, places = [], []
            for i, (size, tail_size) in enumerate(zip(sizes.tolist(), tail_sizes.tolist()), uid):
                if i > group and (tokens + size > GROUP_TOKENS or i - group >= GROUP_TEXTS):
                    group, tokens, tails = i, 0, 0
                groups.append(group)
                places.append(tails)
                tokens, tails = tokens + size, tails + tail_size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(np.arange(uid, uid + n)), pa.array(groups, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(known), pa.array(head_logs), packed(seq, sizes), tail,
                 pa.array(places, pa.int32()), packed(times.astype(np.int32), tail_sizes),
                 packed(suffix[words_of], tail_sizes)],
                names=names,
            )
            uid += n

    return source.mapInArrow(tidy(code), schema)


def class_scores(coded: DataFrame, model: BrownModel, keep: list[str]) -> DataFrame:
    """``keep`` of each row and what its classes add to the score, from ``__class``."""
    shared = coded.sparkSession.sparkContext.broadcast((int(model.head_class[0]), model.step, model.size))
    source = coded.select("__class", *keep)
    schema = coded.select(*keep).schema.add("__class_logs", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, step, size = shared.value
        for batch in slices(batches, SLICE):
            classes, sizes = unpacked(batch.column(0), CLASS_TYPE)
            classes = classes.astype(np.int64)
            logs = step[np.append(end, classes[:-1]), classes] - size[classes] if len(classes) else np.zeros(0)
            starts = np.cumsum(sizes) - sizes
            sums = np.add.reduceat(logs, starts) if len(starts) else logs
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sums)], names=schema.names)

    return source.mapInArrow(score, schema)


def score_texts(
    docs: DataFrame, training: Column, keep: list[Column], text: str = "text",
    settings: BrownSettings = BrownSettings(), folder: str | None = None,
) -> DataFrame:
    """``keep`` of each row with ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``.

    Learns from the rows for which ``training`` holds. A null text has the end alone;
    so has an empty one. Repeated rows count and are scored each; a word that was
    not learned has count 0 and the class of its last bytes. Without training rows
    all counts are 0. Other columns are not read.
    """
    folder = folder or shared_dir(docs.sparkSession)
    groups = Groups(docs.sparkSession, folder)
    counted = count_words(docs.where(training).select(text), settings, folder)
    coded = groups.stored(coded_texts(docs, counted.head, settings, training, keep, text), "coded-0")
    kept = coded.columns[: coded.columns.index("__train")]
    model, table = train_units(coded, counted, settings)
    model, now = exchange_words(coded, model, counted, table, groups)
    scores = class_scores(now, model, [*kept, "n_tokens", "__known", "__logs"])
    return scores.select(
        *kept, "n_tokens", F.col("__known").alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("__logs") - F.col("n_tokens") * F.lit(model.whole)).alias("base_score"),
        (F.col("__logs") + F.col("__class_logs")).alias("score"),
    )
