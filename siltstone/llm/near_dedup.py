"""Near-duplicates: banded SetSketch registers, a joint estimate, then the full sets.

Texts with equal shingle sets are one node. Bands of registers put nodes into
buckets, and nodes of a bucket whose estimate is high enough into families. Each node
is first linked to a leader, so that a large group of copies costs a link per node.
Then every node outside its family's largest component is compared with the whole
family, in blocks, within tasks: pairs are never rows. Every link is confirmed on the
full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import as_bytes, rows_of, shared_dir, slices, stored, text_hash
from siltstone.llm.components import components
from siltstone.llm.setsketch import SketchShape, low_matches, low_planes, matches_for
from siltstone.llm.shingles import many_word_hashes, set_digest, shingle_set, word_hashes

SHAPE = SketchShape(registers=128)
BYTES = 2 * SHAPE.registers
#: A 64-bit word has the low bits of 64 registers; two bits of each are kept.
PLANES = 4
#: Rows of a bucket that are compared at a time.
TILE = 1024
#: Bits of the filter that spares texts of nodes without a partner a shuffle. Its
#: size is fixed: where it fills up, it spares less.
FILTER_BITS = 26


@dataclass(frozen=True)
class NearSettings:
    """``band`` registers each of ``bands`` bands: a pair of similarity s shares no
    band with probability (1 - s**band)**bands, 5e-6 at 0.75.

    Of two nodes in a bucket, those whose estimate is below ``least_estimate`` are
    not tried; at a similarity of 0.75 that is over five standard deviations.
    """

    width: int = 5
    numerator: int = 75  # links have 100 * intersection >= numerator * union
    band: int = 4
    bands: int = 32
    leader_estimate: float = 0.7
    least_estimate: float = 0.5
    block: int = 1024  # nodes of a family that a task compares with as many others


def _lowered(texts: list[bytes | None]) -> list[bytes]:
    return [(t or b"").lower() for t in texts]


def sketches(docs: DataFrame, id_column: str, text: str, settings: NearSettings) -> DataFrame:
    """``id, t, n, digest, registers, low``: t is a hash of the text; n the size of its set."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            words = many_word_hashes(_lowered(as_bytes(batch.column(2))))
            sets = [shingle_set(w, settings.width) for w in words]
            registers = SHAPE.sketch(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([r.tobytes() for r in registers.astype("<u2")], pa.binary()),
                    pa.array([r.tobytes() for r in low_planes(registers).astype("<u8")], pa.binary()),
                ],
                names=["id", "t", "n", "digest", "registers", "low"],
            )

    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), text_hash(text).alias("t"), F.col(text).alias("x"))
    return rows.mapInArrow(read, "id long, t long, n long, digest binary, registers binary, low binary")


def _node(digest: str = "digest") -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, -10).cast("bigint")


def band_rows(nodes: DataFrame, settings: NearSettings) -> DataFrame:
    """``bucket, k, n, low`` of every band of every node."""
    size = 2 * settings.band
    return nodes.select(
        "k", "n", "low", "registers", F.explode(F.sequence(F.lit(0), F.lit(settings.bands - 1))).alias("band")
    ).select(
        F.xxhash64("band", F.expr(f"substring(registers, band * {size} + 1, {size})")).alias("bucket"),
        "k", "n", "low",
    )


def _matrix(column: pa.Array, kind) -> np.ndarray:
    joined = np.frombuffer(b"".join(column.to_pylist()), np.dtype(kind).newbyteorder("<"))
    return joined.reshape(len(column), -1)


# --- Buckets ---------------------------------------------------------------


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows, sorted by bucket, in tables that do not cut a bucket."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        start = int(np.searchsorted(keys, keys[-1]))  # of the bucket that may go on
        if start == 0 and held and held[0].column(0)[0].as_py() == keys[0]:
            held.append(batch)
            continue
        if held or start:
            yield pa.Table.from_batches([*held, batch.slice(0, start)]).combine_chunks()
        held = [batch.slice(start)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of two or more equal keys."""
    cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    ends = np.append(cuts[1:], len(keys))
    many = ends - cuts > 1
    return list(zip(cuts[many].tolist(), ends[many].tolist()))


def shared_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of buckets with more than one."""
    for table in _buckets(batches):
        keys = table.column(0).to_numpy()
        same = keys[1:] == keys[:-1]
        keep = np.append(same, False) | np.append(False, same)
        yield from table.filter(pa.array(keep)).to_batches()


def bucket_links(settings: NearSettings):
    """Rows ``a, b, m, kind`` for each bucket.

    Kind 0: each row with the leader whose estimate is highest; a row that no
    leader's estimate fits becomes a leader. Kind 1: each row with the first of those
    it is connected to by estimates from ``least_estimate`` on.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _buckets(batches):
            keys = table.column(0).to_numpy()
            k = table.column("k").to_numpy()
            low = np.frombuffer(b"".join(table.column("low").to_pylist()), "<u8").reshape(-1, PLANES)
            out: list[tuple[np.ndarray, ...]] = []
            for start, end in _runs(keys):
                rows = low[start:end]
                leader, matches = _leaders(rows, matches_for(settings.leader_estimate, SHAPE.registers))
                first = _connected(rows, matches_for(settings.least_estimate, SHAPE.registers))
                for kind, other in ((0, leader), (1, first)):
                    at = np.flatnonzero(other != np.arange(len(rows)))
                    out.append((k[start + other[at]], k[start + at], matches[at], np.full(len(at), kind)))
            if out:
                a, b, m, kind = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array(m.astype(np.int64)), pa.array(kind.astype(np.int32))],
                    names=["a", "b", "m", "kind"],
                )

    return link


def _leaders(low: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row its leader, itself if it is one, and how many low bits they share."""
    leader, matches = np.arange(len(low)), np.full(len(low), SHAPE.registers)
    chosen = np.empty(0, np.int64)
    for at in range(0, len(low), TILE):
        rows = np.arange(at, min(len(low), at + TILE))
        best, own = _best(low, rows, chosen)
        while (best < least).any():
            new = rows[np.argmax(best < least)]
            chosen = np.append(chosen, new)
            now = low_matches(low[rows], low[[new]])[:, 0]
            better = (best < least) & (now > best)  # rows with a leader stay with it
            best, own = np.where(better, now, best), np.where(better, new, own)
        leader[rows], matches[rows] = own, best
    return leader, matches


def _connected(low: np.ndarray, least: float) -> np.ndarray:
    """For each row the first row that it is connected to, by way of similar ones."""
    first = np.full(len(low), -1, np.int64)
    rest = np.arange(len(low))
    while len(rest):
        seed, reached = rest[0], rest[:1]
        rest = rest[1:]
        first[seed] = seed
        while len(reached) and len(rest):
            some, reached = reached[:TILE], reached[TILE:]
            near = np.zeros(len(rest), bool)
            for at in range(0, len(rest), TILE):
                tile = slice(at, at + TILE)
                near[tile] = (low_matches(low[some], low[rest[tile]]) >= least).any(axis=0)
            first[rest[near]] = seed
            reached, rest = np.append(reached, rest[near]), rest[~near]
    return first


def _best(low: np.ndarray, rows: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The highest estimate against the leaders so far, and whose it is."""
    best, leader = np.full(len(rows), -1, np.int64), np.full(len(rows), -1, np.int64)
    for at in range(0, len(chosen), TILE):
        some = chosen[at : at + TILE]
        matches = low_matches(low[rows], low[some])
        now = matches.max(axis=1)
        better = now > best
        leader = np.where(better, some[matches.argmax(axis=1)], leader)
        best = np.where(better, now, best)
    return best, leader


LINKS = "a long, b long, m long, kind int"


def _in_buckets(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket", "n", "k")


# --- Confirming ------------------------------------------------------------


def estimated(pairs: DataFrame, nodes: DataFrame, settings: NearSettings) -> DataFrame:
    """Pairs whose joint estimate from all registers is high enough."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 10_000):
            j = SHAPE.joint_estimate(
                _matrix(batch.column(3), np.uint16), _matrix(batch.column(5), np.uint16),
                batch.column(2).to_numpy(), batch.column(4).to_numpy(),
            )
            yield pa.RecordBatch.from_arrays(
                batch.filter(pa.array(j >= settings.least_estimate)).columns[:2], names=["a", "b"]
            )

    left = nodes.select(F.col("k").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    right = nodes.select(F.col("k").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "ra", "nb", "rb")
    return joined.mapInArrow(keep, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, settings: NearSettings) -> DataFrame:
    """Pairs that are links by their full shingle sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in slices(batches, 200):
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            first, second = as_bytes(batch.column(2)), as_bytes(batch.column(3))
            own = [shingle_set(w, settings.width) for w in many_word_hashes(_lowered(second))]
            links = []
            for i, shingles in enumerate(own):
                if a[i] != last:
                    last = a[i]
                    held = shingle_set(many_word_hashes(_lowered([first[i]]))[0], settings.width)
                links.append(_is_link(held, shingles, settings))
            keep = pa.array(links, pa.bool_())
            yield pa.RecordBatch.from_arrays(batch.filter(keep).columns[:2], names=["a", "b"])

    left = texts.select(F.col("k").alias("a"), F.col("x").alias("xa"))
    right = texts.select(F.col("k").alias("b"), F.col("x").alias("xb"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "xa", "xb")
    return joined.sortWithinPartitions("a", "b").mapInArrow(check, "a long, b long").distinct()


def _is_link(a: np.ndarray, b: np.ndarray, settings: NearSettings) -> bool:
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    common = int(np.count_nonzero(a[at] == b))
    return 100 * common >= settings.numerator * (len(a) + len(b) - common)


def across_families(members: DataFrame, texts: DataFrame, settings: NearSettings) -> DataFrame:
    """Links ``a, b`` between components of a family, all that are needed to join them.

    ``members`` has ``f, k, c, n, low``. Nodes outside a family's largest component meet
    all of the family. Both come in blocks, so a task has two blocks, however large the
    family is, and a node stops at its first link to a component.
    """
    counts = members.groupBy("f", "c").agg(F.count("k").alias("size"))
    families = counts.groupBy("f").agg(
        F.sum("size").alias("all"), F.max(F.struct("size", (-F.col("c")).alias("c"))).alias("main")
    ).where(F.col("all") > F.col("main.size")).select(
        "f", (-F.col("main.c")).alias("main"),
        F.ceil((F.col("all") - F.col("main.size")) / settings.block).alias("lefts"),
        F.ceil(F.col("all") / settings.block).alias("rights"),
    )
    rows = members.join(families, "f").join(texts, "k")
    spread = F.xxhash64("k")
    zero = F.lit(0).cast("bigint")
    values = ["k", "c", "n", "low", "x"]
    left = rows.where("c <> main").select(
        "f", F.pmod(spread, "lefts").alias("i"), F.explode(F.sequence(zero, F.col("rights") - 1)).alias("j"), *values
    ).toDF("lf", "li", "lj", *values)
    right = rows.select(
        "f", F.explode(F.sequence(zero, F.col("lefts") - 1)).alias("i"), F.pmod(spread, "rights").alias("j"), *values
    ).toDF("rf", "ri", "rj", *[f"r{v}" for v in values])

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = _compared(a, b.set_axis(a.columns, axis=1), settings) if len(a) and len(b) else []
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return left.groupBy("lf", "li", "lj").cogroup(right.groupBy("rf", "ri", "rj")).applyInPandas(
        compare, "a long, b long"
    )


def _compared(a: pd.DataFrame, b: pd.DataFrame, settings: NearSettings) -> list[tuple[int, int]]:
    least = matches_for(settings.least_estimate, SHAPE.registers)
    low_a, low_b = (np.frombuffer(b"".join(d.low), "<u8").reshape(-1, PLANES) for d in (a, b))
    na, nb, ca, cb = a.n.to_numpy(), b.n.to_numpy(), a.c.to_numpy(), b.c.to_numpy()
    sets: dict[str, dict[int, np.ndarray]] = {"a": {}, "b": {}}

    def set_of(side: str, i: int) -> np.ndarray:
        if i not in sets[side]:
            text = (a if side == "a" else b).x.iat[i].encode()
            sets[side][i] = shingle_set(word_hashes(text.lower()), settings.width)
        return sets[side][i]

    links = []
    for i in range(len(a)):
        matches = low_matches(low_a[i : i + 1], low_b)[0]
        small = np.minimum(na[i], nb) * 100 >= settings.numerator * np.maximum(na[i], nb)
        near = np.flatnonzero(small & (cb != ca[i]) & (matches >= least))
        reached: set[int] = set()
        for j in near[np.argsort(-matches[near], kind="stable")].tolist():
            if cb[j] not in reached and _is_link(set_of("a", i), set_of("b", j), settings):
                reached.add(cb[j])
                links.append((a.k.iat[i], b.k.iat[j]))
    return links


def texts_of(docs: DataFrame, nodes: DataFrame, id_column: str, text: str) -> DataFrame:
    """``k, x``: the text of each node; rows that repeat one give it once per task.

    A fixed number of filter bits, set for the wanted rows, is shared with all
    tasks; rows it lets pass are then joined exactly.
    """
    spark = docs.sparkSession
    place = F.shiftrightunsigned(F.xxhash64("id", "t"), 64 - FILTER_BITS)
    wanted = nodes.select("k", F.col("first.id").alias("id"), F.col("first.t").alias("t"))
    bits = (
        wanted.select(place.alias("p"))
        .groupBy(F.bitmap_bucket_number(F.col("p") + 1).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("p") + 1)).alias("bits"))
    )
    whole = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in bits.collect():  # at most 2**26 bits, whatever the input
        start = (row["part"] - 1) * 4096
        whole[start : start + 4096] = np.frombuffer(row["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(whole)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(2).to_numpy()
            keep = (shared.value[p >> 3] >> (p & 7).astype(np.uint8)) & 1
            yield pa.RecordBatch.from_arrays(
                [c for i, c in enumerate(batch.filter(pa.array(keep.astype(bool))).columns) if i != 2],
                names=["id", "t", "x"],
            )

    rows = docs.select(
        F.col(id_column).cast("bigint").alias("id"), text_hash(text).alias("t"),
        F.coalesce(F.col(text), F.lit("")).alias("x"),
    ).select("id", "t", place.alias("p"), "x")
    near = rows.mapInArrow(passing, "id long, t long, x string")
    key = [F.coalesce("id", F.lit(0)), F.col("id").isNull(), F.col("t")]
    joined = (
        near.withColumn("h", F.xxhash64(*key)).alias("r")
        .join(wanted.withColumn("h", F.xxhash64(*key)).alias("w"), "h")
        .where("r.t = w.t AND r.id <=> w.id")
        .select("k", "x")
    )

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in slices(batches):
            k = batch.column(0).to_numpy()
            if not len(k):
                continue
            keep = np.append(k[0] != last, k[1:] != k[:-1])
            last = k[-1]
            yield pa.RecordBatch.from_arrays(batch.filter(pa.array(keep)).columns, names=["k", "x"])

    return joined.sortWithinPartitions("k").mapInArrow(once, "k long, x string")


# --- The whole -------------------------------------------------------------


def near_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text",
    settings: NearSettings = NearSettings(), folder: str | None = None,
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` of each row.

    Words are parted by white space after lower-casing A-Z; fewer words than a
    shingle has are one shingle, no words or a null text link with nothing. Links
    chain: ``component_id`` is the smallest id that a row reaches. Equal sets are
    linked. Null ids count last; a component of null ids alone has a null id and
    keeps its rows. Rows that repeat the kept id are all marked kept unless their
    text belongs elsewhere. An empty table gives no rows, other columns are not read.
    """
    rows, labels = _grouped(docs, id_column, text, settings, folder)
    component = F.when(F.col("n") > 0, F.col("stays.id")).otherwise(F.col("id"))
    return rows.withColumn("k", _node()).join(labels, "k", "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def keep_one(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text",
    settings: NearSettings = NearSettings(), folder: str | None = None,
) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, and of repeated empty rows one."""
    rows, labels = _grouped(docs, id_column, text, settings, folder)
    stays = labels.select("stays.id", "stays.t").distinct()
    stays = stays.unionByName(rows.where("n = 0").select("id", "t").distinct())
    copies = rows.groupBy("id", "t").agg(F.count("n").alias("c"))
    wanted = copies.alias("x").join(
        stays.alias("y"), (F.col("x.t") == F.col("y.t")) & F.col("x.id").eqNullSafe(F.col("y.id")), "left_semi"
    )
    return rows_of(docs, wanted, id_column, text)


def _grouped(docs, id_column, text, settings, folder) -> tuple[DataFrame, DataFrame]:
    """Rows with their sketches; for each node the row of its component that stays."""
    spark = docs.sparkSession
    folder = folder or shared_dir(spark)
    rows = stored(sketches(docs, id_column, text, settings), f"{folder}/rows")
    nodes = rows.where("n > 0").groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t")).alias("first"),
        F.first("n").alias("n"), F.first("registers").alias("registers"), F.first("low").alias("low"),
    )
    nodes = stored(nodes.select(_node().alias("k"), "n", "first", "registers", "low"), f"{folder}/nodes")
    buckets = stored(
        _in_buckets(band_rows(nodes, settings)).mapInArrow(shared_buckets, "bucket long, k long, n long, low binary"),
        f"{folder}/buckets",
    )
    busy = nodes.join(buckets.select("k").distinct(), "k", "left_semi")
    texts = stored(texts_of(docs, busy, id_column, text), f"{folder}/texts")

    linked = stored(_in_buckets(buckets).mapInArrow(bucket_links(settings), LINKS).distinct(), f"{folder}/linked")
    # Of the leaders of its buckets, a node tries the most similar one.
    tries = linked.where("kind = 0").groupBy("b").agg(F.max(F.struct("m", "a")).alias("p")).select("p.a", "b")
    links = stored(confirmed(estimated(tries, nodes, settings), texts, settings), f"{folder}/links")
    found = components(links, f"{folder}/first")
    families = components(linked.where("kind = 1"), f"{folder}/families").withColumnRenamed("c", "f")
    members = families.join(found, "k", "left").join(nodes, "k").select(
        "f", "k", F.coalesce("c", "k").alias("c"), "n", "low"
    )
    more = stored(across_families(stored(members, f"{folder}/members"), texts, settings), f"{folder}/more")
    found = components(links.union(more), f"{folder}/last")
    labels = nodes.select("k", "first")
    labels = labels.join(found, "k", "left").withColumn("c", F.coalesce("c", "k"))
    smallest = labels.groupBy("c").agg(F.min("first").alias("stays"))
    return rows, labels.join(smallest, "c").select("k", "stays")
