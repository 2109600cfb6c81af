"""Exact inner-product top-k by a dual-tree search over cover trees.

The first level is common to all tasks: some rows serve as pivots, and every row and
query belongs to the cell of its nearest one. Each cell of queries first meets the cell
of rows most like it; that gives k-th scores, and only pairs of cells whose balls may
hold a product that reaches them meet as well, so rows are not copied to queries that
have no use for them. Where cells meet, both become cover trees: a node's children are
points of it that lie farther apart than the covering distance of the next level, and
every point goes to the nearest of them. A pair of nodes is passed over when no inner
product between their balls can reach the worst k-th score of the query node. What
remains is multiplied leaf by leaf.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.llm.common import shared_dir, slices, stored

#: Points of a leaf, of rows and of queries, of which there are fewer.
LEAF = 64
QUERY_LEAF = 16
#: Points that tell whether a ball can be split at all.
PROBE = 512
#: Pivots at most, so that their table and all pairs of cells have a bound.
MOST_PIVOTS = 4096
#: Vectors that pivots are chosen from.
SAMPLE = 8192
#: Rows multiplied with a leaf of queries at a time.
TOGETHER = 4096
#: Distances shrink by this from level to level.
SHRINK = 1.5
#: Below this, sums of products of whole numbers are exact in doubles.
EXACT = float(1 << 53)


@dataclass
class Node:
    center: np.ndarray
    radius: float
    start: int  # its points are a range of the tree's order
    end: int
    children: list[Node] = field(default_factory=list)


class CoverTree:
    """``order`` lists the points so that each node's are next to each other."""

    def __init__(self, points: np.ndarray, leaf: int | None = None):
        self.points, self.leaf = points, LEAF if leaf is None else leaf
        self.order = np.arange(len(points))
        self.root = self._grow(0, len(points), 0, None) if len(points) else None

    def _grow(self, start: int, end: int, center: int, distance: np.ndarray | None) -> Node:
        rows = self.order[start:end]
        point = self.points[center]
        if distance is None:
            distance = np.linalg.norm(self.points[rows] - point, axis=1)
        node = Node(point, float(distance.max()), start, end)
        if end - start > self.leaf and node.radius > 0:
            self._split(node, rows, center, distance)
        return node

    def _scattered(self, rows: np.ndarray, apart: float) -> bool:
        """Whether hardly a point has another near, at half that: balls would hold one each."""
        some = self.points[rows[:: max(1, len(rows) // PROBE)]]
        squares = (some * some).sum(axis=1)
        gaps = squares[:, None] + squares[None] - 2 * some @ some.T
        np.fill_diagonal(gaps, np.inf)
        return bool(np.quantile(gaps.min(axis=1), 0.1) > apart * apart / 4)

    def _split(self, node: Node, rows: np.ndarray, center: int, distance: np.ndarray) -> None:
        apart = node.radius / SHRINK
        if self._scattered(rows, apart):
            return
        centers, nearest, owner = [center], distance.copy(), np.zeros(len(rows), np.int64)
        while nearest.max() > apart:
            if 2 * len(centers) > len(rows):
                return  # balls would hold a point or two each
            pick = int(nearest.argmax())
            own = np.linalg.norm(self.points[rows] - self.points[rows[pick]], axis=1)
            closer = own < nearest
            nearest[closer], owner[closer] = own[closer], len(centers)
            centers.append(int(rows[pick]))
        if len(centers) == 1:
            return
        by_owner = np.argsort(owner, kind="stable")
        self.order[node.start : node.end] = rows[by_owner]
        bounds = np.searchsorted(owner[by_owner], np.arange(len(centers) + 1))
        for i, c in enumerate(centers):
            a, b = int(bounds[i]), int(bounds[i + 1])
            node.children.append(
                self._grow(node.start + a, node.start + b, c, nearest[by_owner[a:b]])
            )


class DualSearch:
    """The k best rows of every query, over one pair of trees.

    ``ids`` break ties: of equal scores the smaller id is better. A row with the
    query's own id is no candidate. ``floor`` is a score per query below which no row
    is wanted.
    """

    def __init__(
        self, queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int,
        floor: np.ndarray | None = None,
    ):
        self.k = k
        self.q, self.r = CoverTree(queries, QUERY_LEAF), CoverTree(rows)
        self.query_ids = query_ids[self.q.order]
        self.ids = ids[self.r.order]
        self.q_points, self.r_points = queries[self.q.order], rows[self.r.order]
        top = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1])
        self.exact = top < EXACT
        n = len(queries)
        self.scores = np.full((n, k), -np.inf)
        self.best = np.full((n, k), np.iinfo(np.int64).max)
        self.floor = np.full(n, -np.inf) if floor is None else floor[self.q.order]
        self.pruned = 0
        if n and len(rows):
            self._visit([(self._bound(self.q.root, self.r.root), self.q.root, self.r.root)])

    @staticmethod
    def _bound(q: Node, r: Node) -> float:
        a, b = float(np.linalg.norm(q.center)), float(np.linalg.norm(r.center))
        top = float(q.center @ r.center) + a * r.radius + b * q.radius + q.radius * r.radius
        return top + 1e-9 * (a + q.radius) * (b + r.radius) + 1e-9

    def _visit(self, stack: list[tuple[float, Node, Node]]) -> None:
        while stack:
            bound, q, r = stack.pop()
            own = slice(q.start, q.end)
            if bound < np.maximum(self.scores[own, -1], self.floor[own]).min():
                self.pruned += 1
                continue
            if not q.children and not r.children:
                self._leaves(q, r)
                continue
            if q.children and (not r.children or q.radius >= r.radius):
                pairs = [(c, r) for c in q.children]
            else:
                pairs = [(q, c) for c in r.children]
            # The most promising pair is on top, so that k-th scores rise early.
            stack += sorted(((self._bound(a, b), a, b) for a, b in pairs), key=lambda t: t[0])

    def _leaves(self, q: Node, r: Node) -> None:
        for at in range(r.start, r.end, TOGETHER):
            rows = slice(at, min(r.end, at + TOGETHER))
            for first in range(q.start, q.end, 256):
                self._multiply(slice(first, min(q.end, first + 256)), rows)

    def _multiply(self, queries: slice, rows: slice) -> None:
        a, b = self.q_points[queries], self.r_points[rows]
        if self.exact:
            scores = a @ b.T
        else:
            scores = (a.astype(object) @ b.T.astype(object))
            if max(abs(scores.max()), abs(scores.min())) >= 1 << 63:
                raise OverflowError("a score does not fit into 64 bits")
        ids = self.ids[rows]
        for i, own in enumerate(scores):
            at = queries.start + i
            worst = max(self.scores[at, -1], self.floor[at])
            near = np.flatnonzero((own >= worst) & (ids != self.query_ids[at]))
            if not len(near):
                continue
            value = np.concatenate([self.scores[at], own[near]])
            name = np.concatenate([self.best[at], ids[near]])
            order = np.lexsort((name, -value))[: self.k]
            self.scores[at], self.best[at] = value[order], name[order]


def quantise(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, or null if the vector takes no part."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")),
    )
    return F.when(vector.isNotNull() & ~bad, whole)


def cells_of(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``cell``, the number of the nearest pivot of the vector's length, and ``away``,
    the distance to it."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)
    schema = StructType(list(rows.schema.fields)).add("cell", "integer").add("away", "double")
    at = rows.columns.index("v")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            column = batch.column(at)
            sizes = column.value_lengths().to_numpy()
            flat = column.flatten().to_numpy().astype(float)
            starts = np.cumsum(sizes) - sizes
            cell, away = np.zeros(len(sizes), np.int32), np.zeros(len(sizes))
            for d in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == d)
                points = flat[starts[own][:, None] + np.arange(d)]
                centers = shared.value[d]
                # Nearest by the usual expansion; the distance itself without it.
                near = ((centers * centers).sum(axis=1) - 2 * points @ centers.T).argmin(axis=1)
                cell[own], away[own] = near, np.linalg.norm(points - centers[near], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(away)], names=schema.names
            )

    return rows.mapInArrow(place, schema)


def pivots_of(rows: DataFrame, sizes: dict[int, int], row_block: int) -> dict[int, np.ndarray]:
    """Some vectors of each length, chosen from ``SAMPLE`` of them: see ``spread_pivots``.

    All rows are placed by them; the choice only tells how much can be passed over.
    """
    order = Window.partitionBy("d").orderBy("h", "v")
    some = (
        rows.select("d", "v", F.xxhash64("v", "id").alias("h"))
        .withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE)
    )
    found: dict[int, list] = {}
    for row in some.select("d", "v").collect():
        found.setdefault(row["d"], []).append(row["v"])
    return {
        d: spread_pivots(np.array(v, float).reshape(len(v), d), math.ceil(2 * sizes[d] / row_block))
        for d, v in found.items()
    }


def spread_pivots(sample: np.ndarray, least: int) -> np.ndarray:
    """Points of the sample, ``least`` at first and ``MOST_PIVOTS`` at most.

    Where points lie close together in places, those of a cover: each point is near one of
    them, compared with the extent of all, so cells are small balls. Where they lie far
    from each other no number of cells would be small, and the first points will do.
    """
    least = min(least, MOST_PIVOTS, len(sample))
    if least == 1:
        return sample[:1]
    nearest = np.linalg.norm(sample - sample[0], axis=1)
    small = float(nearest.max()) / 8
    probe = sample[:: max(1, len(sample) // 1024)]
    squares = (probe * probe).sum(axis=1)
    gaps = squares[:, None] + squares[None] - 2 * probe @ probe.T
    np.fill_diagonal(gaps, np.inf)
    if np.median(gaps.min(axis=1)) > small * small:
        return sample[:least]
    centers = [0]
    while nearest.max() > small and len(centers) < MOST_PIVOTS:
        if 2 * len(centers) > len(sample):
            return sample[:least]
        centers.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, np.linalg.norm(sample - sample[centers[-1]], axis=1))
    return sample[centers] if len(centers) >= least else np.concatenate([sample[centers], sample[:least]])


@dataclass(frozen=True)
class Cells:
    """Cells of one vector length: pivots, and radius and size of rows and queries."""

    centers: np.ndarray
    radius: np.ndarray
    count: np.ndarray
    query_radius: np.ndarray
    query_count: np.ndarray

    def bounds(self) -> np.ndarray:
        """For each cell of queries and of rows, what no product between them exceeds."""
        norms = np.linalg.norm(self.centers, axis=1)
        top = self.centers @ self.centers.T + norms[:, None] * self.radius[None] + norms[None] * self.query_radius[:, None]
        top += self.query_radius[:, None] * self.radius[None]
        slack = (norms[:, None] + self.query_radius[:, None]) * (norms[None] + self.radius[None])
        return top + 1e-9 * slack + 1e-9

    def first_pairs(self, k: int) -> list[tuple[int, int]]:
        """For each cell of queries the most promising cells that hold more than k rows."""
        likeness = self.centers @ self.centers.T
        pairs = []
        for i in np.flatnonzero(self.query_count).tolist():
            held = 0
            for j in np.argsort(-likeness[i], kind="stable").tolist():
                if self.count[j]:
                    pairs.append((i, j))
                    held += self.count[j]
                if held > k:
                    break
        return pairs

    def other_pairs(self, first: list[tuple[int, int]], least: dict[int, float]) -> list[tuple[int, int]]:
        """The other pairs that may reach a k-th score: ``least`` has that of each cell of queries."""
        floor = np.full(len(self.centers), -np.inf)
        for i, value in least.items():
            floor[i] = value
        wanted = (self.bounds() >= floor[:, None]) & (self.query_count[:, None] > 0) & (self.count[None] > 0)
        for i, j in first:
            wanted[i, j] = False
        return [(int(i), int(j)) for i, j in np.argwhere(wanted)]


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector: str = "embedding",
    query_block: int = 4096, row_block: int = 16_384, scale: int = 256, folder: str | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of each query but those of its id.

    Vectors that are null or hold a null or non-finite component, and those with a
    null id, take no part. Every other row counts, also where rows repeat or share an
    id; queries that share an id get the k best of all of them together. Only vectors of
    equal length meet. Of equal scores the smaller id comes first; with fewer than k
    candidates all are given. Scores are exact; one beyond 64 bits raises OverflowError.
    ``is_query`` is a condition on the column ``id``.

    A task has a block of queries and one of rows, of one cell each, so its memory does not
    depend on the input; cells larger than a block are cut by a hash. Pivots, and a number
    or two per pair of cells, come to the driver: ``MOST_PIVOTS`` bounds them.
    """
    spark = vectors.sparkSession
    folder = folder or shared_dir(spark)
    rows = (
        vectors.select(F.col(id_column).cast("bigint").alias("id"), quantise(F.col(vector), scale).alias("v"))
        .where("id IS NOT NULL AND v IS NOT NULL")
        .withColumn("d", F.size("v"))
        .withColumn("q", F.coalesce(is_query, F.lit(False)))
    )
    sizes = {
        r["d"]: r["n"] for r in rows.groupBy("d").agg(
            F.count("id").alias("n"), F.count(F.when(F.col("q"), 1)).alias("m")).where("m > 0").collect()
    }
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = rows.where(F.col("d").isin(sorted(sizes)))
    pivots = pivots_of(rows, sizes, row_block)
    placed = stored(cells_of(rows, pivots), f"{folder}/placed")
    cells, blocks = _cells(placed, query_block, row_block, pivots)
    placed = placed.join(F.broadcast(blocks), ["d", "cell"])

    def meet(pairs: dict[int, list[tuple[int, int]]], floors: DataFrame | None) -> DataFrame:
        listed = [(d, i, j) for d, own in pairs.items() for i, j in own]
        return _meet(placed, spark.createDataFrame(listed, "d int, qc int, rc int"), k, floors)

    first = {d: c.first_pairs(k) for d, c in cells.items()}
    begun = stored(_ranked(meet(first, None), k), f"{folder}/begun")
    # The k-th score of a query so far, and the least of them in each cell of queries.
    floors = begun.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    queries = placed.where("q").select("d", "cell", "id").join(floors, "id", "left")
    least: dict[int, dict[int, float]] = {}
    worst = queries.groupBy("d", "cell").agg(F.min(F.coalesce("floor", F.lit(-math.inf))))
    for d, cell, value in worst.collect():
        least.setdefault(d, {})[cell] = value
    others = {d: c.other_pairs(first[d], least[d]) for d, c in cells.items()}
    if not any(others.values()):
        return begun
    so_far = begun.select("query_id", "vec_id", "score")
    return _ranked(so_far.unionByName(meet(others, floors)), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _cells(
    placed: DataFrame, query_block: int, row_block: int, pivots: dict[int, np.ndarray]
) -> tuple[dict[int, Cells], DataFrame]:
    """What is known of the cells, and into how many blocks each is cut."""
    found = placed.groupBy("d", "cell").agg(
        F.count("id").alias("n"), F.max("away").alias("r"),
        F.count(F.when(F.col("q"), 1)).alias("m"), F.max(F.when(F.col("q"), F.col("away"))).alias("s"),
    ).collect()
    parts = {d: [np.zeros(len(p)) for _ in range(4)] for d, p in pivots.items()}
    for row in found:
        for values, value in zip(parts[row["d"]], (row["r"], row["n"], row["s"] or 0.0, row["m"])):
            values[row["cell"]] = value
    blocks = [
        (r["d"], r["cell"], math.ceil(r["n"] / row_block), max(1, math.ceil(r["m"] / query_block))) for r in found
    ]
    table = placed.sparkSession.createDataFrame(blocks, "d int, cell int, nr int, nq int")
    return {d: Cells(pivots[d], *values) for d, values in parts.items()}, table


def _meet(placed: DataFrame, pairs: DataFrame, k: int, floors: DataFrame | None) -> DataFrame:
    """``query_id, vec_id, score``: the k best rows of each query within the given pairs of cells."""
    # Of one type on both sides: keys meet by the hash of their type.
    block = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    sizes = placed.select("d", "cell", "nr", "nq").distinct()
    cut = (
        pairs.join(sizes.select("d", F.col("cell").alias("qc"), "nq"), ["d", "qc"])
        .join(sizes.select("d", F.col("cell").alias("rc"), "nr"), ["d", "rc"])
    )
    candidates = placed.select("d", F.col("cell").alias("rc"), "id", "v", block("nr").alias("r")).join(
        cut.select("d", "rc", "qc", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("s")), ["d", "rc"]
    )
    queries = placed.where("q")
    floor = F.lit(None).cast("long")
    if floors is not None:
        queries, floor = queries.join(floors, "id", "left"), F.col("floor")
    queries = queries.select(
        "d", F.col("cell").alias("qc"), "id", "v", floor.alias("floor"), block("nq").alias("s")
    ).join(
        cut.select("d", "rc", "qc", F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("r")), ["d", "qc"]
    )

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        floor = a.floor.astype(float).fillna(-np.inf).to_numpy()
        found = DualSearch(_matrix(a.qv), a.query_id.to_numpy(), _matrix(b.v), b.id.to_numpy(), k, floor)
        real = found.scores > -math.inf
        owner = np.repeat(found.query_ids, real.sum(axis=1))
        return pd.DataFrame(
            {"query_id": owner, "vec_id": found.best[real], "score": found.scores[real].astype(np.int64)}
        )

    keys = ["d", "qc", "s", "rc", "r"]
    # Names of their own, as both sides come from one table.
    own = [f"q{c}" for c in keys]
    left = queries.select(*keys, "id", "v", "floor").toDF(*own, "query_id", "qv", "floor")
    return left.groupBy(*own).cogroup(
        candidates.select(*keys, "id", "v").groupBy(*keys)
    ).applyInPandas(search, "query_id long, vec_id long, score long")


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float) if len(vectors) else np.empty((0, 0))
