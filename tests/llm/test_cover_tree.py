import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import cover_tree

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, k=5, every=50):
    vectors = []
    for i, v, _ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vectors.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for i in sorted({i for i, _ in vectors if i % every == 0}):
        scores = sorted(
            (-sum(a * b for a, b in zip(q, v)), j)
            for n, q in vectors if n == i for j, v in vectors if j != i and len(v) == len(q)
        )
        out += [(i, n, j, -s) for n, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def cases(n=700, dims=6):
    rng = random.Random(3)
    centers = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centers)], 1) for i in range(n)]
    rows += [(n + i, [1.0] * dims, None) for i in range(60)]  # ties
    rows += [(5000, None, 1), (5050, [1.0, None] * 3, 1), (5100, [float("nan")] * dims, 1), (5150, [float("inf")] * dims, 1),
             (None, [1.0] * dims, 1), (5200, [], 1), (5250, [2.0, 1.0], 1), (5251, [2.0, 1.5], 1), (5300, [1e30] + [0.0] * (dims - 1), 1)]
    return rows + rows[:3] + [(50, [9.0] * dims, 1)]


def run(spark, rows, **settings):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS v", "3 AS d", "4 AS q").repartition(3)
    return sorted(map(tuple, cover_tree.top_k(df, F.col("id") % 50 == 0, **settings).collect()))


def test_rows_that_share_an_id(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (1, [1.0, 0.0], 1), (50, [0.0, 1.0], 1), (50, [1.0, 1.0], 1)]
    assert run(spark, rows) == expected(rows)
    assert run(spark, rows)[0] == (0, 1, 1, 65536)


def clustered(n, clusters, dims, queries, seed=5):
    """Points in small clusters far from each other; the first rows are queries of few of them."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 1, (clusters, dims))
    centers /= np.linalg.norm(centers, axis=1)[:, None]
    own = rng.integers(0, clusters, n)
    points = centers[own] * 8 + rng.normal(0, 0.01, (n, dims))
    ids = np.arange(n) * 50 + 1
    ids[:queries] -= 1
    return [(int(i), p.tolist(), 1) for i, p in zip(ids, points)]


@pytest.mark.parametrize("clusters, queries", [(60, 100), (500, 400)])
def test_cells_spare_copies_at_shipped_settings(spark, monkeypatch, clusters, queries):
    rows = clustered(40_000, clusters, 16, queries)
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    seen, cells, whole = [], [], cover_tree._meet

    def counted(placed, pairs, k, floors):
        seen.append(pairs.count())
        cells.append(placed.select("cell").distinct().count())
        return whole(placed, pairs, k, floors)

    monkeypatch.setattr(cover_tree, "_meet", counted)
    got = cover_tree.top_k(df, F.col("id") % 50 == 0, row_block=4096).collect()
    points = np.floor(256 * np.array([np.float32(p) for _, p, _ in rows], float))
    ids = np.array([i for i, _, _ in rows])
    mine = {i: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == i] for i in ids[:queries:37].tolist()}
    for n in range(0, queries, 37):
        scores = points @ points[n]
        scores[n] = -np.inf
        best = np.lexsort((ids, -scores))[:5]
        assert mine[int(ids[n])] == [(int(ids[j]), int(scores[j])) for j in best]
    # Pairs of cells that met, of all, with few queries in some of the cells.
    assert cells[0] >= clusters and sum(seen) < 5 * cells[0]


@pytest.mark.parametrize("clusters, queries, rows", [(2000, 4096, 16_384), (60, 400, 20_000)])
def test_trees_prune_at_shipped_settings(clusters, queries, rows):
    points = np.floor(256 * np.array([p for _, p, _ in clustered(rows, clusters, 64, 0)]))
    ids = np.arange(rows)
    found = cover_tree.DualSearch(points[:queries], ids[:queries], points, ids, 5)
    assert found.q.root.children and found.r.root.children and found.pruned > 100
    for n in range(0, queries, 97):
        at = int(np.flatnonzero(found.query_ids == n)[0])
        scores = points @ points[n]
        scores[n] = -np.inf
        best = np.lexsort((ids, -scores))[:5]
        assert found.best[at].tolist() == best.tolist() and found.scores[at].tolist() == scores[best].tolist()


def test_scattered_points_stay_a_leaf():
    points = np.random.default_rng(1).normal(size=(4000, 64))
    assert not cover_tree.CoverTree(points).root.children
    assert len(cover_tree.spread_pivots(points, 5)) == 5


@pytest.mark.parametrize("blocks", [{}, {"query_block": 3, "row_block": 40}])
def test_against_brute_force(spark, monkeypatch, blocks):
    rows = [r for r in cases() if r[0] != 5300]
    assert run(spark, rows, **blocks) == expected(rows)


def test_empty_and_single(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0], 1)]) == []
    assert run(spark, [(0, [1.0], 1), (1, [-1.0], 1)]) == [(0, 1, 1, -65536)]


def brute(q, qi, r, ri, k):
    out = []
    for a, i in zip(q, qi):
        found = sorted((-int(a @ b), int(j)) for b, j in zip(r, ri) if j != i)
        out.append([(j, -s) for s, j in found[:k]])
    return out


@pytest.mark.parametrize("leaf", [1, 8])
def test_trees_prune_and_stay_exact(monkeypatch, leaf):
    monkeypatch.setattr(cover_tree, "LEAF", leaf)
    monkeypatch.setattr(cover_tree, "QUERY_LEAF", leaf)
    rng = np.random.default_rng(1)
    centers = rng.integers(-900, 900, (12, 4))
    points = (centers[rng.integers(0, 12, 900)] + rng.integers(-9, 9, (900, 4))).astype(float)
    ids = rng.permutation(900)
    found = cover_tree.DualSearch(points[:90], ids[:90], points, ids, 5)
    assert found.pruned > 0
    got = {int(i): list(zip(b.tolist(), s.astype(int).tolist())) for i, b, s in zip(found.query_ids, found.best, found.scores)}
    assert got == dict(zip(ids[:90].tolist(), brute(points[:90], ids[:90], points, ids, 5)))


def test_tree_covers_its_points():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(c, 0.2, (400, 3)) for c in (0, 5, 9)])
    tree = cover_tree.CoverTree(points)
    assert sorted(tree.order.tolist()) == list(range(1200)) and tree.root.children

    def visit(node):
        own = points[tree.order[node.start : node.end]]
        assert np.linalg.norm(own - node.center, axis=1).max() <= node.radius + 1e-9
        for c in node.children:
            visit(c)
        if node.children:
            assert node.children[0].start == node.start and node.children[-1].end == node.end
            centers = np.array([c.center for c in node.children])
            apart = np.linalg.norm(centers[:, None] - centers[None], axis=2) + 1e9 * np.eye(len(centers))
            assert apart.min() > node.radius / cover_tree.SHRINK

    visit(tree.root)


def test_scores_beyond_doubles_are_exact():
    big = 2.0**30
    q, r = np.array([[big, 1.0]]), np.array([[big, 3.0], [big, 2.0]])
    found = cover_tree.DualSearch(q, np.array([9]), r, np.array([1, 2]), 2)
    assert not found.exact and found.best[0].tolist() == [1, 2]
