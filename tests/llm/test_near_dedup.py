import random

import numpy as np
import pytest
from llm_cases import DOCUMENTS, bag, documents, frame, sentence

from siltstone.llm import near_dedup
from siltstone.llm.components import components
from siltstone.llm.setsketch import SketchShape, low_matches, low_planes, matches_for
from siltstone.llm.shingles import many_word_hashes, mix, shingle_set, word_hashes


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def expected(rows):
    """By comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                group[top(i)] = top(j)
    out = []
    for i, a in enumerate(sets):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i)]
        least = min((x for x in ids if x is not None), default=None)
        out.append((rows[i][0], len(a), least, rows[i][0] == least))
    return out


def chained():
    """Versions of a text, each a little further from the first: links only between neighbours."""
    rng = random.Random(8)
    words = sentence(rng, "en", 150).split()
    rows = []
    for i in range(40):
        words[(7 * i) % 150] = f"w{i}"
        rows.append((1000 - i, " ".join(words), "en", "s", 1))
    boiler = sentence(rng, "en", 40)
    rows += [(i, boiler + " " + sentence(rng, "en", rng.choice([6, 9, 40, 90])), "en", "s", 1) for i in range(120)]
    rows += [(2000 + i, " ".join(["a", "b", "c", "d"][: 1 + i % 4]), "en", "s", 1) for i in range(9)]
    return rows


@pytest.mark.parametrize("rows", [documents(), chained()], ids=["odd", "chained"])
def test_against_all_pairs(spark, rows):
    got = near_dedup.near_groups(frame(spark, rows)).collect()
    assert bag(tuple(r) for r in got) == bag(expected(rows))


def test_keep_one(spark):
    rows = documents()
    kept = near_dedup.keep_one(frame(spark, rows)).collect()
    want = {i for i, _, _, k in expected(rows) if k}
    ids = [r["doc_id"] for r in kept]
    assert set(ids) == want and len([i for i in ids if i is not None]) == len(want - {None})
    assert ids.count(None) == 2  # one with a text, one without


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert near_dedup.near_groups(empty).count() == 0 and near_dedup.keep_one(empty).count() == 0


def test_small_tiles_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE", 8)
    rows = chained()
    got = near_dedup.near_groups(frame(spark, rows)).collect()
    assert bag(tuple(r) for r in got) == bag(expected(rows))


def test_word_hashes():
    texts = [b"", b" ", b"a b  a\nb\x0bc", b"a", "é ü x".encode(), b"x" * 100]
    found = many_word_hashes(texts)
    names = {}
    for t, h in zip(texts, found):
        assert len(h) == len(t.split()) and (h == word_hashes(t)).all()
        for w, x in zip(t.split(), h.tolist()):
            assert names.setdefault(w, x) == x
    assert len(set(names.values())) == len(names)


def test_long_texts_are_hashed_in_segments(monkeypatch):
    from siltstone.llm import shingles as module

    text = b" ".join(b"word%d" % (i % 97) for i in range(5000)) + b" " + b"y" * 3000
    whole = word_hashes(text)
    monkeypatch.setattr(module, "SEGMENT", 1000)
    assert (word_hashes(text) == whole).all()


def test_shingle_sets():
    a = word_hashes(b"a b c d e f a b c d e")
    assert len(shingle_set(a)) == 6 and len(shingle_set(a[:3])) == 1 and len(shingle_set(a[:0])) == 0
    assert shingle_set(a[:5])[0] not in shingle_set(a[:4])


def test_sketch_merges_and_estimates():
    shape = SketchShape()
    rng = np.random.default_rng(1)
    for n, j in ((3, 0.5), (40, 0.6), (2000, 0.8)):
        both = round(2 * n * j / (1 + j))
        a, b = [], []
        for _ in range(100):
            x = mix(rng.integers(0, 2**64, 2 * n - both, dtype=np.uint64))
            a.append(x[:n])
            b.append(x[n - both :])
        ra, rb = shape.sketch(a), shape.sketch(b)
        assert (shape.sketch([np.union1d(x, y) for x, y in zip(a, b)]) == np.maximum(ra, rb)).all()
        true = both / (2 * n - both)
        found = shape.joint_estimate(ra, rb, np.full(100, n), np.full(100, n))
        assert abs(found.mean() - true) < 0.02 and found.std() < 0.06
        low = np.diag(low_matches(low_planes(ra), low_planes(rb)))
        assert abs(low.mean() - matches_for(true, 128)) < 3
    assert (shape.sketch([np.empty(0, np.uint64)]) == 0).all()


def test_components(spark, tmp_path):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    links += [(500, x) for x in range(501, 560)] + [(7, 7)]
    parent = {x: x for e in links for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    got = components(spark.createDataFrame(links, "a long, b long"), str(tmp_path)).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert sorted(map(tuple, got)) == sorted((x, top(x)) for x in linked)
    assert components(spark.createDataFrame([], "a long, b long"), str(tmp_path / "none")).count() == 0
