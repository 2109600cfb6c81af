import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_cases import DOCUMENTS, documents, frame
from pyspark.sql import functions as F

from siltstone.llm import brown_lm as lm
from siltstone.llm.common import crc_of_id

SMALL = lm.BrownSettings(head_words=40, cluster_words=15, suffixes=5, classes=4)


def units_of(docs, training, settings, folder, keep=()):
    """Counts, coded texts and the model of units."""
    groups = lm.Groups(docs.sparkSession, folder)
    counted = lm.count_words(docs.where(training).select("text"), settings, folder)
    coded = groups.stored(lm.coded_texts(docs, counted.head, settings, training, list(keep), "text"), "coded-0")
    return groups, counted, coded, *lm.train_units(coded, counted, settings)


def scored(docs, settings=SMALL):
    held_out = crc_of_id("doc_id") % 10 == 0
    return lm.score_texts(docs, ~held_out, [F.col("doc_id"), F.col("text"), held_out.alias("held_out")], settings=settings)


def test_words_of_a_column():
    texts = ["  a B\tc\n", "", " ", None, "É\x0bx\x0cy\rz \x1c \x85q\u2003w", "one", "x\x00y \x1f Z İ"]
    found = lm.Words(pa.array(texts))
    got = [[] for _ in texts]
    for i, n in zip(found.text, found.numbers):
        got[i].append(found.distinct[int(n)].as_py())
    assert got == [lm.words(None if t is None else t.encode()) for t in texts]


def test_packed_runs():
    values, sizes = np.arange(6, dtype=np.int32), np.array([2, 0, 3, 1])
    column = lm.packed(values, sizes)
    assert [np.frombuffer(b, np.int32).tolist() for b in column.to_pylist()] == [[0, 1], [], [2, 3, 4], [5]]
    for a, b in ((0, 4), (1, 3), (2, 2), (1, 2)):
        back, lengths = lm.unpacked(column.slice(a, b - a), np.int32)
        assert lengths.tolist() == sizes[a:b].tolist() and back.tolist() == values[sizes[:a].sum() : sizes[:b].sum()].tolist()


def test_counts_against_brute_force(spark):
    rows = documents()
    got = scored(frame(spark)).collect()
    assert len(got) == len(rows)
    counts = Counter()
    for r in rows:
        if zlib.crc32(str(r[0]).encode() if r[0] is not None else b"") % 10:
            counts.update([*(r[1] or "").encode().lower().split(), b""])
    total, distinct = sum(counts.values()), len(counts)
    for r in got:
        tokens = [*(r["text"] or "").encode().lower().split(), b""]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        known = sum(counts[t] > 0 for t in tokens)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0


def test_score_is_that_of_classes_and_words(spark, tmp_path):
    rows = [(i, r[1], *r[2:]) for i, r in enumerate(documents()[:60])]
    docs = frame(spark, rows)
    training = F.col("doc_id") < 50
    _, counted, _, model, _ = units_of(docs, training, SMALL, str(tmp_path))
    number = {bytes(r["w"]): r["n"] for r in counted.words.collect()}
    unit = lm.UnitOf([w for w, _ in model.head], SMALL)
    # Probabilities of a class's words, and of one unknown word, add up to 1; so do steps.
    assert np.allclose((10**model.step).sum(axis=1), 1)
    for c in range(SMALL.classes):
        own = [n for w, n in number.items() if model.unit_class[unit[w]] == c]
        assert math.isclose(sum(n + 0.1 for n in own) + 0.1, 10 ** model.size[c], rel_tol=1e-9)
    for r in lm.score_texts(docs, training, [F.col("doc_id")], settings=SMALL).collect():
        tokens = [*rows[r["doc_id"]][1].encode().lower().split(), b""]
        classes = [model.unit_class[unit[t]] for t in [b"", *tokens]]
        want = sum(model.step[a, b] for a, b in zip(classes, classes[1:]))
        want += sum(math.log10(number.get(t, 0) + 0.1) - model.size[c] for t, c in zip(tokens, classes[1:]))
        assert math.isclose(r["score"], want, rel_tol=1e-9)


def test_head_size_does_not_change_base_scores(spark):
    docs = frame(spark)
    few = scored(docs).select("doc_id", "n_known", F.round("base_score", 6).alias("b")).collect()
    many = scored(docs, lm.BrownSettings()).select("doc_id", "n_known", F.round("base_score", 6).alias("b")).collect()
    assert sorted(map(repr, few)) == sorted(map(repr, many))


def test_empty_and_untrained(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert scored(empty).count() == 0
    got = lm.score_texts(frame(spark), F.lit(False), [F.col("doc_id")], settings=SMALL).collect()
    assert {r["train_tokens"] for r in got} == {0} and {r["n_known"] for r in got} == {0}
    assert all(math.isfinite(r["score"]) and abs(r["base_score"]) < 1e-6 for r in got)


def naive_best(pairs, own, i, classes):
    best = None
    for c in range(classes):
        trial = own.copy()
        trial[i] = c
        table = np.zeros((classes, classes))
        np.add.at(table, (trial[:, None], trial[None, :]), pairs)
        value = lm.information(table)
        if best is None or value > best[0] + 1e-9 or (c == own[i] and value > best[0] - 1e-9):
            best = value, c
    return best[1]


def test_exchange_moves_as_full_recomputation_does():
    rng = np.random.default_rng(4)
    pairs = rng.poisson(0.8, (14, 14)).astype(float)
    own = np.arange(14) % 3
    for i in range(14):
        own[i] = naive_best(pairs, own, i, 3)
    assert (lm.exchange(pairs, 3, 1) == own).all()


def test_exchange_finds_classes():
    rng = random.Random(1)
    pairs = np.zeros((20, 20))
    for _ in range(20_000):  # ten words that only follow ten others, and the reverse
        a, b = rng.randrange(10), 10 + rng.randrange(10)
        pairs[a, b] += 1
        pairs[b, rng.randrange(10)] += 1
    own = lm.exchange(pairs, 2, 10)
    assert len(set(own[:10])) == 1 and len(set(own[10:])) == 1 and own[0] != own[10]


def test_best_classes_are_those_of_full_recomputation():
    rng = np.random.default_rng(6)
    pairs = rng.poisson(0.8, (16, 16)).astype(float)
    np.fill_diagonal(pairs, 0)
    own = np.arange(16) % 4
    counts = np.zeros((16, 8))
    for i in range(16):
        counts[i, :4], counts[i, 4:] = np.bincount(own, pairs[i], 4), np.bincount(own, pairs[:, i], 4)
    got = lm.best_classes(lm.class_table(pairs, own, 4), *entries(counts, 4), own)
    assert got.tolist() == [naive_best(pairs, own, i, 4) for i in range(16)]


def entries(counts, c):
    sides = []
    for side in (counts[:, :c], counts[:, c:]):
        w, j = np.nonzero(side)
        sides.append((w, j, side[w, j].astype(np.int64)))
    return sides


def dense_best(table, counts, old):
    """Every candidate by taking the word out of the table and putting it in."""
    out = []
    for n, o in enumerate(old):
        right, left = counts[n, : len(table)], counts[n, len(table) :]
        bare = table.copy()
        bare[o] -= right
        bare[:, o] -= left
        bare = np.maximum(bare, 0)
        values = []
        for c in range(len(table)):
            full = bare.copy()
            full[c] += right
            full[:, c] += left
            rows, columns = bare.sum(axis=1), bare.sum(axis=0)
            # Marginals count what the word is next to as belonging to some class already.
            rows = np.maximum(table.sum(axis=1) - np.where(np.arange(len(table)) == o, right.sum(), 0), 0)
            columns = np.maximum(table.sum(axis=0) - np.where(np.arange(len(table)) == o, left.sum(), 0), 0)
            rows[c] += right.sum()
            columns[c] += left.sum()
            values.append(lm._f(full).sum() - lm._f(rows).sum() - lm._f(columns).sum())
        best = int(np.argmax(values))
        out.append(best if values[best] > values[o] + 1e-9 else o)
    return out


def test_best_classes_of_large_and_small_counts(monkeypatch):
    monkeypatch.setattr(lm, "DECIDED_WORDS", 50)
    rng = np.random.default_rng(8)
    c, n = 6, 180
    old = rng.integers(0, c, n)
    counts = rng.poisson(rng.choice([0.2, 1.5, 40], (n, 1)), (n, 2 * c))
    table = rng.poisson(50, (c, c)).astype(float)
    for w in range(n):
        table[old[w]] += counts[w, :c]
        table[:, old[w]] += counts[w, c:]
    assert lm.best_classes(table, *entries(counts, c), old).tolist() == dense_best(table, counts, old)


def test_rare_words_choose_their_classes(spark, tmp_path):
    """Beyond the clustered and the broadcast words, a word goes by its neighbours, not its ending."""
    rng = random.Random(2)
    kinds = [[f"{k}{i:03}x{rng.randrange(900)}" for i in range(60)] for k in "ab"]
    texts = [" ".join(rng.choice(kinds[j % 2]) for j in range(40)) for _ in range(150)]
    docs = frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    settings = lm.BrownSettings(head_words=30, cluster_words=10, suffixes=5, classes=3, least_count=3, word_sweeps=6)
    groups, counted, coded, model, table = units_of(docs, F.lit(True), settings, str(tmp_path), [F.col("text")])
    better, now = lm.exchange_words(coded, model, counted, table, groups)
    class_of = {w: int(c) for (w, _), c in zip(model.head, better.head_class)}
    for r in now.collect():
        found = dict(zip([*r["text"].encode().split(), b""], np.frombuffer(r["__class"], lm.CLASS_TYPE).tolist()))
        assert all(class_of.setdefault(w, c) == c for w, c in found.items())
    number = Counter(w for t in texts for w in t.encode().split())
    assert {w for w, n in number.items() if n >= 3} <= set(class_of)
    tables = np.zeros((3, 3))
    for t in texts:
        line = [class_of[w] for w in [b"", *t.encode().split(), b""]]
        for a, b in zip(line, line[1:]):
            tables[a, b] += 1
    assert lm.information(tables) > lm.information(table)
    assert np.allclose(np.log10((tables + 10 * _often(better, number, class_of, len(texts))) / (tables.sum(1, keepdims=True) + 10)), better.step)
    plain = lm.score_texts(docs, F.lit(True), [F.col("doc_id")], settings=lm.BrownSettings(30, 10, 5, 3))
    chosen = lm.score_texts(docs, F.lit(True), [F.col("doc_id")], settings=settings).collect()
    assert sum(r["score"] for r in chosen) > sum(r["score"] for r in plain.collect())
    for r in chosen:
        tokens = [*texts[r["doc_id"]].encode().split(), b""]
        line = [class_of[w] for w in [b"", *tokens]]
        want = sum(better.step[a, b] for a, b in zip(line, line[1:]))
        want += sum(math.log10(number.get(w, len(texts)) + 0.1) - better.size[class_of[w]] for w in tokens)
        assert math.isclose(r["score"], want, rel_tol=1e-9)


def _often(model, number, class_of, ends):
    tokens = np.zeros(3)
    for w, n in [*number.items(), (b"", ends)]:
        tokens[class_of[w]] += n
    return (tokens + 0.5) / (tokens.sum() + 1.5)


def test_word_classes_on_odd_rows(spark):
    settings = lm.BrownSettings(head_words=40, cluster_words=15, suffixes=5, classes=4, least_count=1)
    few = scored(frame(spark), settings).select("doc_id", "n_known", F.round("base_score", 6).alias("b")).collect()
    many = scored(frame(spark)).select("doc_id", "n_known", F.round("base_score", 6).alias("b")).collect()
    assert sorted(map(repr, few)) == sorted(map(repr, many))
    assert scored(spark.createDataFrame([], DOCUMENTS), settings).count() == 0
    assert lm.score_texts(frame(spark), F.lit(False), [F.col("doc_id")], settings=settings).count() == len(documents())
    held = scored(frame(spark), lm.BrownSettings(cluster_words=15, suffixes=5, classes=4, least_count=2))
    assert held.count() == len(documents())  # tasks hold all words
