import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import DOCUMENTS, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltstone.llm import packing
from siltstone.llm.packing import Capacity, FastTokenizer, cut, pack_block

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def fast():
    return FastTokenizer(JSON, RANKS)


ALPHABET = [" ", "  ", "\n", "\n\n", "\t", "a", "Be", "'s", "'ll", ".", "!?", "é", "12", "²", "漢", "😀", "\xa0", "\x1c", "<|endoftext|>"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=12))
def test_ids_are_the_tokenizers(fast, parts):
    text = "".join(parts)
    assert fast.ids(text) == np.array(fast.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_cut():
    assert cut(5, 1024) == [(0, 5)]
    assert cut(1024, 1024) == [(0, 1024)]
    assert cut(1025, 1024) == [(0, 1), (1, 1024)]
    assert cut(2048, 1024) == [(0, 1024), (1024, 1024)]


def check_packing(lengths, capacity, sequence, offset, made):
    for s in range(made):
        own = np.flatnonzero(sequence == s)
        assert len(own) and lengths[own].sum() <= capacity.tokens
        assert len(own) <= capacity.documents and (lengths[own] ** 2).sum() <= capacity.attention
        order = own[np.argsort(offset[own])]
        assert offset[order].tolist() == [0, *np.cumsum(lengths[order])[:-1]]


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_every_capacity_is_kept(score):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 101, 700)
    for capacity in (Capacity(100, 100, 10_000), Capacity(100, 3, 10_000), Capacity(100, 50, 10_100)):
        sequence, offset, made = pack_block(lengths, capacity, score, (1.0, 0.5, 0.5))
        check_packing(lengths, capacity, sequence, offset, made)


def test_best_fit_by_hand():
    # The 3 goes to the sequence of the 7, not to that of the 6.
    sequence, offset, made = pack_block(np.array([6, 7, 3, 4]), Capacity(10, 10, 100))
    assert made == 2 and sequence[1] == sequence[2] and sequence[0] == sequence[3]
    with pytest.raises(ValueError):
        pack_block(np.array([11]), Capacity(10, 10, 1000))
    assert pack_block(np.array([], int), Capacity())[2] == 0


def test_few_sequences():
    lengths = np.random.default_rng(2).integers(1, 1025, 4000)
    _, _, made = pack_block(lengths, Capacity())
    assert made <= 1.01 * lengths.sum() / 1024 + 1


def packed(docs):
    return packing.pack(packing.pieces(docs, JSON, RANKS, 2, 1024, [F.col("doc_id"), F.col("score")]))


def test_whole_table(spark):
    docs = frame(spark)
    rows = packed(docs).collect()
    tokenizer = Tokenizer.from_file(JSON)
    want = []
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        for k, (at, n) in enumerate(cut(len(ids), 1024)):
            want.append((r["doc_id"], k, at, n, zlib.crc32(ids[at : at + n].tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    numbers = {s: i for i, s in enumerate(sorted({r["sequence_id"] for r in rows}))}
    check_packing(
        np.array([r["length"] for r in rows]), Capacity(),
        np.array([numbers[r["sequence_id"]] for r in rows]), np.array([r["offset"] for r in rows]), len(numbers),
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCUMENTS).withColumn("score", F.lit(0.0))
    assert packed(docs).count() == 0


def naive(lengths, capacity, score, weights):
    """Vector best fit by trying every open sequence for every piece, longest first."""
    limit = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    left, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = np.array([lengths[i], 1, lengths[i] ** 2], float)
        best = None
        for n, room in enumerate(left):
            if (room >= need).all():
                if score == "dot":
                    value = -float((np.array(weights) * (need / limit)) @ (room / limit))
                else:
                    value = float((((room - need) / limit) ** 2) @ np.array(weights))
                if best is None or value < best[0] - 1e-12:
                    best = value, n
        if best is None:
            left.append(limit.copy())
            best = 0.0, len(left) - 1
        at = best[1]
        out[i] = at, int(limit[0] - left[at][0])
        left[at] = left[at] - need
    return [out[i] for i in range(len(lengths))], len(left)


@pytest.mark.parametrize("score", ["dot", "norm"])
@pytest.mark.parametrize("capacity", [Capacity(64, 64, 4096), Capacity(64, 4, 4096), Capacity(64, 9, 900)])
def test_placing_against_naive_best_fit(score, capacity):
    rng = np.random.default_rng(3)
    for n in (1, 5, 60):
        lengths = rng.integers(1, 31, n)
        for weights in ((1.0, 1.0, 1.0), (2.0, 0.5, 1.0)):
            sequence, offset, made = pack_block(lengths, capacity, score, weights)
            want, count = naive(lengths.tolist(), capacity, score, weights)
            assert list(zip(sequence.tolist(), offset.tolist())) == want and made == count
