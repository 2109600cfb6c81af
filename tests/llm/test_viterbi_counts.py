import math

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import DOCUMENTS, documents, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

from siltstone.llm.viterbi_counts import MARK, UnigramCounter, has_bytes, token_counts, vocabulary

#: Many ways to cut, with equal scores.
TIES = [(MARK, -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), (MARK + "a", -3.0), ("aa", -1.5), ("é", -4.0)]


def reference(pieces):
    t = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], unk_id=0))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=MARK, prepend_scheme="always", split=True)
    return t


@pytest.fixture(scope="module")
def real():
    pieces = vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return UnigramCounter(pieces), reference(pieces), pieces


def check(counter, tokenizer, text):
    found = tokenizer.encode(text, add_special_tokens=False)
    n, unknown, _ = counter.text(text)
    assert (n, unknown) == (len(found.ids), found.ids.count(0))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abé x\n漢▁", max_size=14))
def test_ties_go_as_in_the_tokenizer(text):
    check(UnigramCounter(TIES), reference(TIES), text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["the", "ing", " ", "  ", "é", "漢字", "😀", "\n", "x", "▁", "ß", "Ünd"]), max_size=10))
def test_real_vocabulary(real, parts):
    check(real[0], real[1], "".join(parts))


def test_score_is_that_of_the_best_split():
    scores = dict(TIES)

    def best(word):
        if not word:
            return 0.0
        return max((scores[word[:k]] + best(word[k:]) for k in range(1, len(word) + 1) if word[:k] in scores), default=-math.inf)

    counter = UnigramCounter(TIES)
    for word in ("abab", "aabba", "b", "ababababa"):
        assert math.isclose(counter.word(MARK + word)[2], best(MARK + word))


def test_long_words_hold_few_positions():
    counter = UnigramCounter(TIES)
    assert counter.text("ab" * 50_000) == (counter.text("ab" * 50_000))
    check(counter, reference(TIES), "aab" * 3000)


def test_whole_table(spark, real):
    counter, tokenizer, pieces = real
    got = token_counts(frame(spark), pieces, [F.col("doc_id"), F.col("text")]).collect()
    assert len(got) == len(documents())
    for r in got:
        assert r["n_tokens"] == len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)
        assert (r["score"] < 0) == (r["n_tokens"] > 0)
    empty = spark.createDataFrame([], DOCUMENTS)
    assert token_counts(empty, pieces, [F.col("doc_id")]).count() == 0
    assert token_counts(frame(spark), [], [F.col("doc_id")]).where("n_tokens <> n_unknown").count() == 0


def byte_reference(pieces):
    """All pieces, those of bytes at the end, and marks as sentencepiece puts them."""
    least = min(s for _, s in pieces)
    byte_pieces = [(f"<0x{b:02X}>", least) for b in range(256)]
    t = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces, *byte_pieces], unk_id=0, byte_fallback=True))
    t.normalizer = normalizers.Sequence([normalizers.Prepend(MARK), normalizers.Replace(" ", MARK)])
    return t


@pytest.fixture(scope="module")
def real_bytes(real):
    return UnigramCounter(real[2], byte_fallback=True, split=False), byte_reference(real[2])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["the", "ing", " ", "  ", " " * 19, "é", "漢字", "😀", "\n", "\n\n", "\t", "x", "▁", "\U0001f701", "ሀ", "Ünd"]
), max_size=10))
def test_bytes_and_runs_of_spaces(real_bytes, parts):
    check(*real_bytes, "".join(parts))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abé x\n漢▁", max_size=14))
def test_bytes_and_pieces_past_spaces(text):
    for pieces in (TIES, [*TIES, (MARK * 2, -2.5), ("b" + MARK + "a", -2.0)]):
        check(UnigramCounter(pieces, byte_fallback=True, split=False), byte_reference(pieces), text)


def test_unknown_characters_are_bytes(real_bytes):
    assert has_bytes(public_tokenizers.path("piece_bpe_32k.model"))
    counter = real_bytes[0]
    assert counter.text("\U0001f701\U0001f702")[:2] == (9, 0)
    assert counter.text("a\n\nb")[:2] == (4, 0)
    spaces = "a" + " " * 17 + "b"
    check(*real_bytes, spaces)
    assert counter.text(spaces)[0] < 18  # a piece for each space, as with split


def test_table_with_bytes(spark, real, real_bytes):
    got = token_counts(frame(spark), real[2], [F.col("text")], byte_fallback=True, split=False).collect()
    assert len(got) == len(documents())
    for r in got:
        assert r["n_tokens"] == len(real_bytes[1].encode(r["text"] or "", add_special_tokens=False).ids)
        assert r["n_unknown"] == 0
