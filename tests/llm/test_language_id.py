import itertools
import random

import numpy as np
from llm_cases import DOCUMENTS, SYLLABLES, documents, frame, sentence
from pyspark.sql import functions as F

from siltstone.llm import language_id
from siltstone.llm.common import crc_of_id


def trained(spark, rows=None):
    return language_id.train(frame(spark, rows), ~(crc_of_id("doc_id") % 4 == 2))


def test_held_out_accuracy(spark):
    rng = random.Random(5)
    rows = [(i, sentence(rng, l, 60), l, "s", 1) for i, l in enumerate(list(SYLLABLES) * 80)]
    docs = frame(spark, rows)
    held_out = crc_of_id("doc_id") % 4 == 2
    model = language_id.train(docs, ~held_out)
    got = language_id.identify(docs, model, [F.col("doc_id"), F.col("lang"), held_out.alias("h")]).where("h").collect()
    assert len(got) > 30
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows(spark):
    model = trained(spark)
    docs = frame(spark)
    got = language_id.identify(docs, model, [F.col("doc_id"), F.col("text")]).collect()
    assert len(got) == docs.count()
    for r in got:
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not letters)
        assert abs(sum(r["proportions"]) - (1 if letters else 0)) < 1e-6
    same = {}
    for r in got:
        assert same.setdefault(r["text"], r["lang_pred"]) == r["lang_pred"]


def test_nothing_learned(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    model = language_id.train(empty, F.lit(True))
    assert model.languages == ()
    assert language_id.identify(empty, model, [F.col("doc_id")]).count() == 0
    got = language_id.identify(frame(spark), model, [F.col("doc_id")]).collect()
    assert {r["lang_pred"] for r in got} == {"und"} and {r["score"] for r in got} == {0.0}


def test_mixture_of_two_languages(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, l, 80), l, "s", 1) for i, l in enumerate(list(SYLLABLES) * 60)]
    model = language_id.train(frame(spark, rows), F.lit(True))
    text = sentence(rng, "en", 300) + " " + sentence(rng, "de", 150)
    found = model.infer(text)
    assert list(found) == ["en", "de"] and 0.5 < found["en"] < 0.8
    assert list(model.infer(sentence(rng, "fr", 200))) == ["fr"]


def test_proportions_raise_the_likelihood_as_a_plain_search_does():
    rng = np.random.default_rng(3)
    p = rng.dirichlet(np.ones(50), 2)
    counts = rng.multinomial(4000, 0.3 * p[0] + 0.7 * p[1])
    w, value = language_id._proportions(p, counts, 200)
    grid = np.linspace(0.001, 0.999, 999)
    best = max((counts @ np.log(a * p[0] + (1 - a) * p[1]), a) for a in grid)
    assert abs(w[0] - best[1]) < 0.01 and value >= best[0] - 0.01


def test_chunks_do_not_change_counts(monkeypatch):
    text = documents()[0][1] * 5
    whole = language_id.trigram_counts(text)
    monkeypatch.setattr(language_id, "CHUNK", 7)
    parts = language_id.trigram_counts(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def learned(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, l, 80), l, "s", 1) for i, l in enumerate(list(SYLLABLES) * 60)]
    return language_id.train(frame(spark, rows), F.lit(True))


def test_set_of_languages_against_all_sets(spark):
    model, rng = learned(spark), random.Random(7)
    for _ in range(40):
        kinds = rng.sample(list(SYLLABLES), rng.randint(1, 3))
        text = " ".join(sentence(rng, l, rng.choice([3, 20, 120])) for l in kinds)
        buckets, counts, _ = language_id.trigram_counts(text)
        logs = model.log_p[:, buckets]
        p = np.exp(logs - logs.max(axis=0))
        best = None
        for n in range(1, len(model.languages) + 1):
            for some in itertools.combinations(range(len(model.languages)), n):
                _, value = language_id._proportions(p[list(some)], counts, 30)
                value -= (n - 1) * 2.0 * np.log(counts.sum() + 1)
                if best is None or value > best[0] + 1e-6:
                    best = value, {model.languages[i] for i in some}
        assert set(model.infer(text)) == best[1]


def test_fit_tells_gibberish_and_other_scripts(spark):
    model, rng = learned(spark), random.Random(8)
    for l in SYLLABLES:
        for words in (5, 20, 200):
            assert model.judge(sentence(rng, l, words))[1] > 0.6
    both = sentence(rng, "en", 60) + " " + sentence(rng, "de", 60)
    assert model.judge(both)[1] > 0.6
    for letters in ("bcdfghjkmnpqrstvwxz", "абвгдежзиклмнопр", "".join(map(chr, range(0x4E00, 0x4F00)))):
        text = " ".join("".join(rng.choice(letters) for _ in range(7)) for _ in range(40))
        assert model.judge(text)[1] < 0.35
    assert model.judge("12 !!") == ({}, 0.0)


def test_more_labels_than_the_model_takes(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 4)
    rng = random.Random(9)
    rows = [(i, sentence(rng, "en", 9), f"dirt{i}", "s", 1) for i in range(30)]
    rows += [(100 + i, sentence(rng, l, 30), l, "s", 1) for i, l in enumerate(list(SYLLABLES) * 5)]
    model = language_id.train(frame(spark, rows), F.lit(True))
    assert set(SYLLABLES) <= set(model.languages) and len(model.languages) == 4 and "dirt0" in model.languages
