import random
from collections import Counter

import pytest
import test_exact_dedup
import test_mixing
import test_near_dedup
from llm_cases import DOCUMENTS, SYLLABLES, documents, frame, sentence
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from siltstone.llm import language_id


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    frame(spark, documents(long_words=3000), extra=False).write.parquet(str(path / "documents.parquet"))
    return str(path)


def plain(df):
    return [tuple(r) for r in df.collect()]


def test_every_stage_on_its_own_input(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = plain(docs)
    for name, stage in pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = plain(docs)
        if name != "packing":
            assert docs.columns == DOCUMENTS.replace(" long", "").replace(" string", "").split(", ")
        if name == "language_id":
            model = language_id.train(spark.createDataFrame(before, DOCUMENTS), F.lit(True))
            fit = [r for r in before if model.judge(r[1] or "")[1] >= pipeline.LEAST_FIT]
            assert Counter(map(repr, after)) == Counter(map(repr, fit))
            # All prose stays; the one text in Chinese characters and others may go.
            assert {r[0] for r in before if r[0] is not None and r[0] < 100} <= {r[0] for r in after} and len(before) - len(after) < 12
        elif name == "exact_dedup":
            want = {(k, s) for _, k, _, _, s in test_exact_dedup.expected(before)}
            got = [(k, s) for _, k, _, kept, s in test_exact_dedup.expected(after)]
            assert len(got) == len(want) and set(got) == want
        elif name == "near_dedup":
            want = [i for i, _, _, kept in test_near_dedup.expected(before) if kept]
            assert Counter(r[0] for r in after) == Counter(want)
        elif name == "mixing":
            want = Counter(i for i, _, _ in test_mixing.expected(before))
            assert Counter(r[0] for r in after) == want
        else:
            assert Counter(r["doc_id"] for r in docs.where("piece = 0").collect()) == Counter(r[0] for r in before)
            sizes = Counter()
            for r in docs.collect():
                sizes[r["sequence_id"]] += r["length"]
            assert max(sizes.values()) <= 1024
        before = after


def test_gibberish_and_unlearned_languages_go(spark):
    rng = random.Random(6)
    prose = [(i, sentence(rng, l, 40), l, "s", 1) for i, l in enumerate(list(SYLLABLES) * 20)]
    both = [(500 + i, sentence(rng, "en", 30) + " " + sentence(rng, "fr", 30), "en", "s", 1) for i in range(5)]
    alphabets = ("bcdfghjklmnpqrstvwxz", "абвгдежзиклмнопрст", "".join(map(chr, range(0x4E00, 0x4F00))))
    junk = [
        (1000 + i, " ".join("".join(rng.choice(alphabets[i % 3]) for _ in range(6)) for _ in range(30)), None, "s", 1)
        for i in range(30)
    ]
    docs = spark.createDataFrame(prose + both + junk, DOCUMENTS)
    kept = {r.doc_id for r in pipeline.identify_language(spark, docs, "").collect()}
    assert kept == {r[0] for r in prose + both}


def test_run(spark, folder):
    got = pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 0


def test_empty_table_and_odd_columns(spark, tmp_path):
    empty = spark.createDataFrame([], DOCUMENTS)
    odd = frame(spark, documents(rows=20, long_words=50))
    for docs in (empty, odd):
        rows, columns = docs, docs.columns
        for name, stage in pipeline.STAGES:
            rows = stage(spark, rows, "")
            if name != "packing":
                assert rows.columns == columns
            rows.write.parquet(str(tmp_path / f"{name}-{len(columns)}"))
            rows = spark.read.parquet(str(tmp_path / f"{name}-{len(columns)}"))
    assert rows.count() > 0
