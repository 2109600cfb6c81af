"""Tokens and searches against SQLite's own FTS5 tables."""

import random
import sqlite3
import unicodedata

import pytest
from pyspark.sql import functions as F

from siltstone.functions import text
from siltstone.functions.text import highlight, query_tokens, tokens
from siltstone.operators import text_search as search
from siltstone.operators.text_index import TextIndex, docs_of, postings_of, with_changes


def fts(columns):
    db = sqlite3.connect(":memory:")
    try:
        db.execute(f"create virtual table t using fts5({', '.join(columns)})")
    except sqlite3.OperationalError:
        pytest.skip("SQLite without FTS5")
    return db


WORDS = "alpha beta gamma delta alphabet École ECOLE naïve the of".split()


def corpus(n=120, seed=3):
    rng = random.Random(seed)

    def words(low, high):
        return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", ".", "-x"])
                        for _ in range(rng.randint(low, high)))

    return [(i, words(0, 4), words(0, 30)) for i in range(1, n + 1)]


@pytest.fixture(scope="module")
def data(spark):
    rows = corpus()
    db = fts(["title", "selftext"])
    db.executemany("insert into t(rowid, title, selftext) values (?, ?, ?)", rows)
    df = spark.createDataFrame(rows, "id bigint, title string, selftext string").cache()
    postings = postings_of(df, "id", ("title", "selftext")).cache()
    return db, df, postings


def matches(db, query):
    return sorted(r[0] for r in db.execute("select rowid from t where t match ?", (query,)))


def ids(df):
    got = [r["doc_id"] for r in df.collect()]
    assert len(got) == len(set(got))
    return sorted(got)


def test_tokens_match_sqlite(spark):
    db = fts(["x"])
    db.execute("create virtual table v using fts5vocab(t, 'instance')")
    texts = ["", "Hello, WORLD_wide don't 3.14", "Éa èÈ ñÑ ß ẞ İstanbul ſtraße", "ộ ô ǖ ü",
             "été à́b xͅy", "Σίσυφος ΣΑΣ", "日本語 текст ЙЁ", "ab 😀c"]
    # U+037F is newer than SQLite's tables.
    letters = [chr(c) for c in range(0x80, 0x500)
               if unicodedata.category(chr(c))[0] in "LNM" and c != 0x37F]
    texts += [f"x{c}y {c}" for c in letters]
    for i, t in enumerate(texts):
        db.execute("insert into t(rowid, x) values (?, ?)", (i, t))
    want = {i: [] for i in range(len(texts))}
    for doc, term in db.execute("select doc, term from v order by doc, offset"):
        want[doc].append(term)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: list(r["k"]) for r in df.select("i", tokens(F.col("t")).alias("k")).collect()}
    different = {texts[i]: (got[i], want[i]) for i in want if got[i] != want[i]}
    assert different == {}, different


@pytest.mark.parametrize("query, run", [
    ("alpha", lambda p: search.term_docs(p, "alpha")),
    ("title : ecole", lambda p: search.term_docs(p, "ecole", "title")),
    ("alpha beta", lambda p: search.all_terms_docs(p, ["alpha", "beta"])),
    ("selftext : (alpha AND beta AND naive)",
     lambda p: search.all_terms_docs(p, ["alpha", "beta", "naive"], "selftext")),
    ("gamma OR naive", lambda p: search.any_term_docs(p, ["gamma", "naive"])),
    ("alpha NOT beta", lambda p: search.but_not(
        search.term_docs(p, "alpha"), search.term_docs(p, "beta"))),
    ("(alpha OR beta) AND delta", lambda p: search.all_of(
        search.any_of(search.term_docs(p, "alpha"), search.term_docs(p, "beta")),
        search.term_docs(p, "delta"))),
    ("alph*", lambda p: search.prefix_docs(p, "alph")),
    ("title : alph*", lambda p: search.prefix_docs(p, "alph", "title")),
    ('"alpha beta"', lambda p: search.phrase_docs(p, ["alpha", "beta"])),
    ('"the of the"', lambda p: search.phrase_docs(p, ["the", "of", "the"])),
    ('selftext : "beta gamma"', lambda p: search.phrase_docs(p, ["beta", "gamma"], "selftext")),
    ("NEAR(alpha beta, 2)", lambda p: search.near_docs(p, [["alpha"], ["beta"]], 2)),
    ("NEAR(alpha beta, 0)", lambda p: search.near_docs(p, [["alpha"], ["beta"]], 0)),
    ("NEAR(alpha beta gamma, 4)",
     lambda p: search.near_docs(p, [["alpha"], ["beta"], ["gamma"]], 4)),
    ('NEAR("alpha beta" delta, 3)', lambda p: search.near_docs(p, [["alpha", "beta"], ["delta"]], 3)),
])
def test_matching(data, query, run):
    db, _, postings = data
    expected = matches(db, query)
    assert ids(run(postings)) == expected
    assert expected or "NEAR" in query


@pytest.mark.parametrize("query, phrases, kwargs", [
    ("alpha", [["alpha"]], {}),
    ("alpha beta", [["alpha"], ["beta"]], {}),
    ("naive OR gamma OR zzz", [["naive"], ["gamma"], ["zzz"]], {"require_all": False}),
    ('"alpha beta" OR the', [["alpha", "beta"], ["the"]], {"require_all": False}),
])
@pytest.mark.parametrize("weights", [None, (10.0, 0.5)])
def test_ranking(data, query, phrases, kwargs, weights):
    db, df, postings = data
    given = f", {weights[0]}, {weights[1]}" if weights else ""
    want = dict(db.execute(f"select rowid, bm25(t{given}) from t where t match ?", (query,)))
    if weights:
        kwargs = {**kwargs, "weights": dict(zip(("title", "selftext"), weights))}
    ranks = search.ranked(postings, docs_of(df, "id", ("title", "selftext")), phrases, **kwargs)
    got = {r["doc_id"]: r["rank"] for r in ranks.collect()}
    assert got.keys() == want.keys() and got
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)
    best = [r["doc_id"] for r in search.top_k(ranks, 5).collect()]
    assert best == [i for i, _ in sorted(got.items(), key=lambda x: (x[1], x[0]))[:5]]


@pytest.mark.parametrize("query, phrases", [
    ("ecole", [["ecole"]]), ('"alpha beta"', [["alpha", "beta"]]), ("naive OR the", [["naive"], ["the"]]),
])
def test_highlight(data, query, phrases):
    db, df, _ = data
    sql = "select rowid, highlight(t, 1, '<b>', '</b>') from t where t match ?"
    want = dict(db.execute(sql, ("selftext : (" + query + ")",)))
    marked = df.select("id", highlight(F.col("selftext"), phrases, "<b>", "</b>").alias("m"))
    got = {r["id"]: r["m"] for r in marked.collect()}
    assert {i: got[i] for i in want} == want
    assert all("<b>" not in got[i] for i in got.keys() - want.keys())


def test_highlight_keeps_special_characters(spark):
    df = spark.createDataFrame([("cost $1 été Été étés",)], "t string")
    got = df.select(highlight(F.col("t"), [["ete"]], "$0\\", "")).first()[0]
    assert got == "cost $1 $0\\été $0\\Été étés"


def test_snippets_against_brute_force(spark, data):
    _, df, _ = data
    shown = 6
    got = {r["doc_id"]: r["snippet"] for r in search.snippets(
        df, "id", "selftext", [["alpha"], ["beta"]], tokens_shown=shown).collect()}
    words = {r["id"]: r["k"] for r in df.select("id", tokens(F.col("selftext")).alias("k")).collect()}
    for i, toks in words.items():
        starts = [p for p, t in enumerate(toks) if t in ("alpha", "beta")]
        assert bool(starts) == (i in got)
        if not starts:
            continue
        best = min(starts, key=lambda p: (-len({"alpha", "beta"} & set(toks[p:p + shown])), p))
        plain = got[i].replace("[", "").replace("]", "").strip(".")
        window = toks[best:best + shown]
        assert spark_free_tokens(plain) == window, (i, got[i])
        assert got[i].startswith("...") == (best > 0)
        assert got[i].count("[") == sum(t in ("alpha", "beta") for t in window)


def spark_free_tokens(s):
    import regex

    base = "".join(text.accent_folds().get(c, c) for c in s.lower())
    return regex.findall(text.TOKEN_CLASS + "+", base)


def test_changes(spark, data):
    _, df, postings = data
    changed = spark.createDataFrame([(1,), (2,)], "id bigint")
    new = spark.createDataFrame([(2, "omega", "alpha")], "id bigint, title string, selftext string")
    after = with_changes(postings, changed, new, "id", ("title", "selftext"))
    rows = [(r["doc_id"], r["term"]) for r in after.where("doc_id < 3").collect()]
    assert sorted(rows) == [(2, "alpha"), (2, "omega")]
    assert after.where("doc_id > 2").count() == postings.where("doc_id > 2").count()


def snapshot(df):
    return sorted(tuple(r) for r in df.select("term", "field", "doc_id", "pos", "doc_len").collect())


def test_stored_index(spark, data, tmp_path):
    _, df, postings = data
    fields = ("title", "selftext")
    index = TextIndex(spark, str(tmp_path / "i"), "id", fields, buckets=8)
    index.add_missing(df.where("id <= 50"))
    index.add_missing(df)
    assert snapshot(index.postings()) == snapshot(postings)
    assert not index.covers()
    index.cover()
    assert index.covers()
    # A term reads its own bucket only.
    plan = search.term_docs(index.postings(), "alpha")._jdf.queryExecution().executedPlan()
    files = search._of_terms(index.postings(), ["alpha"], None).select("_metadata.file_path")
    assert len({p["file_path"].split("term_bucket=")[1].split("/")[0] for p in files.collect()}) == 1
    assert "term_bucket" in plan.toString()
    # Deletes and updates.
    index.remove(df.where("id <= 10").select("id"))
    new = df.where("id between 11 and 20").withColumn("title", F.lit("omega"))
    index.replace(new)
    want = postings_of(df.where("id > 20").unionByName(new), "id", fields)
    assert snapshot(index.postings()) == snapshot(want)
    assert index.docs().count() == df.count() - 10
    # Removed documents come back only when added again.
    index.add_missing(df.where("id <= 5"))
    assert index.docs().count() == df.count() - 5
    assert search.term_docs(index.postings(), "omega").count() == 10
    fresh = index.compact(str(tmp_path / "j"))
    assert snapshot(fresh.postings()) == snapshot(index.postings())
    assert fresh.docs().count() == index.docs().count()


def test_unfinished_batches_do_not_count(spark, data, tmp_path):
    _, df, postings = data
    index = TextIndex(spark, str(tmp_path / "i"), "id", ("title", "selftext"), buckets=4)
    index.add_missing(df.where("id <= 60"))
    index.add_missing(df)
    done = tmp_path / "i" / "docs" / "batch=1" / "_SUCCESS"
    done.unlink()  # as after a crash between the two writes
    assert index.docs().count() == 60
    assert set(r["doc_id"] for r in index.postings().collect()) <= set(range(61))
    index.add_missing(df)
    assert snapshot(index.postings()) == snapshot(postings)


def test_query_text_is_folded(spark):
    assert query_tokens(spark, "Déjà-vu, ÇA!") == ["deja", "vu", "ca"]


def test_a_crash_within_replace_changes_nothing(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "old text"), (2, "other")], "id bigint, body string")
    index = TextIndex(spark, str(tmp_path), "id", ("body",), 4)
    index.add_missing(df)

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(index, "_write", crash)
    with pytest.raises(RuntimeError):
        index.replace(df.where("id = 1").selectExpr("id", "'new' AS body"))
    fresh = TextIndex(spark, str(tmp_path), "id", ("body",))
    assert sorted(r["term"] for r in fresh.postings().collect()) == ["old", "other", "text"]
    # What the crashed writer left must not come to life with the next batch.
    fresh.add_missing(spark.createDataFrame([(1, "old text"), (2, "other"), (3, "third")], df.schema))
    assert sorted(r["term"] for r in fresh.postings().collect()) == ["old", "other", "text", "third"]
    fresh.replace(df.where("id = 1").selectExpr("id", "'new' AS body"))
    assert sorted(r["term"] for r in fresh.postings().collect()) == ["new", "other", "third"]
