"""The stored index: dictionary, bounds, merging; each against the plain search."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import term_dictionary, text_index
from siltstone.operators import text_search as search
from siltstone.operators.text_index import TextIndex, docs_of, entries_of, postings_of
from test_text import corpus, fts, ids, matches

FIELDS = ("title", "selftext")


@pytest.fixture(scope="module")
def data(spark):
    rows = corpus()
    db = fts(["title", "selftext"])
    db.executemany("insert into t(rowid, title, selftext) values (?, ?, ?)", rows)
    df = spark.createDataFrame(rows, "id bigint, title string, selftext string").cache()
    return db, df, entries_of(df, "id", FIELDS).cache()


def test_entries_are_grouped_postings(data):
    _, df, entries = data
    split = entries.select("term", "field", "doc_id", F.posexplode("positions"), "doc_len", "tf")
    got = sorted((r.term, r.field, r.doc_id, r.col, r.doc_len) for r in split.collect())
    want = sorted(map(tuple, postings_of(df, "id", FIELDS).collect()))
    assert got == want
    assert entries.where("tf <> size(positions)").isEmpty()
    firsts = entries.where("first").groupBy("term").count().collect()
    docs = postings_of(df, "id", FIELDS).groupBy("term").agg(F.countDistinct("doc_id").alias("n"))
    assert {r["term"]: r["count"] for r in firsts} == {r.term: r.n for r in docs.collect()}


def test_entries_of_empty_texts(spark):
    df = spark.createDataFrame([(1, "", None), (2, None, "... "), (3, "a", "a a")], "id long, x string, y string")
    rows = entries_of(df, "id", ("x", "y"), with_docs=True).collect()
    assert sorted((r.doc_id, r.doc_len) for r in rows if r.term is None) == [(1, 0), (2, 0), (3, 3)]
    assert sorted((r.field, r.first, list(r.positions)) for r in rows if r.term) == [
        ("x", True, [0]), ("y", False, [0, 1])]


QUERIES = [
    ("alpha", lambda p: search.term_docs(p, "alpha")),
    ("title : ecole", lambda p: search.term_docs(p, "ecole", "title")),
    ("alpha beta", lambda p: search.all_terms_docs(p, ["alpha", "beta"])),
    ("gamma OR naive", lambda p: search.any_term_docs(p, ["gamma", "naive"])),
    ("alph*", lambda p: search.prefix_docs(p, "alph")),
    ("title : alph*", lambda p: search.prefix_docs(p, "alph", "title")),
    ("alph* AND de*", lambda p: search.all_terms_docs(p, ["alph*", "de*"])),
    ('"alpha beta"', lambda p: search.phrase_docs(p, ["alpha", "beta"])),
    ('"the of the"', lambda p: search.phrase_docs(p, ["the", "of", "the"])),
    ('"beta alph" *', lambda p: search.phrase_docs(p, ["beta", "alph*"])),
    ('selftext : "the of e" *', lambda p: search.phrase_docs(p, ["the", "of", "e*"], "selftext")),
    ("NEAR(alpha beta, 2)", lambda p: search.near_docs(p, [["alpha"], ["beta"]], 2)),
    ("NEAR(alph* beta, 1)", lambda p: search.near_docs(p, [["alph*"], ["beta"]], 1)),
    ('NEAR("alpha beta" de*, 3)', lambda p: search.near_docs(p, [["alpha", "beta"], ["de*"]], 3)),
]


@pytest.mark.parametrize("query, run", QUERIES, ids=[q for q, _ in QUERIES])
def test_matching(data, query, run):
    db, df, entries = data
    expected = matches(db, query)
    assert ids(run(entries)) == expected and expected
    if "*" in query:
        assert ids(run(postings_of(df, "id", FIELDS))) == expected


@pytest.mark.parametrize("query, phrases, kwargs", [
    ("alpha beta", [["alpha"], ["beta"]], {}),
    ("alph*", [["alph*"]], {}),
    ('"beta alph" * OR the', [["beta", "alph*"], ["the"]], {"require_all": False}),
    ("de* naive", [["de*"], ["naive"]], {}),
])
def test_ranking(data, query, phrases, kwargs):
    db, df, entries = data
    want = dict(db.execute("select rowid, bm25(t) from t where t match ?", (query,)))
    ranks = search.ranked(entries, docs_of(df, "id", FIELDS), phrases, **kwargs)
    got = {r["doc_id"]: r["rank"] for r in ranks.collect()}
    assert got.keys() == want.keys() and got
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_highlight_of_prefixes(data):
    from siltstone.functions.text import highlight

    db, df, _ = data
    for query, phrases in (("alph*", [["alph*"]]), ('"beta alph" *', [["beta", "alph*"]]), ("ec*", [["ec*"]])):
        sql = "select rowid, highlight(t, 1, '<', '>') from t where t match ?"
        want = dict(db.execute(sql, ("selftext : (" + query + ")",)))
        marked = df.select("id", highlight(F.col("selftext"), phrases, "<", ">").alias("m"))
        got = {r["id"]: r["m"] for r in marked.collect()}
        assert {i: got[i] for i in want} == want and want


def test_front_coding():
    rng = random.Random(2)
    terms = sorted({"".join(rng.choice("abé漢") for _ in range(rng.randint(1, 6))) for _ in range(500)})
    shared, rest = term_dictionary.front_coded(terms)
    assert term_dictionary.spelled_out(shared, rest) == terms
    assert sum(map(len, rest)) < sum(map(len, terms))


def many_terms(spark, n=3000):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        common = [w for w, p in (("often", 0.6), ("some", 0.3), ("rare", 0.01)) if rng.random() < p]
        words = common * rng.choice([1, 1, 1, 2, 3]) + [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(1, 12))]
        if i % 700 == 0:
            words = ["often"] * 40 + ["some"] * 8
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, "id bigint, body string")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    text_index_values = {n: getattr(text_index, n) for n in ("BLOCK_DOCS", "BOUNDED_DOCS", "PAGE_ROWS", "BUCKET_DOCS")}
    text_index.BLOCK_DOCS, text_index.BOUNDED_DOCS, text_index.PAGE_ROWS = 16, 100, 64
    text_index.BUCKET_DOCS = 100
    try:
        df = many_terms(spark).cache()
        index = TextIndex(spark, str(tmp_path_factory.mktemp("index")), "id", ("body",), buckets=16)
        index.add_missing(df.where("id < 2000"))
        index.add_missing(df)
        yield df, index
    finally:
        for name, value in text_index_values.items():
            setattr(text_index, name, value)


def files_of(df):
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


def test_prefix_reads_its_buckets_only(stored):
    df, index = stored
    everything = files_of(index.entries())
    found = index.entries(["w4901*"])
    assert 0 < len(files_of(found)) < len(everything) / 2
    assert ids(search.prefix_docs(found, "w4901")) == ids(
        search.prefix_docs(entries_of(df, "id", ("body",)), "w4901"))
    assert index.entries(["zzz*"]).isEmpty()
    both = search.any_term_docs(index.entries(["w49*", "rare"]), ["w49*", "rare"])
    assert ids(both) == ids(search.any_term_docs(entries_of(df, "id", ("body",)), ["w49*", "rare"]))


def test_dictionary_counts_documents(stored):
    df, index = stored
    want = postings_of(df, "id", ("body",)).groupBy("term").agg(F.countDistinct("doc_id").alias("n"))
    want = {r.term: r.n for r in want.where("term like 'w1%' or term = 'often'").collect()}
    got = index.lookup(["w1*", "often"]).groupBy("term").agg(F.sum("docs").alias("n"))
    assert {r.term: r.n for r in got.collect()} == want


def rows_read(df):
    """Rows that the scans of the executed plan gave."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
    return found


def full(index, terms, k, digits=None, **kwargs):
    ranks = search.ranked(index.entries(terms), index.docs(), [[t] for t in terms], **kwargs)
    if digits is not None:
        ranks = ranks.withColumn("rank", F.round("rank", digits))
    return [(r.doc_id, r["rank"]) for r in search.top_k(ranks, k).collect()]


@pytest.mark.parametrize("terms, k, kwargs", [
    (["often"], 5, {}), (["often"], 40, {"digits": 3}), (["some", "often"], 7, {}),
    (["some", "often", "w7"], 10, {"require_all": False}), (["rare", "often"], 3, {}),
    (["absent", "often"], 3, {}), (["absent", "often"], 3, {"require_all": False}),
    (["often"], 5000, {}), (["often", "some"], 12, {"weights": {"body": 2.5}, "digits": 1}),
])
def test_best_blocks_give_the_full_ranking(stored, terms, k, kwargs):
    _, index = stored
    got = [(r.doc_id, r["rank"]) for r in search.best_of_index(index, terms, k, **kwargs).collect()]
    want = full(index, sorted(terms), k, **kwargs)
    assert [d for d, _ in got] == [d for d, _ in want]
    assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(got, want))


def test_blocks_stay_unread(stored, monkeypatch):
    _, index = stored
    monkeypatch.setattr(search, "FIRST_BLOCKS", 4)
    best = search.best_of_index(index, ["often"], 3)
    everything = search.term_docs(index.entries(["often"]), "often").count()
    assert best.collect()[0].doc_id % 700 == 0
    assert 0 < rows_read(best) < everything / 2


def test_best_after_removal(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text_index, "BOUNDED_DOCS", 50)
    monkeypatch.setattr(text_index, "BLOCK_DOCS", 8)
    df = many_terms(spark, 800)
    index = TextIndex(spark, str(tmp_path), "id", ("body",))
    index.add_missing(df)
    index.remove(df.where("id % 700 = 0").select("id"))
    for terms in (["often"], ["often", "some"]):
        got = [r.doc_id for r in search.best_of_index(index, terms, 5).collect()]
        assert got == [d for d, _ in full(index, terms, 5)]


def test_best_in_one_field(spark, data, tmp_path):
    _, df, _ = data
    index = TextIndex(spark, str(tmp_path), "id", FIELDS)
    index.add_missing(df)
    for kwargs in ({"field": "title"}, {"weights": {"title": 5.0, "selftext": 0.5}}, {}):
        got = [r.doc_id for r in search.best_of_index(index, ["alpha", "beta"], 6, require_all=False, **kwargs).collect()]
        assert got == [d for d, _ in full(index, ["alpha", "beta"], 6, require_all=False, **kwargs)]
    with pytest.raises(ValueError):
        search.best_of_index(index, ["alph*"], 3)


def small_files(index):
    return len(glob.glob(f"{index.path}/**/*.parquet", recursive=True))


def terms_of(index):
    return sorted(map(tuple, index.postings().select("term", "doc_id", "pos").collect()))


def test_small_batches_are_merged(spark, tmp_path):
    df = many_terms(spark, 170).cache()
    index = TextIndex(spark, str(tmp_path), "id", ("body",))
    for n in range(17):
        index.add_missing(df.where(f"id < {10 * n + 10}"))
        assert index.docs().count() == 10 * n + 10
    # Three batches of a size at most, and what the last merge has replaced.
    assert len(index.batches()) <= 6
    assert small_files(index) < 17 * 3
    assert terms_of(index) == sorted(map(tuple, postings_of(df, "id", ("body",)).select("term", "doc_id", "pos").collect()))
    assert index.corpus() == (170, postings_of(df, "id", ("body",)).count())
    # Removal and replacement hold through later merges.
    index.remove(df.where("id < 20").select("id"))
    index.replace(df.where("id between 20 and 29").withColumn("body", F.lit("fresh words")))
    for n in range(9):
        index.add_missing(df.where(f"id between {n * 2} and {n * 2 + 1}"))
    kept = df.where("id < 18 or id >= 30").unionByName(
        df.where("id between 20 and 29").withColumn("body", F.lit("fresh words")))
    assert terms_of(index) == sorted(map(tuple, postings_of(kept, "id", ("body",)).select("term", "doc_id", "pos").collect()))


@pytest.mark.parametrize("at", ["_write_bounds", "_write_docs", "_write_facts", "_write_entries"])
def test_crash_within_a_merge_changes_nothing(spark, tmp_path, monkeypatch, at):
    monkeypatch.setattr(text_index, "BOUNDED_DOCS", 4)
    df = many_terms(spark, 8).cache()
    index = TextIndex(spark, str(tmp_path), "id", ("body",))
    for n in range(3):
        index.add_missing(df.where(f"id < {2 * n + 2}"))
    calls = []
    whole = getattr(TextIndex, at)

    def crash(self, *args):
        calls.append(1)
        if len(calls) == (1 if at == "_write_bounds" else 2):
            raise RuntimeError("lost")
        return whole(self, *args)

    monkeypatch.setattr(TextIndex, at, crash)
    with pytest.raises(RuntimeError):
        index.add_missing(df)
    monkeypatch.setattr(TextIndex, at, whole)
    fresh = TextIndex(spark, str(tmp_path), "id", ("body",))
    want = sorted(map(tuple, postings_of(df, "id", ("body",)).select("term", "doc_id", "pos").collect()))
    assert terms_of(fresh) == want and fresh.corpus()[0] == 8
    fresh.add_missing(df.limit(0).unionByName(spark.createDataFrame([(99, "later")], df.schema)))
    assert terms_of(fresh) == sorted(want + [("later", 99, 0)])


def test_documents_are_grouped_many_at_a_time(spark):
    """In slices of bounded size, and not by functions that Spark interprets per element."""
    import pyarrow as pa

    from siltstone.operators import grouping

    df = spark.createDataFrame([(None, "b a b", "a"), (7, "", None), (3, "a c", "c a a")], "id long, x string, y string")
    entries = entries_of(df, "id", ("x", "y"), with_docs=True)
    assert "lambda" not in entries._jdf.queryExecution().executedPlan().toString()
    got = [(r.doc_id, r.term, r.field, r.first, r.tf, list(r.positions), r.doc_len) for r in entries.collect()]
    assert sorted(got, key=str) == sorted([
        (None, "a", "x", True, 1, [1], 4), (None, "a", "y", False, 1, [0], 4), (None, "b", "x", True, 2, [0, 2], 4),
        (3, "a", "x", True, 1, [0], 5), (3, "a", "y", False, 2, [1, 2], 5),
        (3, "c", "x", True, 1, [1], 5), (3, "c", "y", False, 1, [0], 5),
        (None, None, None, False, 0, [], 4), (7, None, None, False, 0, [], 0), (3, None, None, False, 0, [], 5),
    ], key=str)

    words = pa.array([["w"] * n for n in (3, 0, 900, 2, 500, 600)], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(6), pa.int64()), pa.array([3, 0, 900, 2, 500, 600], pa.int32()), words],
        names=["doc_id", "doc_len", "_t_0"],
    )
    before, grouping.SLICE_TOKENS = grouping.SLICE_TOKENS, 1000
    try:
        assert [s.num_rows for s in grouping.slices(batch)] == [4, 1, 1]
        out = [r for b in grouping.grouper(("x",), False)(iter([batch])) for r in b.to_pylist()]
    finally:
        grouping.SLICE_TOKENS = before
    assert [(r["doc_id"], r["tf"], r["positions"][-1]) for r in out] == [(0, 3, 2), (2, 900, 899), (3, 2, 1), (4, 500, 499), (5, 600, 599)]


def test_postings_travel_packed(spark):
    """In runs of a bucket, with all they hold, and in a fraction of the bytes."""
    from siltstone.operators import grouping

    rows = [(i, " ".join(f"w{(i * k) % 211}" for k in range(1, 120)), f"t{i % 3} é {i}") for i in range(300)]
    rows += [(None, "b a b", "a"), (7, "", None), (7, "a w1", "w1")]
    df = spark.createDataFrame(rows, "id long, x string, y string").coalesce(2)
    entries = entries_of(df, "id", ("x", "y"), with_docs=True)
    plain = sorted(map(str, entries.collect()))
    buckets = F.coalesce(text_index.term_bucket(F.col("term"), 16), F.lit(grouping.DOC_BUCKET))
    for runs in (text_index.packed_rows(df, "id", ("x", "y"), 16), text_index.packed_entries(entries, 16)):
        out = runs.mapInArrow(grouping.unpacked, grouping.ENTRY_DDL + ", term_bucket int").cache()
        assert sorted(map(str, out.select(*entries.columns).collect())) == plain
        assert out.where(F.col("term_bucket") != buckets).isEmpty()
        # A run holds a term's postings together; two tasks make two runs a bucket at most.
        assert runs.groupBy("term_bucket").count().where("count > 2").isEmpty()
        assert runs.agg(F.sum(F.length("packed"))).first()[0] < 10 * len(plain)


def test_runs_hold_a_bounded_number_of_tokens(spark, monkeypatch):
    import pyarrow as pa

    from siltstone.operators import grouping

    def batch(start):
        return pa.RecordBatch.from_pylist([
            {"term": t, "field": "x", "doc_id": d, "first": True, "tf": 5, "positions": [0] * 5, "doc_len": 10}
            for d in range(start, start + 10) for t in ("a", "b")
        ], grouping.ENTRY_SCHEMA)

    monkeypatch.setattr(grouping, "SLICE_TOKENS", 200)
    sealed = list(grouping.packer(1)(batch(10 * n) for n in range(5)))
    assert [b.num_rows for b in sealed] == [1, 1, 1]
    rows = [[(r["term"], r["doc_id"]) for b in grouping.unpacked([s]) for r in b.to_pylist()] for s in sealed]
    assert [len(r) for r in rows] == [40, 40, 20] and all(r == sorted(r) for r in rows)
    assert list(grouping.packer(4)(iter([]))) == []


def test_advised_partition_size_comes_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b")], "id long, body string")
    before = spark.conf.get(text_index.ADVISORY_SETTING, None)
    TextIndex(spark, str(tmp_path), "id", ("body",)).add_missing(df)
    assert spark.conf.get(text_index.ADVISORY_SETTING, None) == before
    spark.conf.set(text_index.ADVISORY_SETTING, "1m")
    try:
        with pytest.raises(ValueError), text_index.packed_partitions(spark):
            assert spark.conf.get(text_index.ADVISORY_SETTING) == str(1 << 18)
            raise ValueError
        assert spark.conf.get(text_index.ADVISORY_SETTING) == "1m"
    finally:
        spark.conf.unset(text_index.ADVISORY_SETTING)
        if before is not None:
            spark.conf.set(text_index.ADVISORY_SETTING, before)


def test_rare_terms_go_before_bounds_are_shuffled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text_index, "BOUNDED_DOCS", 8)
    df = spark.createDataFrame(
        [(i, f"often once{i} " + "pair " * (i % 4 == 0)) for i in range(24)], "id long, body string")
    index = TextIndex(spark, str(tmp_path), "id", ("body",))
    plans = []
    whole = TextIndex._write_bounds

    def kept(self, bounds, path):
        plans.append(bounds._jdf.queryExecution().executedPlan().toString())
        whole(self, bounds, path)

    monkeypatch.setattr(TextIndex, "_write_bounds", kept)
    index.add_missing(df)
    (plan,) = plans
    # The join is below the only exchange of postings, and moves none itself.
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    assert plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin")
    assert {r.term for r in spark.read.parquet(f"{tmp_path}/bounds/batch=0").collect()} == {"often"}


def test_shuffled_postings_do_not_outlive_their_step(spark, tmp_path, monkeypatch):
    import os
    import time

    folders = [f.getPath() for f in spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()]

    def shuffles():
        return {f.split("_")[1] for d in folders for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}

    df = many_terms(spark, 40).repartition(4).cache()
    df.count()
    before, left = shuffles(), []
    write_docs = TextIndex._write_docs

    def look(*args):
        until = time.time() + 20
        while len(new := shuffles() - before) > 1 and time.time() < until:
            time.sleep(0.2)
        left.append(len(new))
        write_docs(*args)

    monkeypatch.setattr(text_index, "DROPPED_DOCS", 1)
    monkeypatch.setattr(TextIndex, "_write_docs", look)
    TextIndex(spark, str(tmp_path), "id", ("body",)).add_missing(df)
    # That of the dictionary may be left.
    assert len(left) == 1 and left[0] <= 1
