import gzip
import lzma
import random

import pytest
from pyspark.sql import functions as F

from records import comment, frame, submission
from siltstone import FilterSpec, ingest
from siltstone.operators import store, text_search
from siltstone.operators.text_index import TextIndex
from siltstone.plans import ingest as jobs
from siltstone.schema import COMMENT, SUBMISSION
from siltstone.streaming.incremental import start_ingest

B36 = "0123456789abcdefghijklmnopqrstuvwxyz"


def base36(n):
    return (base36(n // 36) if n >= 36 else "") + B36[n % 36]


def stored(spark, out, entity=COMMENT):
    return store.read_table(spark, jobs.table_path(str(out), entity), entity)


def test_counts_add_up_and_a_second_run_adds_nothing(spark, tmp_path):
    lines = [comment(id=base36(10**9 + i), score=i) for i in range(50)]
    lines += lines[:5] + ["garbage", comment(id="bad!"), comment(id="bad!", score=-1)]
    spec = FilterSpec(min_score=0, max_score=39)
    first = jobs.ingest_lines(spark, frame(spark, lines), str(tmp_path), COMMENT, spec)
    assert first == jobs.IngestCounts(lines=58, rejected=2, filtered=11, kept=45, stored=40)
    second = jobs.ingest_lines(spark, frame(spark, lines), str(tmp_path), COMMENT, spec)
    assert second == jobs.IngestCounts(lines=58, rejected=2, filtered=11, kept=45, stored=0)
    assert stored(spark, tmp_path).count() == 40
    reasons = [r["reason"] for r in jobs.read_rejects(spark, str(tmp_path)).collect()]
    assert sorted(reasons) == ["invalid id"] * 2 + ["malformed json"] * 2


def test_existing_rows_win_and_keys_are_decoded_ids(spark, tmp_path):
    jobs.ingest_lines(spark, frame(spark, [comment(id="kod", body="old")]), str(tmp_path), COMMENT)
    again = [comment(id=i, body="new") for i in ("KOD", "0kod", "kod", "koe")]
    counts = jobs.ingest_lines(spark, frame(spark, again), str(tmp_path), COMMENT)
    assert counts.stored == 1
    rows = {r["reddit_id"]: r["body"] for r in stored(spark, tmp_path).collect()}
    assert rows == {"kod": "old", "koe": "new"}


def test_which_duplicate_survives_does_not_depend_on_order(spark, tmp_path):
    lines = [(f"f{i % 3}", comment(id="kod", body=f"b{i}"), None) for i in range(30)]
    kept = set()
    for n in range(3):
        random.Random(n).shuffle(lines)
        df = spark.createDataFrame(lines, "file_path string, value string, error string")
        out = str(tmp_path / str(n))
        jobs.ingest_lines(spark, df.repartition(n + 1), out, COMMENT)
        kept |= {r["body"] for r in stored(spark, out).collect()}
    assert len(kept) == 1


def test_bad_ids_can_stop_the_job_but_only_kept_ones(spark, tmp_path):
    lines = frame(spark, [comment(id="bad!", score=1)])
    keep_out = FilterSpec(min_score=2)
    counts = jobs.ingest_lines(spark, lines, str(tmp_path), COMMENT, keep_out, on_bad_id="fail")
    assert counts.filtered == 1
    with pytest.raises(Exception, match="invalid id"):
        jobs.ingest_lines(spark, lines, str(tmp_path), COMMENT, on_bad_id="fail")
    assert stored(spark, tmp_path).count() == 0


def test_lookup_prunes_to_one_partition(spark, tmp_path):
    ids = [5, 2**28 + 1, 3 * 2**28, 2**62]
    lines = frame(spark, [comment(id=base36(i), body=str(i)) for i in ids])
    jobs.ingest_lines(spark, lines, str(tmp_path), COMMENT)
    table = stored(spark, tmp_path)
    assert {r["id_range"] for r in table.collect()} == {0, 1, 3, store.LAST_RANGE}
    for i in ids:
        found = store.lookup(table, i)
        assert [r["body"] for r in found.collect()] == [str(i)]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(id_range" in plan
        assert "EqualTo(decoded_reddit_id" in plan
    assert store.lookup(table, 6).count() == 0


def test_prefiltered_ingest_stores_the_same_rows(spark, tmp_path):
    lines = [comment(id=base36(100 + i), author=a) for i, a in enumerate(["ann", "bob", "cy"] * 5)]
    lines.append(comment(id="zz").replace('"ann"', '"\\u0061nn"'))
    spec = FilterSpec(users={"ann"})
    for name, report in (("a", True), ("b", False)):
        jobs.ingest_lines(spark, frame(spark, lines), str(tmp_path / name), COMMENT, spec,
                          report_rejects=report)
    both = [sorted(map(str, stored(spark, tmp_path / n).collect())) for n in "ab"]
    assert both[0] == both[1] and len(both[0]) == 6


def test_quiet_mode_keeps_file_errors(spark, tmp_path):
    folder = tmp_path / "in"
    write_archives(folder, "a.gz", [comment(id="c1"), "junk"], gzip.compress)
    (folder / "b.gz").write_text("no archive")
    (folder / "notes.txt").write_text("x")
    for name, report in (("loud", True), ("quiet", False)):
        counts = ingest(spark, str(tmp_path / name), str(folder), report_rejects=report)["comment"]
        assert counts.lines == 4 and counts.stored == 1
        assert (counts.rejected, counts.filtered) == ((3, 0) if report else (2, 1))
        files = {r["file_path"].rpartition("/")[2] for r in jobs.read_rejects(spark, str(tmp_path / name)).collect()}
        assert files == ({"a.gz"} if report else set()) | {"b.gz", "notes.txt"}


def test_totals_do_not_depend_on_the_number_of_names(spark, tmp_path):
    lines = frame(spark, [comment(id=base36(100 + i), author=f"u{i:02d}") for i in range(60)] + ["junk", "u01 junk"])
    seen = set()
    for n in (1, 50, 51, 1500):
        spec = FilterSpec(users={f"u{i:02d}" for i in range(n)})
        counts = jobs.ingest_lines(spark, lines, str(tmp_path / str(n)), COMMENT, spec, report_rejects=False)
        assert counts.kept == min(n, 60)
        seen.add((counts.lines, counts.rejected, counts.kept + counts.filtered))
    assert seen == {(62, 0, 62)}


def test_streams_keep_each_others_rejects(spark, tmp_path):
    out = str(tmp_path / "out")
    for n in ("one", "two"):
        folder = tmp_path / n
        write_archives(folder, "a.gz", [f"junk {n}"], gzip.compress)
        write_archives(folder, "_hidden.gz", [comment()], gzip.compress)
        (folder / "notes.txt").write_text("x")
        for _ in range(2):
            start_ingest(spark, str(folder), out, COMMENT, str(tmp_path / f"cp-{n}")).awaitTermination()
    rows = jobs.read_rejects(spark, out).collect()
    assert sorted(r["line"] for r in rows if r["line"]) == ["junk one", "junk two"]
    assert sorted(r["reason"] for r in rows if not r["line"]) == ["hidden name"] * 2 + ["unknown file extension"] * 2


def test_long_name_lists_in_the_job(spark, tmp_path):
    lines = [comment(id=base36(100 + i), author=f"u{i}") for i in range(10)]
    spec = FilterSpec(users={f"u{i}" for i in range(5, 2000)})
    counts = jobs.ingest_lines(spark, frame(spark, lines), str(tmp_path), COMMENT, spec)
    assert (counts.kept, counts.filtered, counts.stored) == (5, 5, 5)


def test_copies_of_one_key_are_cut_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS k", "id AS o")
    plan = store.keep_first(rows, "k", ["o"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(k")
    assert "WindowGroupLimit" in plan[exchange:]


def write_archives(folder, name, lines, pack):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(pack("\n".join(lines).encode()))


def test_whole_job_with_views_and_index(spark, tmp_path):
    c, s, out = tmp_path / "c", tmp_path / "s", str(tmp_path / "out")
    write_archives(c, "a.gz", [comment(id="c1", body="A heron appears"), "junk"], gzip.compress)
    write_archives(c, "b.xz", [comment(id="c2", body="nothing", parent_id="t1_c1")], lzma.compress)
    write_archives(s, "a.xz", [submission(id="s1", title="Heron!", selftext="x")], lzma.compress)
    (c / "notes.txt").write_text("skip me")
    counts = ingest(spark, out, str(c), str(s), build_index=True, index_buckets=4)
    assert (counts["comment"].stored, counts["comment"].rejected) == (2, 2)
    assert counts["submission"].stored == 1
    assert jobs.register_views(spark, out) == ["comment", "submission"]
    rows = spark.sql("SELECT reddit_id, replies_to_submission r FROM comment").collect()
    assert {(r["reddit_id"], r["r"]) for r in rows} == {("c1", True), ("c2", False)}
    for entity, expected in ((COMMENT, "c1"), (SUBMISSION, "s1")):
        index = TextIndex(spark, jobs.index_path(out, entity), entity.key, entity.text_fields)
        docs = text_search.term_docs(index.postings(), "heron")
        found = text_search.rows_of(stored(spark, out, entity), docs, entity.key)
        assert [r["reddit_id"] for r in found.collect()] == [expected]


def test_inputs_are_checked_before_any_work(spark, tmp_path):
    write_archives(tmp_path / "c", "a.gz", [comment()], gzip.compress)
    with pytest.raises(ValueError):
        ingest(spark, str(tmp_path / "out"), str(tmp_path / "c"), str(tmp_path / "missing"))
    assert not (tmp_path / "out").exists()


def test_index_turned_on_later_covers_older_rows(spark, tmp_path):
    out = str(tmp_path)
    jobs.ingest_lines(spark, frame(spark, [comment(id="c1")]), out, COMMENT)
    jobs.ingest_lines(spark, frame(spark, [comment(id="c2")]), out, COMMENT, build_index=True, index_buckets=4)
    jobs.ingest_lines(spark, frame(spark, [comment(id="c3")]), out, COMMENT, build_index=True, index_buckets=4)
    index = TextIndex(spark, jobs.index_path(out, COMMENT), COMMENT.key, ("body",))
    assert text_search.term_docs(index.postings(), "text").count() == 3
    assert index.postings().where("term = 'text'").count() == 3


def test_deletes_and_updates_are_followed_and_last(spark, tmp_path):
    out = str(tmp_path)
    ids = [7, 2**28 + 1, 2**28 + 2, 2**62]
    lines = [comment(id=base36(i), body=f"word{n}") for n, i in enumerate(ids)]
    jobs.ingest_lines(spark, frame(spark, lines), out, COMMENT, build_index=True, index_buckets=4)
    gone = spark.createDataFrame([(ids[0],), (ids[1],), (99,)], "id bigint")
    assert jobs.delete_stored(spark, out, COMMENT, gone) == 2
    row = stored(spark, out).where(F.col(COMMENT.key) == ids[2])
    changed = row.withColumn("body", F.lit("changed")).drop("id_range")
    twice = changed.union(changed.withColumn(COMMENT.key, F.lit(12345).cast("bigint")))
    assert jobs.update_stored(spark, out, COMMENT, twice.union(changed)) == 1
    jobs.ingest_lines(spark, frame(spark, [comment(id="zz", body="later")]), out, COMMENT, build_index=True)

    def terms():
        index = TextIndex(spark, jobs.index_path(out, COMMENT), COMMENT.key, ("body",))
        return sorted(r["term"] for r in index.postings().collect())

    assert terms() == ["changed", "later", "word3"]
    assert sorted(r["body"] for r in stored(spark, out).collect()) == ["changed", "later", "word3"]
    # A job that does not build the index leaves it behind; the next one catches up.
    jobs.ingest_lines(spark, frame(spark, [comment(id="zy", body="unseen")]), out, COMMENT)
    assert terms() == ["changed", "later", "word3"]
    jobs.ingest_lines(spark, frame(spark, [comment(id="zx", body="last")]), out, COMMENT, build_index=True)
    assert terms() == ["changed", "last", "later", "unseen", "word3"]


def test_stream_takes_new_files_once(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    seen = []

    def run():
        start_ingest(
            spark, str(folder), out, COMMENT, checkpoint, build_index=True, index_buckets=4,
            on_batch=lambda n, counts: seen.append(counts),
        ).awaitTermination()

    write_archives(folder, "a.gz", [comment(id="c1"), comment(id="c2"), "junk"], gzip.compress)
    write_archives(folder, "b.xz", [comment(id="c2"), comment(id="c3")], lzma.compress)
    run()
    assert stored(spark, out).count() == 3
    run()
    batches = len(seen)
    write_archives(folder, "c.bz2", [comment(id="c4")], __import__("bz2").compress)
    import os

    os.utime(folder / "c.bz2", (10**9, 10**9))  # an old file arriving late
    run()
    assert len(seen) == batches + 1
    assert sorted(r["reddit_id"] for r in stored(spark, out).collect()) == ["c1", "c2", "c3", "c4"]
    index = TextIndex(spark, jobs.index_path(out, COMMENT), COMMENT.key, ("body",))
    assert index.docs().count() == 4
    assert index.postings().groupBy("doc_id").agg(F.count("*")).count() == 4
    assert jobs.read_rejects(spark, out).count() == 1
