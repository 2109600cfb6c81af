"""Tables: the ledger's ids and times, changes that break off, rounds of a stream."""

import lzma
import os
import random
import re
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from records import COMMENT as RECORD
from siltstone.operators import ledger as ledgers
from siltstone.operators import store
from siltstone.operators.filters import FilterSpec
from siltstone.operators.ledger import Ledger, Span
from siltstone.plans import ingest as jobs
from siltstone.schema import COMMENT
from siltstone.sources import archives
from siltstone.streaming.incremental import start_ingest
from test_blocks import cut_at, xz_of

R = 2**28


def rows(spark, ids, body="x", created=None):
    """Comment rows with these ids; the time is the id's last digits unless given."""
    frame = spark.createDataFrame([(i, created if created is not None else i % 1000) for i in ids], "i long, t long")
    values = {"decoded_reddit_id": "i", "created_utc": "t", "body": f"'{body}'", "reddit_id": "cast(i AS string)"}
    columns = [
        f"cast({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in COMMENT.schema.fields
    ]
    return frame.selectExpr(*columns)


def insert(spark, path, frame, spans=True):
    found = store.touched_spans(frame, COMMENT.key) if spans else None
    return store.append(spark, frame, path, COMMENT, ["body"], found)


def ids_in(spark, path):
    return sorted(r[0] for r in store.read_table(spark, path, COMMENT).select(COMMENT.key).collect())


ODD = [-5, -1, 0, 1, 2, 32767, 32768, 32769, 65536, R - 1, R, R + 1, 3 * R, 2**40 + 7, 2**62, -(2**62)]


def test_bitmaps_hold_exactly_the_ids(spark):
    rng = random.Random(1)
    ids = set(ODD) | {rng.randrange(0, 4 * R) for _ in range(500)}
    near = {i + d for i in ids for d in (-32768, -1, 1, 8, 32768)} | ids
    frame = lambda some: rows(spark, some).withColumn("id_range", store.id_range(F.col(COMMENT.key)))
    left = ledgers.absent(frame(near), ledgers.bitmaps(frame(ids), COMMENT.key), COMMENT.key)
    assert {r[0] for r in left.select(COMMENT.key).collect()} == near - ids


def test_inserts_against_a_set(spark, tmp_path):
    rng = random.Random(2)
    path, held = str(tmp_path / "t"), set()
    for n in range(4):
        batch = [rng.choice(ODD) for _ in range(5)] + [rng.randrange(0, 3000) for _ in range(400)]
        assert insert(spark, path, rows(spark, batch), spans=n != 2) == len(set(batch) - held)
        held |= set(batch)
        assert ids_in(spark, path) == sorted(held)


def test_second_insert_reads_no_row(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    frame = rows(spark, range(1000)).cache()
    assert insert(spark, path, frame) == 1000
    monkeypatch.setattr(store, "_data", lambda *a: pytest.fail("read the table"))
    assert insert(spark, path, frame.unionByName(rows(spark, [5000]))) == 1
    monkeypatch.undo()
    assert len(ids_in(spark, path)) == 1001


def test_writer_that_fell_before_the_ledger(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    insert(spark, path, rows(spark, [1, 2, R + 1]))
    whole = Ledger.record
    monkeypatch.setattr(Ledger, "record", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        insert(spark, path, rows(spark, [2, 3], created=77_777))
    monkeypatch.setattr(Ledger, "record", whole)
    # The rows are there; what the entry says of their range is not believed.
    assert ids_in(spark, path) == [1, 2, 3, R + 1]
    assert set(Ledger(spark, path).believed([0, 1])) == {1}
    assert [r[0] for r in store.read_between(spark, path, COMMENT, 70_000).select(COMMENT.key).collect()] == [3]
    assert insert(spark, path, rows(spark, [3, 4])) == 1
    assert set(Ledger(spark, path).believed([0, 1])) == {0, 1}
    assert insert(spark, path, rows(spark, [1, 2, 3, 4, R + 1])) == 0


def test_foreign_files_are_not_hidden(spark, tmp_path):
    path = str(tmp_path / "t")
    insert(spark, path, rows(spark, [1, 2, R + 1]))
    strange = rows(spark, [9], created=5_000_000).withColumn("id_range", F.lit(0))
    strange.write.mode("append").partitionBy("id_range").parquet(path)
    found = store.read_between(spark, path, COMMENT, 4_000_000)
    assert [r[0] for r in found.select(COMMENT.key).collect()] == [9]
    assert insert(spark, path, rows(spark, [9, 10])) == 1


def test_deletes_clear_bits_and_times(spark, tmp_path):
    path = str(tmp_path / "t")
    insert(spark, path, rows(spark, [1, 2, 3, R + 1, R + 2]))
    assert store.delete(spark, path, COMMENT, spark.createDataFrame([(2,), (R + 1,), (R + 2,), (77,)], "i long")) == 3
    assert ids_in(spark, path) == [1, 3]
    assert set(Ledger(spark, path).believed(range(3))) == {0}
    assert insert(spark, path, rows(spark, [2, 3, R + 2])) == 2
    assert ids_in(spark, path) == [1, 2, 3, R + 2]
    changed = rows(spark, [2, 3, 50], body="new", created=900_000)
    store.update(spark, path, COMMENT, changed, str(tmp_path / "changed"))
    late = store.read_between(spark, path, COMMENT, 800_000)
    assert sorted(tuple(r) for r in late.select(COMMENT.key, "body").collect()) == [(2, "new"), (3, "new")]
    assert not os.listdir(tmp_path / "t/_staged") and not os.listdir(tmp_path / "t/_commit")


def test_time_bounds_skip_ranges(spark, tmp_path):
    path = str(tmp_path / "comment")
    for n in range(4):
        insert(spark, path, rows(spark, [n * R + 1, n * R + 2], created=1000 * n))
    found = store.read_between(spark, path, COMMENT, 900, 1100)
    assert [r[0] for r in found.select(COMMENT.key).collect()] == [R + 1, R + 2]
    assert len(found.inputFiles()) > 0
    files = {r[0] for r in found.select("_metadata.file_path").distinct().collect()}
    assert len(files) == 1 and "id_range=1" in files.pop()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*id_range#?\d* = 1", plan)
    spec = FilterSpec(min_datetime=1500, max_datetime=2500)
    kept = jobs.read_filtered(spark, str(tmp_path), COMMENT, spec)
    assert {r["id_range"] for r in kept.select("id_range").collect()} == {2}
    assert store.read_between(spark, path, COMMENT).count() == 8
    assert store.read_between(spark, path, COMMENT, 10_000).count() == 0


def test_spans():
    assert Span(1, 5).joined(Span(None, None)) == Span(1, 5)
    assert Span(1, 5).joined(Span(-2, 3)) == Span(-2, 5)
    assert Span(1, 5).overlaps(5, None) and Span(1, 5).overlaps(None, 1) and not Span(1, 5).overlaps(6, 9)
    assert not Span(None, None).overlaps(None, 3)


@pytest.mark.parametrize("harm", ["nothing yet", "range gone", "half"])
def test_commit_that_breaks_loses_no_row(spark, tmp_path, monkeypatch, harm):
    path = str(tmp_path / "t")
    insert(spark, path, rows(spark, [1, 2, 3, R + 1, R + 2, 2 * R]))
    whole = store._replace

    def broken(spark, path, entity, token):
        if harm == "range gone":  # as a dynamic overwrite that fell after deleting
            shutil.rmtree(f"{path}/id_range=0")
        if harm == "half":
            shutil.rmtree(f"{path}/id_range=0")
            shutil.copytree(f"{path}/_staged/{token}/id_range=0", f"{path}/id_range=0")
        raise RuntimeError("lost")

    monkeypatch.setattr(store, "_replace", broken)
    with pytest.raises(RuntimeError):
        store.delete(spark, path, COMMENT, spark.createDataFrame([(2,), (R + 1,), (R + 2,)], "i long"))
    monkeypatch.setattr(store, "_replace", whole)
    # From the moment it counts, readers see the change, whole.
    assert ids_in(spark, path) == [1, 3, 2 * R]
    assert store.read_between(spark, path, COMMENT, 0).count() == 3
    assert insert(spark, path, rows(spark, [2, 3])) == 1
    assert ids_in(spark, path) == [1, 2, 3, 2 * R]
    assert not (tmp_path / "t/_commit").exists() or not os.listdir(tmp_path / "t/_commit")


def test_change_that_never_counted_is_forgotten(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    insert(spark, path, rows(spark, [1, 2, 3]))
    monkeypatch.setattr(store, "touch_path", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.delete(spark, path, COMMENT, spark.createDataFrame([(2,)], "i long"))
    monkeypatch.undo()
    assert ids_in(spark, path) == [1, 2, 3]
    assert store.delete(spark, path, COMMENT, spark.createDataFrame([(3,)], "i long")) == 1
    assert ids_in(spark, path) == [1, 2]


RETRY = """
import sys
sys.path[:0] = [{repo!r}, {tests!r}]
from pyspark import TaskContext
from pyspark.sql import SparkSession
from siltstone.plans import ingest as jobs
from siltstone.schema import COMMENT
from records import COMMENT as RECORD
import json
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {work!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
lines = [json.dumps(dict(RECORD, id=f"c{{i}}")) for i in range(300)] + ["junk"] * 30

def flaky(batches):
    context = TaskContext.get()
    for n, batch in enumerate(batches):
        yield batch
    if context.attemptNumber() == 0:
        raise RuntimeError("first attempt, after all its rows")

df = spark.createDataFrame([("f", x, None) for x in lines], "file_path string, value string, error string")
df = df.repartition(4).mapInArrow(flaky, df.schema)
print("COUNTS", jobs.ingest_lines(spark, df, {out!r}, COMMENT))
"""


def test_retried_tasks_do_not_change_the_counts(tmp_path):
    here = os.path.dirname(os.path.abspath(__file__))
    code = RETRY.format(repo=os.path.dirname(here), tests=here, work=str(tmp_path / "w"), out=str(tmp_path / "o"))
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "COUNTS IngestCounts(lines=330, rejected=30, filtered=0, kept=300, stored=300)" in run.stdout, run.stderr[-2000:]


def comment_lines(n):
    import json

    return [json.dumps(dict(RECORD, id=f"c{i:04d}", body=os.urandom(60).hex())) for i in range(n)] + ["junk"]


def test_stream_takes_a_large_file_in_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "PART_BYTES", 4000)
    text = "\n".join(comment_lines(400)).encode()
    cuts = random.Random(7).sample(range(1, len(text)), 11)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/big.xz").write_bytes(xz_of(cut_at(text, cuts)))
    (tmp_path / "in/small.xz").write_bytes(lzma.compress("\n".join(comment_lines(3)).encode()))
    out, seen, lost = str(tmp_path / "out"), [], [2]
    whole = jobs.ingest_lines

    def counted(*args, **kwargs):
        if len(seen) == lost[0]:
            lost[0] = -1
            raise RuntimeError("lost")
        counts = whole(*args, **kwargs)
        seen.append(counts)
        return counts

    import siltstone.streaming.incremental as incremental

    monkeypatch.setattr(incremental, "ingest_lines", counted)

    def go():
        start_ingest(
            spark, str(tmp_path / "in"), out, COMMENT, str(tmp_path / "cp"), max_bytes_per_round=8000,
        ).awaitTermination()

    with pytest.raises(Exception):
        go()
    assert len(seen) == 2
    go()
    # Each line was counted once, over both runs.
    assert sum(c.lines for c in seen) == 405 and sum(c.rejected for c in seen) == 2 and len(seen) > 3
    assert store.read_table(spark, f"{out}/comment", COMMENT).count() == 400
    assert jobs.read_rejects(spark, out).count() == 2
    go()
    assert store.read_table(spark, f"{out}/comment", COMMENT).count() == 400
