import hashlib

from llm_cases import DOCUMENTS, bag, documents, frame

from siltstone.llm import exact_dedup as dedup


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r[1] or "").encode().lower(), []).append(r[0])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text).hexdigest()) for i in ids]
    return out


def test_against_brute_force(spark):
    got = dedup.exact_groups(frame(spark), capacity=10).collect()
    assert bag(tuple(r) for r in got) == bag(expected(documents()))


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert dedup.exact_groups(empty).count() == 0 and dedup.keep_one(empty).count() == 0


def test_keep_one_row_of_each_text(spark):
    kept = dedup.keep_one(frame(spark)).collect()
    assert len({(r["text"] or "").encode().lower() for r in kept}) == len(kept)
    assert bag((r["doc_id"]) for r in kept) == bag(
        {(k, s): k for i, k, n, kept_, s in expected(documents())}.values()
    )
    assert kept[0].asDict().keys() == frame(spark).first().asDict().keys()


def test_directory_doubles_and_splits():
    cells = {0: 30, 1: 30, 1 << 15: 5}
    directory = dedup.Directory(cells, 40)
    # Cells 0 and 1 differ in their last bit only.
    assert directory.depth == dedup.CELL_BITS
    numbers = dict(directory.bucket_of_cells())
    assert numbers[0] != numbers[1] and numbers[1 << 15] == numbers[(1 << 16) - 1]
    assert sorted(set(numbers.values())) == list(range(len(set(numbers.values()))))
    assert list(numbers) == sorted(numbers) and list(numbers.values()) == sorted(numbers.values())
    assert dedup.Directory({5: 100}, 1).depth == dedup.CELL_BITS  # one cell cannot be split
    assert dedup.Directory({}, 1).depth == 0


def test_owners_share_the_keys():
    directory = dedup.Directory({c: 10 for c in range(0, 1 << 16, 64)}, 500)
    rows = directory.owners(7)
    assert [r[:2] for r in rows] == directory.bucket_of_cells()
    keys = {}
    for cell, _, owner in rows:
        keys[owner] = keys.get(owner, 0) + directory.cells.get(cell, 0)
    assert sorted(keys) == list(range(7)) and max(keys.values()) <= -(-10240 // 7) + 10
    assert [o for _, _, o in rows] == sorted(o for _, _, o in rows)
    assert {o for _, _, o in dedup.Directory({}, 5).owners(3)} == {0}


def test_directory_of_more_bits(spark, monkeypatch):
    monkeypatch.setattr(dedup, "CELL_BITS", 2)
    keys = spark.range(9000).selectExpr("xxhash64(id) AS key")
    directory = dedup.directory_of(keys, 100)
    assert directory.bits == 7 and sum(directory.cells.values()) == 9000
    assert max(b.keys for b in directory.slots) <= 150


def test_texts_are_read_once(spark, tmp_path):
    df = frame(spark)
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    texts = dedup.combined(df.select("doc_id", "text").mapInArrow(count, "doc_id long, text string"))
    dedup.ExtendibleIndex(spark, str(tmp_path / "index"), 5).add(texts, dedup.digests(df))
    assert read.value == df.count()


def test_collisions_are_chained(spark, monkeypatch):
    import pyarrow as pa

    rows = [(1, 7, b"s1", 3, 1, b"one"), (1, 7, b"s1", 9, 2, b"one"), (1, 7, b"s2", 4, 1, b"two"), (1, 8, b"s3", None, 1, b"")]
    names = ["bucket", "key", "sha", "keep", "size", "body"]
    batch = pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))
    out = [r for b in dedup._own(False)(iter([batch])) for r in b.to_pylist()]
    assert [(r["key"], r["chain"], r["keep"], r["size"]) for r in out] == [(7, 0, 9, 3), (7, 1, 4, 1), (8, 0, None, 1)]


def test_index_grows(spark, tmp_path):
    rows = documents()
    index = dedup.ExtendibleIndex(spark, str(tmp_path / "index"), capacity=5)
    for part in (rows[:50], rows[50:]):
        docs = frame(spark, part)
        entries = index.add(dedup.combined(docs), dedup.digests(docs))
    got = {(r["keep"], r["size"], bytes(r["sha"]).hex()) for r in entries.collect()}
    assert got == {(k, n, s) for _, k, n, _, s in expected(rows)}
