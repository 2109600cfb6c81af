import base64
import gzip
import hashlib
import io
import random

import pytest

from siltstone.llm import warc

SCHEMA = "page_id long, url string, html string"
RNG = random.Random(4)
PAGES = [
    (i, f"http://h{i}.example/ä b\r\n", RNG.choice(["same", "same two", f"<p>{i}</p>" * RNG.randint(1, 900)])) for i in range(80)
] + [
    (100, None, None), (101, "", ""), (102, "http://x", "\x1f\x8b WARC/1.1\r\n\r\n 😀" * 50), (None, "http://n", "same"),
    (None, "http://n", "only without id"), (103, "http://long", "word " * 600_000), (104, "u", "tie"), (104, "u", "tie"),
]


def expected(pages, smallest=0):
    best = {}
    for i, _, h in pages:
        if i is not None:
            best[h or ""] = max(i, best.get(h or "", i))
    out = []
    for i, _, h in pages:
        body = (h or "").encode()
        first = best.get(h or "")
        response = len(body) < smallest or i == first
        out.append((
            i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
            "response" if response or first is None else "revisit", None if response else first,
        ))
    return sorted(map(repr, out))


@pytest.mark.parametrize("smallest", [0, 9])
def test_round_trip(spark, smallest):
    pages = spark.createDataFrame(PAGES, SCHEMA).selectExpr("*", "1 AS payload", "2 AS digest", "3 AS key").repartition(3)
    got = warc.round_trip(pages, smallest=smallest)
    assert sorted(repr(tuple(r)[:5]) for r in got.collect()) == expected(PAGES, smallest)
    assert got.where("digest_ok = false").count() == 0


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def archive(n=200, seed=1):
    rng = random.Random(seed)
    records = [warc.record_bytes(i, "http://x", bytes(rng.randbytes(rng.randint(0, 3000))), None, "2024") for i in range(n)]
    # Payloads that hold whole members, stored as they are, must not be taken for records of the file.
    records[7] = warc.record_bytes(7, "http://x", b"pre" + warc.MAGIC + b"post" + warc.MAGIC * 9, None, "2024")
    members = [gzip.compress(r, mtime=0) for r in records]
    return members


def read_in_ranges(data, step):
    found = []
    for start in range(0, len(data), step):
        reader = warc.MemberReader(io.BytesIO(data), len(data))
        found += [(at, r.headers["warc-record-id"]) for at, r in warc.owned(reader, start, min(len(data), start + step))]
    return found


@pytest.mark.parametrize("step", [1, 2, 100, 1000, 4096, 10**7])
def test_each_record_has_one_owner(step):
    members = archive(20 if step < 100 else 200)
    data = b"".join(members)
    starts = [sum(map(len, members[:i])) for i in range(len(members))]
    assert read_in_ranges(data, step) == [(s, f"<urn:page:{i}>") for i, s in enumerate(starts)]


def test_damage_costs_one_record():
    members = archive(30)
    members[10] = members[10][: len(members[10]) // 2]
    members[20] = b"\x1f\x8b\x08 no member" + members[20][40:]
    found = [name for _, name in read_in_ranges(b"junk" + b"".join(members), 5000)]
    assert found == [f"<urn:page:{i}>" for i in range(30) if i not in (10, 20)]


def test_split_size_does_not_change_records(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    files = warc.write_archives(warc.plan_records(pages), str(tmp_path), file_bytes=10_000)
    assert files.count() > 1 and files.agg({"records": "sum"}).first()[0] == len(PAGES)
    small = warc.read_archives(spark, files, split_bytes=500).select("record_id", "payload_digest")
    large = warc.read_archives(spark, files).select("record_id", "payload_digest")
    assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, large.collect()), key=repr)


@pytest.mark.parametrize("step", [5000, 10**7])
def test_header_of_any_length(step):
    rng = random.Random(3)
    urls = ["http://x/" + "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(n)) for n in (10, 400_000, 20)]
    data = b"".join(gzip.compress(warc.record_bytes(i, u, b"p", None, "2024"), mtime=0) for i, u in enumerate(urls))
    assert [name for _, name in read_in_ranges(data, step)] == [f"<urn:page:{i}>" for i in range(3)]


def test_long_url_comes_back(spark):
    rng = random.Random(5)
    url = "http://x/" + "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(400_000))
    pages = spark.createDataFrame([(1, "u", "a"), (2, url, "b"), (3, "v", "c")], SCHEMA)
    assert sorted(r["page_id"] for r in warc.round_trip(pages).collect()) == [1, 2, 3]


def test_lost_records_are_reported(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    files = warc.write_archives(warc.plan_records(pages), str(tmp_path), file_bytes=10_000)
    rows = warc.read_archives(spark, files)
    warc.check_counts(rows, files)
    name = files.first()["path"]
    with open(name.removeprefix("file:"), "r+b") as f:
        f.write(b"damage")
    with pytest.raises(warc.LostRecords, match=name.rsplit("/", 1)[-1]):
        warc.check_counts(warc.read_archives(spark, files), files)
