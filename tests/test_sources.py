import bz2
import gzip
import lzma
import os

import pytest
import zstandard

from siltstone.sources import archives, decoders
from siltstone.sources.archives import read_lines

LINES = [f'{{"n": {i}, "t": "é{i}"}}' for i in range(500)]
BODY = ("\n".join(LINES)).encode()  # no newline after the last line


def long_window(data):
    params = zstandard.ZstdCompressionParameters(
        compression_level=3, window_log=31, enable_ldm=True
    )
    return zstandard.ZstdCompressor(compression_params=params).compress(data)


def write(path, data):
    path.write_bytes(data)
    return path


def values(df):
    return sorted(r["value"] for r in df.where("error is null").collect())


def errors(df):
    rows = df.where("error is not null").collect()
    return {os.path.basename(r["file_path"]): r["error"] for r in rows}


@pytest.mark.parametrize(
    "name, data",
    [
        ("a.gz", gzip.compress(BODY)),
        ("a.bz2", bz2.compress(BODY)),
        ("a.xz", lzma.compress(BODY)),
        ("a.zst", zstandard.ZstdCompressor().compress(BODY)),
        ("long.zst", long_window(BODY)),
    ],
)
def test_each_codec(spark, tmp_path, name, data):
    write(tmp_path / name, data)
    assert values(read_lines(spark, str(tmp_path))) == sorted(LINES)


def test_members_streams_and_frames(spark, tmp_path):
    first, second = BODY + b"\n", b'{"n": -1}\n'
    for name, pack in (
        ("a.gz", gzip.compress),
        ("a.bz2", bz2.compress),
        ("a.xz", lzma.compress),
        ("a.zst", zstandard.ZstdCompressor().compress),
    ):
        write(tmp_path / name, pack(first) + pack(second))
    assert values(read_lines(spark, str(tmp_path))) == sorted((LINES + ['{"n": -1}']) * 4)


def test_paths_with_odd_characters(spark, tmp_path):
    folder = tmp_path / "a b%20ü"
    folder.mkdir()
    write(folder / "x y.xz", lzma.compress(BODY))
    write(folder / "x%y.zst", zstandard.ZstdCompressor().compress(BODY))
    write(folder / "x #y.gz", gzip.compress(BODY))
    df = read_lines(spark, str(folder))
    assert len(values(df)) == 1500 and errors(df) == {}


def test_skipped_and_unopenable_files(spark, tmp_path):
    write(tmp_path / "ok.gz", gzip.compress(b'{"n": 1}\n'))
    write(tmp_path / "plain.json", b"{}")
    write(tmp_path / "upper.GZ", gzip.compress(b"{}"))
    write(tmp_path / "noextension", b"{}")
    write(tmp_path / "fake.gz", b"not gzip at all")
    write(tmp_path / "fake.bz2", b"not bzip2 at all")
    write(tmp_path / "empty.xz", b"")
    (tmp_path / "folder.gz").mkdir()
    write(tmp_path / "folder.gz" / "inner.gz", gzip.compress(b"{}"))
    df = read_lines(spark, str(tmp_path), on_damage="keep")
    assert values(df) == ['{"n": 1}']
    found = errors(df)
    for name in ("plain.json", "upper.GZ", "noextension"):
        assert found.pop(name) == "unknown file extension"
    assert found.pop("fake.gz").startswith("unreadable file")
    assert found.pop("fake.bz2").startswith("unreadable file")
    assert set(found) <= {"empty.xz"}


def test_directory_must_exist(spark, tmp_path):
    with pytest.raises(ValueError):
        read_lines(spark, str(tmp_path / "missing"))
    with pytest.raises(ValueError):
        read_lines(spark, str(write(tmp_path / "file.gz", b"")))
    (tmp_path / "empty").mkdir()
    assert read_lines(spark, str(tmp_path / "empty")).count() == 0


@pytest.mark.parametrize("name, pack", [
    ("t.xz", lzma.compress), ("t.zst", zstandard.ZstdCompressor().compress)])
def test_damage_in_task_readers(spark, tmp_path, name, pack):
    noise = os.urandom(300_000).hex().encode()
    body = b"\n".join(noise[i:i + 100] for i in range(0, len(noise), 100))
    write(tmp_path / name, pack(body)[:-1000])
    df = read_lines(spark, str(tmp_path), on_damage="keep")
    assert len(values(df)) > 1000
    assert errors(df)[name].startswith("damaged file")
    with pytest.raises(Exception):
        read_lines(spark, str(tmp_path), on_damage="fail").count()


@pytest.mark.parametrize("name, pack", [("t.gz", gzip.compress), ("t.bz2", lambda b: bz2.compress(b, 1))])
def test_damage_in_spark_codecs(spark, tmp_path, name, pack):
    noise = os.urandom(300_000).hex().encode()
    body = b"\n".join(noise[i:i + 100] for i in range(0, len(noise), 100))
    write(tmp_path / name, pack(body)[:-1000])
    df = read_lines(spark, str(tmp_path), on_damage="keep")
    assert len(values(df)) > 1000
    assert errors(df)[name].startswith("damaged file")
    with pytest.raises(Exception):
        read_lines(spark, str(tmp_path), on_damage="fail").count()


@pytest.mark.parametrize("mode", ["fail", "keep"])
def test_hidden_names_are_read(spark, tmp_path, mode):
    write(tmp_path / "a.gz", gzip.compress(b'{"n": 0}\n'))
    for i, (name, pack) in enumerate((
        ("_b.gz", gzip.compress), (".c.gz", gzip.compress), ("_d.xz", lzma.compress), ("_e.bz2", bz2.compress),
    ), 1):
        write(tmp_path / name, pack(b'{"n": %d}\n' % i))
    write(tmp_path / "_f.txt", b"x")
    write(tmp_path / "_g.gz", b"no archive")
    df = read_lines(spark, str(tmp_path), on_damage=mode)
    assert values(df) == [f'{{"n": {i}}}' for i in range(5)]
    assert set(errors(df)) == {"_f.txt", "_g.gz"}


@pytest.mark.parametrize("mode", ["fail", "keep"])
def test_wrong_headers_cost_the_file_only(spark, tmp_path, mode):
    write(tmp_path / "ok.gz", gzip.compress(b'{"n": 1}\n'))
    for name in ("a.gz", "b.bz2", "c.xz", "d.zst"):
        write(tmp_path / name, b"plain text, no archive")
    df = read_lines(spark, str(tmp_path), on_damage=mode)
    assert values(df) == ['{"n": 1}']
    assert {e.partition(":")[0] for e in errors(df).values()} == {"unreadable file"} and len(errors(df)) == 4


def test_open_check_leaves_other_failures_to_the_reader(monkeypatch):
    import pyarrow as pa

    def refuse(error):
        def opened(path):
            raise error

        return opened

    batch = pa.RecordBatch.from_pydict({"path": ["x://h/a.gz"]})
    for error, said in ((FileNotFoundError("gone"), 1), (PermissionError("no"), 1), (OSError("no libhdfs"), 0),
                        (pa.ArrowInvalid("unknown scheme"), 0)):
        monkeypatch.setattr(decoders, "open_file", refuse(error))
        assert len(list(decoders.open_check(iter([batch])))) == said
        if not said:
            with pytest.raises(type(error)):
                list(decoders._read_one("x://h/a.gz", False))


def test_missing_decoder_fails_before_the_job(spark, tmp_path, monkeypatch):
    import sys

    write(tmp_path / "a.zst", zstandard.ZstdCompressor().compress(BODY))
    monkeypatch.setitem(sys.modules, "zstandard", None)
    with pytest.raises(ImportError):
        read_lines(spark, str(tmp_path))


def test_files_that_vanish_after_listing(spark, tmp_path):
    for name, data in (("a.gz", gzip.compress(BODY)), ("b.xz", lzma.compress(BODY))):
        write(tmp_path / name, data)
    df = read_lines(spark, str(tmp_path))
    (tmp_path / "a.gz").unlink()
    with pytest.raises(Exception):
        df.count()
    (tmp_path / "b.xz").unlink()
    write(tmp_path / "a.gz", gzip.compress(BODY))
    kept = read_lines(spark, str(tmp_path), on_damage="keep")
    (tmp_path / "a.gz").unlink()
    assert errors(kept)["a.gz"].startswith("unreadable file")


def test_lines_end_at_newlines_only(spark, tmp_path):
    data = b'{"a": 1}\r\n\n{"b":\r2}\n\xff\xfe\n'
    write(tmp_path / "a.gz", gzip.compress(data))
    write(tmp_path / "a.xz", lzma.compress(data))
    rows = read_lines(spark, str(tmp_path)).selectExpr("value", "is_valid_utf8(value) ok")
    assert rows.where("not ok").count() == 2
    got = sorted(r["value"] for r in rows.where("ok").collect())
    assert got == sorted(['{"a": 1}\r', "", '{"b":\r2}'] * 2)


def test_split_lines_across_chunks():
    chunks = [b"ab", b"c\nde", b"\n\nf", b"g", b"h"]
    assert [x for group in decoders.split_lines(iter(chunks)) for x in group] == [
        b"abc", b"de", b"", b"fgh",
    ]
    assert list(decoders.split_lines(iter([b"a\n"]))) == [[b"a"]]


def test_spreading_keeps_every_line(spark, tmp_path):
    write(tmp_path / "a.gz", gzip.compress(b"same\n" * 1000 + BODY))
    df = read_lines(spark, str(tmp_path), spread_over=8)
    assert df.rdd.getNumPartitions() == 8
    sizes = df.rdd.glom().map(len).collect()
    assert sum(sizes) == 1500 and max(sizes) < 400


def test_when_to_spread():
    def files(*sizes):
        return [archives.ArchiveFile(str(i), "gz", s) for i, s in enumerate(sizes)]

    gb = 1 << 30
    assert archives.spread_partitions(files(*[gb] * 100), 10) is None
    assert archives.spread_partitions(files(50 * gb, *[gb] * 50), 10) == 40
    assert archives.spread_partitions(files(*[100 * gb] * 1000, 60_000 * gb), 10_000) == 40_000
    assert archives.spread_partitions(files(1000, 10), 10) is None
    assert archives.spread_partitions([], 10) is None


def test_bzip2_samples_have_small_blocks_and_split(spark, tmp_path):
    from siltstone.plans import samples

    want = [f"line {i} {i * 7919 % 1000003}" for i in range(40_000)] + [None, ""]
    rows = spark.createDataFrame([(v,) for v in want], "value string").coalesce(1)
    empty = spark.range(0, 2, 1, 2).where("id < 0").selectExpr("cast(id AS string) AS value")
    samples.write_archives(rows.unionAll(empty), str(tmp_path), "bzip2")
    found = sorted(tmp_path.glob("*.bz2"), key=lambda f: f.stat().st_size)
    assert len(found) == 3 and found[-1].read_bytes().startswith(b"BZh1")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 50_000)
    try:
        read = read_lines(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 3
        assert sorted(r.value for r in read.collect()) == sorted(v or "" for v in want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_many_archives_are_many_tasks(spark, tmp_path):
    for i in range(40):
        write(tmp_path / f"{i}.json.xz", lzma.compress(f"line {i}\n".encode()))
    read = read_lines(spark, str(tmp_path))
    found = [len(rows) for rows in read.rdd.glom().collect()]
    assert sum(n > 0 for n in found) > 16 and max(found) <= 2
    assert sorted(r.value for r in read.collect()) == sorted(f"line {i}" for i in range(40))
