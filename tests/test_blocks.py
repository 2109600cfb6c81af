"""Large xz and zstd files read in parts: every line once, wherever the cuts fall."""

import io
import lzma
import os
import random
import struct

import pytest
import zstandard

from siltstone.sources import archives, blocks
from siltstone.sources.archives import read_lines


def xz_of(pieces, per_stream=3):
    """An xz file with a block per piece, in several streams with padding between."""
    out = b""
    for i in range(0, len(pieces), per_stream):
        out += xz_stream(pieces[i : i + per_stream]) + b"\0" * (4 * (i % 2))
    return out


def xz_stream(pieces):
    """One stream of several blocks, put together from streams of one block each."""
    header, parts, records = None, [], []
    for piece in pieces:
        whole = lzma.compress(piece, check=lzma.CHECK_CRC32)
        found = blocks.xz_blocks(io.BytesIO(whole), len(whole))
        header = whole[:12]
        for b in found:
            data = whole[b.offset : b.offset + b.length]
            size = struct.unpack("<I", whole[-8:-4])[0]
            index = whole[-12 - (size + 1) * 4 : -12]
            unpadded, at = blocks._number(index, 2)
            parts.append(data)
            records.append((unpadded, b.expanded))

    def number(n):
        out = b""
        while n >= 0x80:
            out += bytes([n & 0x7F | 0x80])
            n >>= 7
        return out + bytes([n])

    import zlib

    index = b"\0" + number(len(records)) + b"".join(number(a) + number(b) for a, b in records)
    index += b"\0" * (-len(index) % 4)
    index += struct.pack("<I", zlib.crc32(index))
    tail = struct.pack("<I", len(index) // 4 - 1) + header[6:8]
    return header + b"".join(parts) + index + struct.pack("<I", zlib.crc32(tail)) + tail + b"YZ"


def zstd_of(pieces, table=False, sums=2):
    packed = [zstandard.ZstdCompressor(write_checksum=i % sums == 0, write_content_size=i % 3 > 0).compress(p)
              for i, p in enumerate(pieces)]
    out = b"".join(packed)
    if table:
        entries = b"".join(struct.pack("<II", len(c), len(p)) for c, p in zip(packed, pieces))
        footer = struct.pack("<IBI", len(packed), 0, blocks.SEEKABLE_MAGIC)
        out += struct.pack("<II", blocks.SEEK_TABLE, len(entries) + 9) + entries + footer
    else:
        out += struct.pack("<II", blocks.SKIPPABLE + 3, 5) + b"notes"
    return out


MAKERS = {
    "xz": xz_of,
    "zst": zstd_of,
    "table.zst": lambda pieces: zstd_of(pieces, table=True),
}


def cut_at(data, places):
    edges = [0, *sorted(places), len(data)]
    return [data[a:b] for a, b in zip(edges, edges[1:]) if b > a]


TEXTS = [
    b"one\ntwo\n\nthree\nfour", b"one\ntwo\n\nthree\nfour\n", b"\n", b"\n\n\n", b"no newline at all",
    b"a\n" + b"long line " * 30 + b"\nb\n", b"x" * 50 + b"\n",
]


@pytest.mark.parametrize("kind", MAKERS)
def test_every_cut(tmp_path, kind):
    """Each line once for every place of one and of two cuts."""
    for n, text in enumerate(TEXTS):
        want = text.split(b"\n")
        want = want[:-1] if want[-1] == b"" else want
        places = [(i,) for i in range(1, len(text))] + [
            tuple(sorted(random.Random(i).sample(range(1, len(text)), min(3, len(text) - 1))))
            for i in range(30) if len(text) > 1
        ]
        for k, cuts in enumerate(places[:: max(1, len(places) // 60)]):
            path = str(tmp_path / f"{n}-{k}.{kind}")
            with open(path, "wb") as f:
                f.write(MAKERS[kind](cut_at(text, cuts)))
            got = []
            for part in blocks.parts_of(path, 1):
                if part[1] == blocks.WHOLE:
                    got += [x for g in blocks.decoders._read_one(path, True) for x in g.column(1).to_pylist()]
                else:
                    got += [line for group in blocks._read_part(*part[:3]) for line in group]
            assert got == want, (kind, text, cuts)


def lines_and_file(tmp_path, kind, seed=1, rows=4000, make=None):
    rng = random.Random(seed)
    lines = [os.urandom(rng.choice([0, 5, 60, 400])).hex() for _ in range(rows - 1)] + ["end"]
    text = "\n".join(lines).encode()
    cuts = rng.sample(range(1, len(text)), 9)
    (tmp_path / f"big.{kind}").write_bytes((make or MAKERS[kind])(cut_at(text, cuts)))
    return lines


@pytest.mark.parametrize("kind", MAKERS)
def test_large_file_is_many_tasks(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(archives, "PART_BYTES", 1000)
    want = lines_and_file(tmp_path, kind)
    df = read_lines(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() >= 8
    assert sorted(r.value for r in df.collect()) == sorted(want)
    assert df.where("error is not null").isEmpty()
    assert max(map(len, df.rdd.glom().collect())) < len(want) / 2


def test_files_that_cannot_be_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "PART_BYTES", 100)
    body = os.urandom(3000).hex().encode() + b"\nend\n"
    (tmp_path / "one.xz").write_bytes(lzma.compress(body))
    (tmp_path / "one.zst").write_bytes(zstandard.ZstdCompressor().compress(body))
    (tmp_path / "wrong.xz").write_bytes(b"plain text " * 30)
    (tmp_path / "wrong.zst").write_bytes(b"plain text " * 30)
    df = read_lines(spark, str(tmp_path))
    assert df.where("error is null").count() == 4
    assert [r.error for r in df.where("error is not null").collect()] == ["unreadable file: wrong header"] * 2


@pytest.mark.parametrize("kind", ["xz", "zst"])
def test_damage_fails_or_is_kept(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(archives, "PART_BYTES", 1000)
    # Damage shows for certain only where every frame has a checksum, as every block has.
    lines_and_file(tmp_path, kind, make={"xz": xz_of, "zst": lambda p: zstd_of(p, sums=1)}[kind])
    path = tmp_path / f"big.{kind}"
    data = bytearray(path.read_bytes())
    middle = len(data) // 2
    data[middle : middle + 40] = bytes(40)
    path.write_bytes(bytes(data))
    with pytest.raises(Exception):
        read_lines(spark, str(tmp_path)).count()
    kept = read_lines(spark, str(tmp_path), on_damage="keep")
    assert kept.where("error like 'damaged file%'").count() == 1
    assert 0 < kept.where("error is null").count() < 4000
    # Cut off in the middle: no layout, so it is read as a whole and found damaged.
    path.write_bytes(bytes(data[: middle // 2]))
    with pytest.raises(Exception):
        read_lines(spark, str(tmp_path)).count()


def test_streams_and_padding_of_a_small_file(spark, tmp_path):
    (tmp_path / "a.xz").write_bytes(xz_of([b"a\nb", b"c\n", b"d\n", b"e\n", b"f\n"], per_stream=1))
    assert sorted(r.value for r in read_lines(spark, str(tmp_path)).collect()) == ["a", "bc", "d", "e", "f"]


def test_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "PART_BYTES", 1000)
    lines_and_file(tmp_path, "xz")
    (tmp_path / "a.zst").write_bytes(zstandard.ZstdCompressor().compress(b"small\n"))
    files = archives.known_files(archives.list_archives(spark, str(tmp_path)))
    all_at_once = archives.rounds(spark, files, "fail", None)
    assert len(all_at_once) == 1 and len(all_at_once[0][0]) == 2
    some = archives.rounds(spark, files, "fail", 40_000)
    assert len(some) > 3 and sum(len(p) for _, p in some) == len(archives.list_parts(spark, files))
    assert [f.path.rpartition("/")[2] for f, _ in [(w[0], p) for w, p in some if w]] == ["a.zst"]
    read = [archives.read_files(spark, w, parts=p) for w, p in some]
    assert sum(r.count() for r in read) == 4001


def test_a_part_reads_the_indexes_of_its_own_streams(tmp_path, monkeypatch):
    """However many streams a file has; a line may go on through all that follow."""
    texts = [f"{i}\n".encode() for i in range(200)] + [b"long "] + [b"x"] * 50 + [b"\nend\n"]
    path = str(tmp_path / "a.xz")
    with open(path, "wb") as f:
        f.write(xz_of(texts, per_stream=1))
    parts = blocks.parts_of(path, 700)
    assert len(parts) > 5
    listed, listing = [], blocks.xz_blocks

    def counted(*args):
        found = listing(*args)
        listed.append(len(found))
        return found

    monkeypatch.setattr(blocks, "xz_blocks", counted)
    got = [x for p in parts for g in blocks._read_part(p[0], p[1], p[2], p[4]) for x in g]
    assert got == b"".join(texts).split(b"\n")[:-1]
    assert sum(listed) == len(texts)


def test_rounds_are_cut_for_all_cores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "LEAST_PART_BYTES", 500)
    lines_and_file(tmp_path, "xz", make=lambda p: xz_of([b"".join(p)[i : i + 900] for i in range(0, len(b"".join(p)), 900)]))
    files = archives.known_files(archives.list_archives(spark, str(tmp_path)))
    rounds = archives.rounds(spark, files, "fail", 1 + files[0].size // 3)
    assert len(rounds) in (3, 4) and len(rounds[0][1]) >= 8


def test_one_archive_is_written_by_many_tasks(spark, tmp_path):
    from siltstone.plans.samples import write_one_archive

    lines = spark.range(0, 5000, 1, 7).selectExpr("concat('line ', id) AS value")
    write_one_archive(lines, str(tmp_path / "in"), "xz", block_bytes=1000)
    (file,) = archives.list_archives(spark, str(tmp_path / "in"))
    with open(file.path.removeprefix("file:"), "rb") as f:
        found = blocks.xz_blocks(f, file.size)
    assert len(found) >= 50 and max(b.expanded for b in found) == 1000
    # Each partition begins a stream of its own; a single task would leave one short block.
    assert sum(b.expanded < 1000 for b in found) >= 7
    assert sorted(r.value for r in read_lines(spark, str(tmp_path / "in")).collect()) == sorted(f"line {i}" for i in range(5000))


def test_larger_tables_make_more_tasks_not_longer_ones(spark, tmp_path, monkeypatch):
    from siltstone.plans import samples

    spark.range(20_000).selectExpr("id", "uuid() AS text").coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert samples.dealt(rows).rdd.getNumPartitions() == 8
    monkeypatch.setattr(samples, "PIECE_BYTES", 20_000)
    assert samples.dealt(rows).rdd.getNumPartitions() > 20


def test_tables_of_one_row_group_are_dealt_however_large(spark, tmp_path, monkeypatch):
    from siltstone.plans import samples

    spark.range(20_000).selectExpr("id", "uuid() AS text").coalesce(1).write.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(samples, "SPLIT_BYTES", 1000, raising=False)
    monkeypatch.setattr(samples, "PIECE_BYTES", 20_000)
    rows = samples.dealt(spark.read.parquet(str(tmp_path / "t")))
    assert rows.rdd.getNumPartitions() > 20
    assert rows.agg({"id": "sum"}).first()[0] == sum(range(20_000))


def test_tables_whose_splits_suit_the_cores_are_not_moved(spark, tmp_path, monkeypatch):
    from siltstone.plans import samples

    def stored(name, files):
        spark.range(16_000).selectExpr("id", "uuid() AS text").repartitionByRange(files, "id").write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    def moved(df):
        assert df.agg({"id": "sum"}).first()[0] == sum(range(16_000))
        return "Exchange" in df._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        assert not moved(samples.spread(stored("even", 16)))
        # One row group for all cores, then too few of them, then some that are too large.
        assert moved(samples.spread(stored("one", 1)))
        assert moved(samples.spread(stored("few", 3)))
        monkeypatch.setattr(samples, "PIECE_BYTES", 1000)
        assert moved(samples.spread(stored("large", 16)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    none = spark.createDataFrame([], "id long, text string")
    assert samples.spread(none).count() == 0
