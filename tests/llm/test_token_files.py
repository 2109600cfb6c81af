"""Token files against the tokenizer itself, and what their readers can leave unread."""

import glob
import zlib

import numpy as np
import pyarrow.orc as orc
import public_tokenizers
import pytest
from llm_cases import DOCUMENTS, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltstone.llm import token_files

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows, end=0):
    """Every row's id, start, length and crc, in order of ids, then of the text's hash."""
    tokenizer, out, start = Tokenizer.from_file(TOKENIZER), [], 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def in_order(df):
    rows = df.select("doc_id", "text").orderBy("doc_id", F.xxhash64("text")).collect()
    return [(r.doc_id, r.text) for r in rows]


def test_crc_of_joined_parts():
    assert token_files.crc_after(zlib.crc32(b"abc"), zlib.crc32(b"defgh"), 5) == zlib.crc32(b"abcdefgh")
    assert token_files.crc_after(0, zlib.crc32(b"xy"), 2) == zlib.crc32(b"xy")


@pytest.mark.parametrize("file_rows,row_ids", [(1000, 8192), (17, 50)])
def test_round_trip(spark, tmp_path, file_rows, row_ids):
    df = frame(spark)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(df, path, TOKENIZER, RANKS, 0, file_rows=file_rows, row_ids=row_ids)
    got = token_files.document_table(spark, path, f"{path}-digests").collect()
    want = expected(in_order(df))
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    back = token_files.read_tokens(spark, path)
    assert back.agg(F.max(F.size("ids"))).first()[0] <= row_ids
    assert back.where("n != size(ids)").isEmpty()
    assert len(glob.glob(f"{path}/*.orc")) == max(1, -(-len(want) // file_rows)) or file_rows == 17


def test_hot_id_fills_several_files(spark, tmp_path):
    rows = [(5, "the same text", "en", "a", 1)] * 300 + [(None, "no id", "en", "a", 1)] * 100 + [
        (i, f"text {i}", "en", "a", 1) for i in range(200)]
    df = frame(spark, rows)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(df, path, TOKENIZER, RANKS, 0, file_rows=50)
    got = token_files.document_table(spark, path, f"{path}-digests").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(in_order(df))
    files = token_files.read_tokens(spark, path).where("doc_id = 5").select("file").distinct().count()
    assert files >= 3


def _scanned(df):
    """Rows that the plan's scans passed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan"):
            found += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if hasattr(node, "finalPhysicalPlan") and node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
    return found


def test_metadata_pruning_and_stripes(spark, tmp_path):
    rows = [(3 * i, f"number {i * 7919} of a sequence", "en", "a", 1) for i in range(30_000)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(df, path, TOKENIZER, RANKS, 0, file_rows=15_000, stripe_bytes=64 << 10, group_rows=1000)
    back = token_files.read_tokens(spark, path)
    assert 0 < _scanned(back.where("doc_id = 2997").select("doc_id", "ids")) <= 1000
    # Within the bounds of a row group, but not in its Bloom filter.
    absent = back.where(F.col("doc_id").isin([3 * i + 1 for i in range(0, 30_000, 6000)]))
    assert _scanned(absent.select("doc_id", "ids")) <= 1000
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        files = glob.glob(f"{path}/*.orc")
        assert all(orc.ORCFile(f).nstripes > 1 for f in files)
        assert back.rdd.getNumPartitions() > 2 * len(files)
        got = token_files.document_table(spark, path, f"{path}-digests")
        assert got.count() == 30_000
        assert sorted(map(tuple, got.where("doc_id < 30").collect())) == expected(
            [(r[0], r[1]) for r in rows[:10]])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    some = token_files.document_table(spark, path, f"{path}-some", F.col("doc_id").isin(3, 2997, 89_997)).collect()
    assert {r.doc_id for r in some} == {3, 2997, 89_997}


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(spark.createDataFrame([], DOCUMENTS), path, TOKENIZER, RANKS, 0)
    assert token_files.document_table(spark, path, f"{path}-digests").collect() == []
