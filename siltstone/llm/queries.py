"""The operators of this package as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import brown_lm, chat_format, cover_tree, exact_dedup, language_id, mixing
from siltstone.llm import near_dedup, packing, structure_repair, token_files, viterbi_counts, warc
from siltstone.llm import whitening
from siltstone.llm.common import crc_of_id, shared_dir, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op1_language_mixture(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = crc_of_id("doc_id") % 4 == 2
    model = language_id.train(docs, ~held_out)
    return language_id.identify(docs, model, [F.col("doc_id"), held_out.alias("held_out")])


@query
def op2_chat_parts(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    return chat_format.digests(chat_format.format_chat(turns.unionByName(extra)))


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: A sequence of 1024 tokens can hold any 1024 pieces, so only tokens bind here.
SEQUENCE = packing.Capacity(tokens=1024, documents=1024, attention=1024 * 1024)


@query
def op3_vector_packing(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return packing.pack(
        packing.pieces(docs, TOKENIZER, RANKS, 2, SEQUENCE.tokens, [F.col("doc_id")]), SEQUENCE
    )


@query
def op5_warc_round_trip(spark, sf_dir):
    return warc.round_trip(read(spark, sf_dir, "pages"))


@query
def op6_extendible_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


@query
def op10_temperature_mixing(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    folder = shared_dir(spark)
    rows = stored(mixing.narrow_rows(docs), f"{folder}/rows")
    return mixing.schedule(rows, stored(mixing.plan(rows), f"{folder}/sources")).select(
        F.col("i").alias("doc_id"), "source", F.col("n").alias("tokens"), "epoch", "block", "position"
    )


@query
def op9_setsketch_near(spark, sf_dir):
    return near_dedup.near_groups(read(spark, sf_dir, "documents"))


@query
def op8_cover_tree_search(spark, sf_dir):
    return cover_tree.top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query
def op7_viterbi_counts(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    return viterbi_counts.token_counts(
        read(spark, sf_dir, "documents"), viterbi_counts.vocabulary(model), [F.col("doc_id")],
        byte_fallback=viterbi_counts.has_bytes(model), split=False,
    )


@query
def op4_brown_classes(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = crc_of_id("doc_id") % 10 == 0
    return brown_lm.score_texts(
        docs, ~held_out, [F.col("doc_id"), held_out.alias("held_out")], settings=brown_lm.BrownSettings(least_count=3)
    )


@query
def op11_structure_repair(spark, sf_dir):
    return structure_repair.repaired(structure_repair.damaged(read(spark, sf_dir, "conversations")))


@query
def op12_orc_tokens(spark, sf_dir):
    folder = shared_dir(spark)
    token_files.write_tokens(read(spark, sf_dir, "documents"), f"{folder}/tokens", TOKENIZER, RANKS, 0)
    return token_files.document_table(spark, f"{folder}/tokens", f"{folder}/digests")


@query
def op13_qdwh_whitening(spark, sf_dir):
    return whitening.whitened_rows(read(spark, sf_dir, "embeddings"), shared_dir(spark))
