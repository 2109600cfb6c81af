"""From documents to packed training sequences.

Each stage takes all rows that the one before it kept, as read back from Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import exact_dedup, language_id, mixing, near_dedup, packing
from siltstone.llm.common import plain_names, shared_dir, stored
from siltstone.llm.queries import RANKS, SEQUENCE, TOKENIZER

#: A document stays if its main language has at least this share of it. Texts in two or
#: three languages are kept on purpose.
LEAST_SHARE = 0.25
#: How well a document must fit the language it is taken for: prose has about 1, a document
#: of licence lines 0.7; random letters and scripts that were not learned have 0.35 at most.
LEAST_FIT = 0.4
END_OF_TEXT = 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, those in which no language prevails, and those that
    fit no learned language, such as random letters.

    Without any labelled document nothing can be told, and all documents stay. Null texts
    go, repeated rows are judged alike, long texts are judged whole, and extra columns,
    whatever their names, are kept. An empty table stays empty.
    """
    rows, (doc_id, text, lang) = plain_names(docs, "doc_id", "text", "lang")
    model = language_id.train(rows, F.lit(True), doc_id, text, lang)
    if not model.languages:
        return docs
    judged = language_id.identify(rows, model, [F.col(c) for c in rows.columns], text)
    clear = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SHARE)
    return judged.where(clear & (F.col("fit") >= LEAST_FIT)).select(*rows.columns).toDF(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays.

    Null and empty texts are equal. Of rows that repeat one stays, with all its columns.
    Texts are compared whole. An empty table stays empty.
    """
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id stays.

    Texts without a word are in no group. Of rows that repeat one stays, with all its
    columns. Shingles are those of whole texts. An empty table stays empty.
    """
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of large sources in part, those of small ones repeated, to the target weights.

    A null source is a source. Null and empty texts have no tokens and go with their
    source. Rows keep all their columns. An empty table stays empty.
    """
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a sequence.

    A null text is empty and has its end alone; longer texts than a sequence are cut. Rows
    that repeat are packed each; other columns, whatever their names, are not read. An
    empty table gives no rows.
    """
    parts = packing.pieces(docs, TOKENIZER, RANKS, END_OF_TEXT, SEQUENCE.tokens, [F.col("doc_id")])
    return packing.pack(parts, SEQUENCE)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Language inference and best-fit packing cannot be put into SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
