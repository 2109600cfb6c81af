"""Archive-shaped data derived from the test tables, for the query registry."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.ids import base36_encode
from siltstone.plans import task_writer
from siltstone.workspace import child_names, delete_path, qualified_path, work_dir

cloudpickle.register_pickle_by_value(task_writer)


PIECE_BYTES = 16 << 20
# A table's splits are left as they are while the slowest core has so many times its share,
# and none has more than so many pieces.
MOST_WAIT = 1.5
MOST_PIECES = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The registry's timestamps are UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """A table dealt over all cores, before work that costs far more than moving it.

    The test tables are single files, and a split of a file is no smaller than its row
    groups, which may be any size. A task gets about ``PIECE_BYTES`` at most, so larger
    tables make more tasks, not longer ones.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, _planned_bytes(df) // PIECE_BYTES))


def spread(df: DataFrame) -> DataFrame:
    """As ``dealt``, but a table whose splits suit the cores is left as it lies: dealt rows
    take as much disk as the table, until the session collects its garbage.

    Rows per split come from Parquet's footers alone.
    """
    splits = df.groupBy(F.spark_partition_id().alias("split")).count().collect()
    sizes = sorted((row["count"] for row in splits), reverse=True)
    loads = [0] * df.sparkSession.sparkContext.defaultParallelism
    for size in sizes:
        heapq.heapreplace(loads, loads[0] + size)
    even = max(loads) * len(loads) <= MOST_WAIT * sum(sizes)
    small = max(sizes, default=0) * _planned_bytes(df) <= MOST_PIECES * PIECE_BYTES * sum(sizes)
    return df if even and small else dealt(df)


def _planned_bytes(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def epoch(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the four columns the filter needs."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("author"),
        F.col("event_type").alias("subreddit"),
        F.col("value").alias("score"),
        epoch(F.col("ts")).alias("created_utc"),
    )


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their quality label as score, NULL where there is none."""
    docs = table(spark, sf_dir, "documents").drop("text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("score"))
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        F.col("source").alias("author"),
        F.col("lang").alias("subreddit"),
        F.col("score").cast("bigint").alias("score"),
        F.col("n_chars").alias("created_utc"),
    )


def json_lines(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """One JSON object line per row; NULL fields are written as null."""
    pairs = ", ".join(f"'{key}', {value}" for key, value in fields.items())
    text = f"to_json(named_struct({pairs}), map('ignoreNullFields', 'false'))"
    return dealt(df).selectExpr(
        "'memory' AS file_path", f"{text} AS value", "cast(NULL AS string) AS error"
    )


CONVERSATION_KEY = "(conv_id * 1000 + turn + 45000000000)"


def conversation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn as a comment line."""
    submission = base36_encode("(conv_id + 1000)")
    previous = base36_encode(f"({CONVERSATION_KEY} - 1)")
    return json_lines(
        table(spark, sf_dir, "conversations"),
        {
            "author": "role",
            "body": "text",
            "subreddit": "'talk'",
            "id": base36_encode(CONVERSATION_KEY),
            "subreddit_id": "'t5_3hk7w'",
            "link_id": f"concat('t3_', {submission})",
            "parent_id": f"if(turn = 0, concat('t3_', {submission}), concat('t1_', {previous}))",
            "score": "turn",
            "created_utc": "cast(1700000000 + conv_id * 60 + turn AS string)",
            "edited": "turn = 0",
            "stickied": "role = 'system'",
            "extra": "array(named_struct('t', turn))",
        },
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a comment line."""
    return json_lines(
        table(spark, sf_dir, "events"),
        {
            "author": "cast(user_id AS string)",
            "body": "props",
            "subreddit": "event_type",
            "id": base36_encode("(event_id + 45000000000)"),
            "subreddit_id": "'t5_3hk7w'",
            "link_id": "'t3_1zq8m4k'",
            "score": "cast(floor(value) AS bigint)",
            "created_utc": "unix_seconds(cast(ts AS timestamp))",
            "edited": "false",
        },
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a submission line."""
    return json_lines(
        table(spark, sf_dir, "documents"),
        {
            "permalink": "concat('/d/', doc_id)",
            "title": "concat('about ', source, ' ', lang)",
            "selftext": "text",
            "id": base36_encode("(doc_id + 3000000000)"),
            "num_comments": "cast(n_chars AS int)",
            "over_18": "false",
            "is_self": "true",
            "created_utc": "n_chars + 1700000000",
            "score": "doc_id",
            "author": "if(lang <> 'de', source, NULL)",
            "subreddit": "lang",
            "post_hint": "if(lang = 'fr', 'hosted:video', 'self')",
            "link_flair_template_id": "if(lang = 'en', '', md5(cast(source AS binary)))",
            "crosspost_parent": "if(lang = 'es', concat('t3_', "
            + base36_encode("(doc_id + 3000000001)") + "), NULL)",
            "spoiler": "if(lang = 'fr', true, NULL)",
        },
    )


def write_archives(
    lines: DataFrame, directory: str, codec: str, tail: bytes = b"", block_bytes: int | None = None
) -> None:
    """Write lines as compressed files, one per partition, into ``directory``.

    ``tail`` is put behind each file that a task writes itself (gz, bz2, xz, zstd), and such
    a file has a block or frame for each ``block_bytes`` of text. Spark's own writer takes
    gzip only: its bzip2 costs several times the processor time of the C library.
    """
    if codec == "gzip":
        (
            lines.select("value")
            .write.mode("append")
            .option("compression", codec)
            .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
            .text(directory)
        )
        return

    if codec == "bzip2":
        # A null is an empty line, as with Spark's writer.
        codec, lines = "bz2", lines.select(F.coalesce("value", F.lit("")).alias("value"))
    directory = qualified_path(lines.sparkSession, directory)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task_writer.write_partition(batches, directory, codec, tail, block_bytes)

    lines.select("value").mapInArrow(write, "path string").write.format("noop").mode(
        "overwrite"
    ).save()


def write_one_archive(lines: DataFrame, directory: str, codec: str, block_bytes: int) -> None:
    """Write lines as a single file (xz, zstd) with a block for each ``block_bytes`` of text.

    Partitions are compressed by themselves, and one task puts the compressed bytes behind
    each other: a file has one writer.
    """
    spark = lines.sparkSession
    directory, parts = qualified_path(spark, directory), qualified_path(spark, work_dir(spark))
    try:
        write_archives(lines, parts, codec, block_bytes=block_bytes)
        names = sorted(n for n in child_names(spark, parts) if not n.startswith("."))
        paths = [f"{parts}/{name}" for name in names]

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                task_writer.join_files(paths, directory, names[0])
                yield batch

        spark.range(0, 1, 1, 1).mapInArrow(join, "id bigint").write.format("noop").mode("overwrite").save()
    finally:
        delete_path(spark, parts)
