"""Incremental ingest: new archive files are picked up and appended as they arrive."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from siltstone.operators.filters import FilterSpec
from siltstone.operators.text_index import DEFAULT_BUCKETS
from siltstone.plans.ingest import IngestCounts, ingest_lines, reject_path, write_rejects
from siltstone.schema import Entity
from siltstone.sources.archives import (
    SPARK_CODECS,
    TASK_CODECS,
    ArchiveFile,
    hidden,
    list_archives,
    read_files,
    rounds,
    unread_files,
)
from siltstone.workspace import path_exists, touch_path

# Fixed value: the columns of Spark's binaryFile source.
_BINARY_FILE_DDL = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(
    spark: SparkSession, directory: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The archives in ``directory`` as a streaming (path, length); nothing of them is read."""
    reader = spark.readStream.format("binaryFile").schema(_BINARY_FILE_DDL)
    reader = reader.option("pathGlobFilter", "*.{" + ",".join(SPARK_CODECS + TASK_CODECS) + "}")
    # By default files much older than the newest are ignored; archives keep old dates.
    reader = reader.option("maxFileAge", "36500d")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory).select("path", "length")


def report_unread(spark: SparkSession, directory: str, out: str, entity: Entity) -> int:
    """Store a reject row for each file that the stream does not see; how many there are.

    Those have another extension, or a name that Spark hides. The rows are those of
    the directory as it is now, under a name of their own.
    """
    files = list_archives(spark, directory)
    rows = unread_files(files)
    other = {path for path, _, _ in rows}
    rows += [(f.path, None, "hidden name") for f in files if hidden(f.path) and f.path not in other]
    name = hashlib.sha256(directory.encode()).hexdigest()[:16]
    if rows or path_exists(spark, f"{reject_path(out, entity)}/batch=files-{name}"):
        frame = spark.createDataFrame(rows, "file_path string, value string, reason string")
        write_rejects(frame, out, entity, f"files-{name}")
    return len(rows)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps over restarts, from its checkpoint."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0]
    return json.loads(text)["id"]


def start_ingest(
    spark: SparkSession,
    directory: str,
    out: str,
    entity: Entity,
    checkpoint: str,
    spec: FilterSpec = FilterSpec(),
    *,
    build_index: bool = False,
    on_bad_id: str = "reject",
    on_damage: str = "fail",
    index_buckets: int = DEFAULT_BUCKETS,
    max_files_per_trigger: int | None = None,
    max_bytes_per_round: int | None = None,
    on_batch: Callable[[int, IngestCounts], None] | None = None,
) -> StreamingQuery:
    """Start a query that ingests everything new in ``directory`` and then stops.

    Files it cannot take are stored as rejects first. Rejects of a micro-batch are
    named by the query's id and the batch's number, so a batch that is run again
    replaces its own, and queries do not replace each other's.

    ``checkpoint`` remembers the files already taken. Files of a micro-batch are read
    like those of a batch, so a large xz or zst file is many tasks. With
    ``max_bytes_per_round`` (compressed bytes) a micro-batch is taken in rounds, which may
    end within such a file; rounds that are done are marked under the checkpoint, so a
    restart goes on behind them. Each round runs the batch job's append, which adds unseen
    ids only, so one that is run again after a failure changes nothing. No streaming state
    is kept: duplicates are found against the table, however old. One writer per table.

    ``on_batch`` gets the number of a micro-batch and the counts of the rounds run now.
    """

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        files = [
            ArchiveFile(r["path"], r["path"].rpartition(".")[2], r["length"]) for r in batch.collect()
        ]
        delivery = f"stream-{_query_id(session, checkpoint)}-{number}"
        counts = []
        turns = rounds(session, files, on_damage, max_bytes_per_round)
        for turn, (whole, parts) in enumerate(turns):
            name = delivery if len(turns) == 1 else f"{delivery}-{turn}"
            done = f"{checkpoint.rstrip('/')}/rounds/{number}/{_named(whole, parts)}"
            if len(turns) > 1 and path_exists(session, done):
                continue
            counts.append(ingest_lines(
                session, read_files(session, whole, on_damage, parts=parts), out, entity, spec,
                build_index=build_index, on_bad_id=on_bad_id, index_buckets=index_buckets,
                batch=name,
            ))
            if len(turns) > 1:
                touch_path(session, done)
        if on_batch is not None:
            on_batch(number, reduce(lambda a, b: a + b, counts, IngestCounts(0, 0, 0, 0, 0)))

    report_unread(spark, directory, out, entity)
    return (
        stream_files(spark, directory, max_files_per_trigger)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _named(files: list[ArchiveFile], parts: list | None) -> str:
    """A name for what a round reads: rounds cut otherwise have other names."""
    what = [[f.path, f.size] for f in files] + [list(p) for p in parts or []]
    return hashlib.sha256(json.dumps(what).encode()).hexdigest()[:24]
