"""Helpers that several operators of this package share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.workspace import delete_path, hadoop_path, work_dir

#: Rows that a task turns into Python objects at a time, so that memory follows
#: the longest texts and not the Arrow batch.
SLICE_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below the one that all executors share."""
    return work_dir(spark)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back, which cuts its lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    delete_path(spark, path)


def crc_of_id(column: str) -> Column:
    """crc32 of an id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")))


def text_hash(text: str) -> Column:
    """A hash of a text as it stands; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def rows_of(docs: DataFrame, wanted: DataFrame, id_column: str, text: str) -> DataFrame:
    """One row of ``docs`` for each row of ``wanted``: ``id``, ``t`` (hash of its text)
    and ``c``, how many rows of ``docs`` have both.

    Where rows repeat, the first by their other columns' hash stays; a task passes
    on one row of each such group before they meet.
    """
    key = F.xxhash64(F.col("id").isNull(), "id", "t")
    rows, (id_name, text_name) = plain_names(docs, id_column, text)
    marked = rows.withColumns({"__id": F.col(id_name).cast("bigint"), "__t": text_hash(text_name)})
    marked = marked.withColumn("__key", F.xxhash64(F.col("__id").isNull(), "__id", "__t"))

    def chosen(some: DataFrame) -> DataFrame:
        ids = some.select(key.alias("__k"), F.col("id").alias("__i"), F.col("t").alias("__h"))
        match = (
            (F.col("__key") == F.col("__k")) & F.col("__id").eqNullSafe(F.col("__i"))
            & (F.col("__t") == F.col("__h"))
        )
        return marked.join(ids, match, "left_semi")

    out = chosen(wanted.where("c = 1"))
    repeated = wanted.where("c > 1")
    if not repeated.isEmpty():
        order = Window.partitionBy("__id", "__t").orderBy(F.xxhash64(*rows.columns))
        first = chosen(repeated).withColumn("__n", F.row_number().over(order)).where("__n = 1")
        out = out.unionByName(first.drop("__n"))
    return out.select(*rows.columns).toDF(*docs.columns)


def plain_names(docs: DataFrame, *used: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns named by position, so that no name clashes with another,
    and the new names of the ``used`` ones (the first of that name)."""
    return docs.toDF(*[f"column_{i}" for i in range(len(docs.columns))]), [
        f"column_{docs.columns.index(name)}" for name in used
    ]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def unique_name(prefix: str) -> str:
    return f"{prefix}-{os.getpid()}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as Spark's own file system settings have it."""
    fs, jpath = hadoop_path(spark, path)
    return fs.makeQualified(jpath).toString()


def task_fs(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """A file system for use in tasks, and the path on it, of a qualified URI."""
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith(("s3a:", "s3n:")):
        uri = "s3" + uri[3:]
    return pyarrow.fs.FileSystem.from_uri(uri)
