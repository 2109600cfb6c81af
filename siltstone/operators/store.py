"""Parquet tables with insert-if-absent on the decoded id.

Layout: partitioned by ``id_range`` (the id's high bits) and sorted by id inside
each file. Ids grow with time, so a batch touches few ranges. A ledger beside the data
(``ledger``) has bitmaps of the stored ids, so an insert reads no stored row, and the
times of each range, so time bounds skip ranges. Id lookups skip row groups too.

Deletes and updates replace whole ranges: what they will hold is set down under
``_staged``, then ``_commit`` names it, and from then on it counts, also for readers,
until the ranges are replaced. A writer that falls in between is finished by the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators import ledger as ledgers
from siltstone.operators.ledger import Ledger, Span
from siltstone.schema import Entity
from siltstone.workspace import child_names, delete_path, path_exists, touch_path

# Ids per table partition, and per block kept together on write, as powers of two.
RANGE_BITS = 28
BLOCK_BITS = 20
# Ids beyond the last range share it, so stray ids cannot create folders without end.
LAST_RANGE = 4096
# A batch touching more ranges than this is checked against the whole table.
MAX_PRUNED_RANGES = 1000


def id_range(key: Column) -> Column:
    """Partition value of an id, between -1 and ``LAST_RANGE``."""
    high = F.shiftright(key, RANGE_BITS)
    return F.greatest(F.least(high, F.lit(LAST_RANGE)), F.lit(-1)).cast("int")


def keep_first(df: DataFrame, key: str | list[str], order: list[str | Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    Written as ``row_number() = 1``, for which Spark also keeps only the first
    row per key before the shuffle; a key with very many copies sends at most
    one row per task.
    """
    keys = [key] if isinstance(key, str) else key
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def insert_if_absent(
    existing: DataFrame | None,
    incoming: DataFrame,
    key: str,
    order: list[str | Column],
) -> DataFrame:
    """Rows of ``incoming`` to add: first per key, and not among ``existing`` keys.

    Both steps use the same partitioning by key, so incoming rows move once.
    """
    fresh = keep_first(incoming, key, order)
    if existing is None:
        return fresh
    return fresh.join(existing.select(key), key, "left_anti")


def table_schema(entity: Entity) -> T.StructType:
    """Stored columns plus the partition column."""
    return T.StructType([*entity.schema.fields, T.StructField("id_range", T.IntegerType())])


def create_table(spark: SparkSession, path: str, entity: Entity) -> None:
    """Create an empty table with the declared schema, unless it is there already."""
    if not path_exists(spark, path):
        empty = spark.createDataFrame([], table_schema(entity))
        empty.write.mode("ignore").partitionBy("id_range").parquet(path)


def _data(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    return spark.read.schema(table_schema(entity)).parquet(path)


def _pending(spark: SparkSession, path: str) -> list[str]:
    return child_names(spark, f"{path}/_commit")


def read_table(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    """The table's rows. Ranges of an unfinished change are read from where it set them
    down."""
    table = _data(spark, path, entity)
    for token in _pending(spark, path):
        staged = _data(spark, f"{path}/_staged/{token}", entity)
        ranges = _staged_ranges(spark, path, token)
        table = table.where(~F.col("id_range").isin(ranges)).unionByName(staged)
    return table


def read_between(
    spark: SparkSession, path: str, entity: Entity, least: int | None = None, largest: int | None = None
) -> DataFrame:
    """Rows with ``created_utc`` within the given bounds, which are inclusive.

    Only id ranges that may hold such a row are read: the ledger's times become a
    condition on the folders. Ranges it knows nothing sure about are read.
    """
    table = read_table(spark, path, entity)
    if (least is not None or largest is not None) and not _pending(spark, path):
        ranges = Ledger(spark, path).within(least, largest)
        if ranges is not None:
            table = table.where(F.col("id_range").isin(ranges))
    if least is not None:
        table = table.where(F.col("created_utc") >= least)
    return table if largest is None else table.where(F.col("created_utc") <= largest)


def lookup(table: DataFrame, decoded_id: int) -> DataFrame:
    """Row of one id; prunes to a partition, then to the row groups that may hold it."""
    key = F.lit(decoded_id).cast("bigint")
    found = table.where((F.col("id_range") == id_range(key)) & (F.col("decoded_reddit_id") == key))
    return found.drop("id_range")


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("n"))


def touched_spans(batch: DataFrame, key: str) -> dict[int, Span] | None:
    """Id ranges ``batch`` touches and the times of its rows there, or None when they are
    too many to list."""
    rows = batch.select(id_range(F.col(key)).alias("id_range"), "created_utc")
    spans = ledgers.spans_of(rows)
    return spans if len(spans) <= MAX_PRUNED_RANGES else None


def append(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    entity: Entity,
    order: list[str | Column],
    spans: dict[int, Span] | None = None,
) -> int:
    """Insert the rows of ``batch`` whose id the table does not hold; return how many.

    ``spans`` are the id ranges the batch touches (``touched_spans``). Stored ids are
    known from the ledger's bitmaps; of ranges it has no sure entry for, and of all
    ranges where the batch touches too many, the id column is read. Running the same
    batch again adds nothing. One writer per table at a time.
    """
    create_table(spark, path, entity)
    finish(spark, path, entity)
    ledger = Ledger(spark, path)
    fresh = keep_first(batch, entity.key, order).select(*entity.columns)
    fresh = fresh.withColumn("id_range", id_range(F.col(entity.key)))
    entries: dict[int, tuple[Span, str]] = {}
    unsure: list[int] = []
    if spans is None:
        stored = _data(spark, path, entity).select(entity.key)
        fresh = fresh.join(stored, entity.key, "left_anti")
    else:
        present = ledger.ranges() & set(spans)
        entries = ledger.believed(present)
        unsure = sorted(present - set(entries))
        if unsure:
            stored = _data(spark, path, entity).where(F.col("id_range").isin(unsure)).select(entity.key)
            fresh = fresh.join(stored, entity.key, "left_anti")
        if entries:
            fresh = ledgers.absent(fresh, ledger.known_ids(entries), entity.key)
    added = Observation()
    (
        fresh.select(*entity.columns, "id_range")
        .withColumn("_block", F.shiftright(entity.key, BLOCK_BITS))
        # Blocks of neighbouring ids go to one task; AQE merges small tasks and
        # cuts large ones to the advisory size.
        .hint("rebalance", "_block")
        .drop("_block")
        .sortWithinPartitions("id_range", entity.key)
        .observe(added, F.count(F.lit(1)).alias("n"))
        .write.mode("append")
        .partitionBy("id_range")
        .parquet(path)
    )
    if spans:
        ids = batch.select(entity.key, id_range(F.col(entity.key)).alias("id_range"))
        maps = ledgers.bitmaps(ids.where(~F.col("id_range").isin(unsure)) if unsure else ids, entity.key)
        whole = {n: span.joined(entries[n][0]) if n in entries else span for n, span in spans.items()}
        if unsure:
            rows = _data(spark, path, entity).where(F.col("id_range").isin(unsure))
            maps = maps.unionByName(ledgers.bitmaps(rows, entity.key))
            whole |= ledgers.spans_of(rows)
        if entries:
            maps = maps.unionByName(ledger.known_ids(entries))
        # Of a range into which nothing was put because all is known, the entry stays true.
        ledger.record(whole, ledger.write_ids(maps))
    return added.get["n"]


def _staged_ranges(spark: SparkSession, path: str, token: str) -> list[int]:
    return sorted(int(n) for n in child_names(spark, f"{path}/_staged/{token}-ranges"))


def _rewrite(
    spark: SparkSession, path: str, entity: Entity, gone: DataFrame, new: DataFrame | None
) -> int:
    """Take the rows with the ids of ``gone`` out of the table and put ``new`` in.

    Only the id ranges concerned are read and written. What they will hold is written
    beside the table first and counts as a whole once it is complete. Returns how many
    rows there are less.
    """
    finish(spark, path, entity)
    touched = gone.select(id_range(F.col(entity.key)).alias("r")).distinct()
    listed = [r["r"] for r in touched.limit(MAX_PRUNED_RANGES + 1).collect()]
    present = Ledger(spark, path).ranges()
    ranges = sorted(present if len(listed) > MAX_PRUNED_RANGES else present & set(listed))
    old = _data(spark, path, entity).where(F.col("id_range").isin(ranges))
    before = old.count()
    left = old.join(gone.select(entity.key).distinct(), entity.key, "left_anti")
    if new is not None:
        left = left.unionByName(new.withColumn("id_range", id_range(F.col(entity.key))))
    token, after = uuid.uuid4().hex, Observation()
    staged = f"{path}/_staged/{token}"
    (
        left.select(*entity.columns, "id_range")
        .hint("rebalance", "id_range")
        .sortWithinPartitions("id_range", entity.key)
        .observe(after, F.count(F.lit(1)).alias("n"))
        .write.partitionBy("id_range").parquet(staged)
    )
    for number in ranges:
        touch_path(spark, f"{staged}-ranges/{number}")
    touch_path(spark, f"{path}/_commit/{token}")
    _replace(spark, path, entity, token)
    return before - after.get["n"]


def _replace(spark: SparkSession, path: str, entity: Entity, token: str) -> None:
    """Put the ranges that a change has set down in place of the table's; may be repeated."""
    staged_path = f"{path}/_staged/{token}"
    ranges = _staged_ranges(spark, path, token)
    staged = _data(spark, staged_path, entity)
    (
        staged.hint("rebalance", "id_range")
        .sortWithinPartitions("id_range", entity.key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("id_range")
        .parquet(path)
    )
    spans = ledgers.spans_of(staged)
    for emptied in sorted(set(ranges) - set(spans)):
        delete_path(spark, f"{path}/id_range={emptied}")
        delete_path(spark, f"{path}/_ledger/id_range={emptied}")
    ledger = Ledger(spark, path)
    if spans:
        ledger.record(spans, ledger.write_ids(ledgers.bitmaps(staged, entity.key)))
    delete_path(spark, f"{path}/_commit/{token}")
    delete_path(spark, staged_path)
    delete_path(spark, f"{staged_path}-ranges")


def finish(spark: SparkSession, path: str, entity: Entity) -> None:
    """Finish a change whose writer fell after it counted; forget one that never did."""
    for token in _pending(spark, path):
        _replace(spark, path, entity, token)
    delete_path(spark, f"{path}/_staged")


def delete(spark: SparkSession, path: str, entity: Entity, ids: DataFrame) -> int:
    """Delete rows by id (one column); returns how many. Unknown ids do not matter."""
    return _rewrite(spark, path, entity, ids.toDF(entity.key), None)


def update(
    spark: SparkSession, path: str, entity: Entity, rows: DataFrame, changed_path: str
) -> DataFrame:
    """Put whole rows in place of the stored ones of equal id; returns those that were.

    Rows with an unknown id are left out; of several rows with one id the first by
    content counts. ``changed_path`` is a new folder for the rows that are returned, as
    the table is read to find them and then rewritten; the caller deletes it.
    """
    known = read_table(spark, path, entity).select(entity.key)
    fresh = keep_first(rows.select(*entity.columns), entity.key, [F.xxhash64(*entity.columns)])
    changed = fresh.join(known, entity.key, "left_semi").select(*entity.columns)
    changed.write.parquet(changed_path)
    changed = spark.read.schema(entity.schema).parquet(changed_path)
    _rewrite(spark, path, entity, changed.select(entity.key), changed)
    return changed
