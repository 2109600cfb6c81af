"""The ingest job: archives in, clean tables (and optionally text indexes) out."""

from __future__ import annotations

import uuid
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators import filters, normalize, store
from siltstone.operators.filters import FilterSpec
from siltstone.operators.text_index import DEFAULT_BUCKETS, TextIndex
from siltstone.schema import COMMENT, ENTITIES, SUBMISSION, Entity
from siltstone.sources.archives import read_lines
from siltstone.workspace import delete_path, path_exists, work_dir

REJECT_DDL = "file_path string, line string, reason string"


@dataclass(frozen=True)
class IngestCounts:
    """What became of the lines of one entity.

    lines = rejected + filtered + kept, and kept = stored + duplicates.
    """

    lines: int
    rejected: int
    filtered: int
    kept: int
    stored: int

    def __add__(self, other: IngestCounts) -> IngestCounts:
        return IngestCounts(*(a + b for a, b in zip(astuple(self), astuple(other))))


def table_path(out: str, entity: Entity) -> str:
    return f"{out.rstrip('/')}/{entity.name}"


def index_path(out: str, entity: Entity) -> str:
    return f"{out.rstrip('/')}/{entity.name}_fts"


def reject_path(out: str, entity: Entity) -> str:
    return f"{out.rstrip('/')}/rejects/entity={entity.name}"


def _staged_schema(entity: Entity) -> T.StructType:
    """Layout of judged rows in the work folder: nothing but the status is always set."""
    return T.StructType(
        [
            T.StructField("file_path", T.StringType()),
            T.StructField("line_hash", T.LongType()),
            T.StructField("value", T.BinaryType()),
            T.StructField("reason", T.StringType()),
            *[T.StructField(f.name, f.dataType) for f in entity.schema.fields],
            T.StructField("status", T.StringType()),
        ]
    )


UNWANTED = "not wanted"
STATUSES = ("kept", "filtered", "rejected")


def unparsed_where_unwanted(lines: DataFrame, spec: FilterSpec) -> DataFrame:
    """Takes away the text of lines that cannot match the name filter, not the lines."""
    unwanted = F.col("error").isNull() & ~filters.may_match_line(spec, F.col("value"))
    return lines.select(
        "file_path",
        F.when(~unwanted, F.col("value")).alias("value"),
        F.when(unwanted, F.lit(UNWANTED)).otherwise(F.col("error")).alias("error"),
    )


def judged(
    lines: DataFrame,
    entity: Entity,
    spec: FilterSpec = FilterSpec(),
    on_bad_id: str = "reject",
    files_only: bool = False,
) -> DataFrame:
    """Normalised rows with a ``status``: kept, filtered or rejected.

    With ``files_only`` lines that are no record count as filtered, and only files
    that could not be read, and bad ids, as rejected.

    An id that does not decode matters only for rows the filter keeps; it
    rejects the row, or with ``on_bad_id="fail"`` stops the job.
    """
    if on_bad_id not in ("reject", "fail"):
        raise ValueError("on_bad_id is 'reject' or 'fail'")
    rows = normalize.normalize(lines, entity)
    record = F.col("reason").isNull()
    if len(spec.names) <= filters.INLINE_NAMES:
        passes = filters.predicate(spec)
    else:
        spark = lines.sparkSession
        users = filters.name_frame(spark, spec.users)
        subreddits = filters.name_frame(spark, spec.subreddits)
        rows = filters.mark_listed(rows, users, subreddits, "_listed")
        passes = filters.bounds(spec) & F.col("_listed")
    bad_id = F.col(entity.key).isNull()
    no_file_error = F.col("value").isNotNull() if files_only else F.lit(False)
    status = (
        F.when(F.col("reason") == UNWANTED, F.lit("filtered"))
        .when(~record & no_file_error, F.lit("filtered"))
        .when(~record, F.lit("rejected"))
        .when(~passes, F.lit("filtered"))
        .when(bad_id, F.lit("rejected"))
        .otherwise(F.lit("kept"))
    )
    bad_reason = F.lit("invalid id")
    if on_bad_id == "fail":
        bad_reason = F.raise_error(F.concat(F.lit("invalid id: "), F.col("reddit_id")))
    kept_bad_id = record & passes & bad_id
    return rows.withColumn("status", status).withColumn(
        "reason", F.when(kept_bad_id, bad_reason).otherwise(F.col("reason"))
    )


def write_rejects(rows: DataFrame, out: str, entity: Entity, batch: str) -> None:
    """Store refused rows (file_path, value, reason); the same batch again replaces them."""
    normalize.rejects(rows).write.mode("overwrite").parquet(f"{reject_path(out, entity)}/batch={batch}")


def ingest_lines(
    spark: SparkSession,
    lines: DataFrame,
    out: str,
    entity: Entity,
    spec: FilterSpec = FilterSpec(),
    *,
    build_index: bool = False,
    report_rejects: bool = True,
    on_bad_id: str = "reject",
    index_buckets: int = DEFAULT_BUCKETS,
    batch: str | None = None,
) -> IngestCounts:
    """Judge raw lines and append the kept ones to the entity's table.

    The judged rows are written once to the shared work folder. Decompression
    and parsing therefore run once, although kept rows and rejects go to
    different tables, and a lost executor later on does not repeat them. ``batch``
    names this delivery's rejects: the same name again replaces them.

    Without ``report_rejects`` lines that cannot match the name filter are not
    parsed, and lines that are no record count as filtered; the kept rows are the
    same. Files that could not be read are reported in any case.
    """
    if not report_rejects:
        lines = unparsed_where_unwanted(lines, spec)
    rows = judged(lines, entity, spec, on_bad_id, files_only=not report_rejects)
    staged_path, seen = work_dir(spark), Observation()
    counted = [F.count(F.when(F.col("status") == s, 1)).alias(s) for s in STATUSES]
    try:
        # Counted as they are written: the write's own tasks count, each once, however
        # often it was retried. Filtered rows need no writing then.
        rows.observe(seen, *counted).where("status <> 'filtered'").selectExpr(
            "status",
            "file_path",
            "if(status = 'kept', line_hash, NULL) AS line_hash",
            "if(status = 'rejected', cast(value AS binary), NULL) AS value",
            "if(status = 'rejected', reason, NULL) AS reason",
            *[f"if(status = 'kept', {c}, NULL) AS {c}" for c in entity.columns],
        ).write.partitionBy("status").parquet(staged_path)
        return _append_staged(
            spark, staged_path, out, entity, build_index, index_buckets, report_rejects,
            batch or uuid.uuid4().hex, {s: seen.get[s] for s in STATUSES},
        )
    finally:
        delete_path(spark, staged_path)


def _append_staged(
    spark: SparkSession, staged_path: str, out: str, entity: Entity,
    build_index: bool, index_buckets: int, report_rejects: bool, batch: str, tally: dict[str, int],
) -> IngestCounts:
    """Move judged rows from the work folder to the tables."""
    path = table_path(out, entity)
    store.create_table(spark, path, entity)
    staged = spark.read.schema(_staged_schema(entity)).parquet(staged_path)
    kept_count, rejected_count = tally["kept"], tally["rejected"]

    if rejected_count:
        refused = staged.where("status = 'rejected'")
        if not report_rejects:
            refused = refused.where("value IS NULL")
        write_rejects(refused.withColumn("value", F.col("value").cast("string")), out, entity, batch)

    stored, spans = 0, {}
    index = TextIndex(
        spark, index_path(out, entity), entity.key, entity.text_fields, index_buckets
    )
    covered = index.covers()
    if kept_count:
        index.uncover()
        kept = staged.where("status = 'kept'")
        spans = store.touched_spans(kept, entity.key)
        stored = store.append(spark, kept, path, entity, ["file_path", "line_hash"], spans)
    if build_index and (stored or not covered):
        # When all older rows are indexed, only the ranges of this batch need comparing.
        table = store.read_table(spark, path, entity)
        if not covered:
            index.drop_absent(table)
        index.add_missing(table, sorted(spans) if covered and spans is not None else None)
    if (build_index or covered) and not (stored and not build_index):
        index.cover()
    return IngestCounts(
        sum(tally.values()), rejected_count, tally["filtered"], kept_count, stored
    )


def delete_stored(spark: SparkSession, out: str, entity: Entity, ids: DataFrame) -> int:
    """Delete rows by id (one column) from the table, and from its index if there is one."""
    index = _existing_index(spark, out, entity)
    covered = index is not None and index.covers()
    if index is not None:
        index.uncover()
    # The ids may come from the table itself, which is about to change.
    listed_path = work_dir(spark)
    try:
        ids.toDF(entity.key).distinct().write.parquet(listed_path)
        listed = spark.read.parquet(listed_path)
        count = store.delete(spark, table_path(out, entity), entity, listed)
        if index is not None:
            index.remove(listed)
    finally:
        delete_path(spark, listed_path)
    if covered:
        index.cover()
    return count


def update_stored(spark: SparkSession, out: str, entity: Entity, rows: DataFrame) -> int:
    """Replace stored rows by those of equal id; the index, if there is one, follows."""
    index = _existing_index(spark, out, entity)
    covered = index is not None and index.covers()
    if index is not None:
        index.uncover()
    changed_path = work_dir(spark)
    try:
        changed = store.update(spark, table_path(out, entity), entity, rows, changed_path)
        if index is not None:
            index.replace(changed.select(entity.key, *entity.text_fields))
        count = changed.count()
    finally:
        delete_path(spark, changed_path)
    if covered:
        index.cover()
    return count


def read_filtered(spark: SparkSession, out: str, entity: Entity, spec: FilterSpec) -> DataFrame:
    """Stored rows that pass the filter; its time bounds skip id ranges."""
    path = table_path(out, entity)
    rows = store.read_between(spark, path, entity, spec.min_datetime, spec.max_datetime)
    return filters.apply_filter(rows, spec)


def _existing_index(spark: SparkSession, out: str, entity: Entity) -> TextIndex | None:
    path = index_path(out, entity)
    if not path_exists(spark, path):
        return None
    return TextIndex(spark, path, entity.key, entity.text_fields)


def ingest(
    spark: SparkSession,
    out: str,
    comments: str | None = None,
    submissions: str | None = None,
    filters: FilterSpec = FilterSpec(),
    *,
    build_index: bool = False,
    report_rejects: bool = True,
    on_bad_id: str = "reject",
    on_damage: str = "fail",
    index_buckets: int = DEFAULT_BUCKETS,
) -> dict[str, IngestCounts]:
    """Read the given directories of archives into tables under ``out``.

    Both directories are checked and listed before any work starts. Existing
    tables are kept: their rows win over incoming rows with the same id.
    """
    # Lines nobody wants lose their text before large files are dealt out.
    prepare = None if report_rejects else (lambda lines: unparsed_where_unwanted(lines, filters))
    inputs = [
        (entity, read_lines(spark, directory, on_damage, prepare=prepare))
        for entity, directory in ((COMMENT, comments), (SUBMISSION, submissions))
        if directory is not None
    ]
    return {
        entity.name: ingest_lines(
            spark, lines, out, entity, filters,
            build_index=build_index, report_rejects=report_rejects, on_bad_id=on_bad_id,
            index_buckets=index_buckets,
        )
        for entity, lines in inputs
    }


def read_rejects(spark: SparkSession, out: str) -> DataFrame:
    """All refused lines so far: file_path, line, reason, entity, batch."""
    path = f"{out.rstrip('/')}/rejects"
    if not path_exists(spark, path):
        return spark.createDataFrame([], REJECT_DDL + ", entity string, batch string")
    return spark.read.schema(REJECT_DDL + ", entity string, batch string").parquet(path)


def register_views(spark: SparkSession, out: str) -> list[str]:
    """Register the tables under ``out`` as views ``comment`` and ``submission``.

    Each view adds ``created_at`` as a timestamp; comments add
    ``replies_to_submission``, true when the parent is a submission.
    """
    views = []
    for entity in ENTITIES.values():
        if not path_exists(spark, table_path(out, entity)):
            continue
        table = store.read_table(spark, table_path(out, entity), entity)
        table = table.withColumn("created_at", F.timestamp_seconds("created_utc"))
        if entity is COMMENT:
            table = table.withColumn(
                "replies_to_submission", F.coalesce(F.col("parent_type") == 3, F.lit(False))
            )
        table.createOrReplaceTempView(entity.name)
        views.append(entity.name)
    return views
