"""Directories of compressed JSON lines as DataFrames of raw lines.

Every reader returns (file_path, value, error): one row per line, or a row with
``error`` set for a file that was skipped or found damaged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sources import blocks, decoders
from siltstone.workspace import hadoop_path

# The decoders travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(decoders)
cloudpickle.register_pickle_by_value(blocks)

# Accepted file extensions, compared case-sensitively.
SPARK_CODECS = ("gz", "bz2")
TASK_CODECS = ("xz", "zst")
UNSPLITTABLE = ("gz", "xz", "zst")

LINE_DDL = "file_path string, value string, error string"
_BINARY_DDL = "file_path string, value binary, error string"

# Text grows by about this factor when decompressed; only used to size partitions.
EXPANSION = 8
SPREAD_BYTES = 128 << 20
MOST_PER_CORE = 4
# Compressed bytes of a part of an xz or zst file; larger where there would be too many
# parts for the driver to list.
PART_BYTES = SPREAD_BYTES // EXPANSION
MOST_PARTS = 1 << 18
# A round is cut into so many parts per core, if they are no smaller than this.
ROUND_PARTS_PER_CORE = 2
LEAST_PART_BYTES = 256 << 10


@dataclass(frozen=True)
class ArchiveFile:
    path: str
    extension: str
    size: int


def list_archives(spark: SparkSession, directory: str) -> list[ArchiveFile]:
    """Files directly inside ``directory``, with extension and size.

    Raises ValueError when the path is missing or is not a directory. This is
    the only part of a read that runs on the driver, over file names alone.
    """
    fs, jpath = hadoop_path(spark, directory)
    if not fs.exists(jpath) or not fs.getFileStatus(jpath).isDirectory():
        raise ValueError(f"no such directory: {directory}")
    files = []
    for status in fs.listStatus(jpath):
        if status.isFile():
            name = status.getPath().getName()
            stem, _, extension = name.rpartition(".")
            files.append(
                ArchiveFile(
                    status.getPath().toString(), extension if stem else "", status.getLen()
                )
            )
    return sorted(files, key=lambda f: f.path)


def _check_mode(on_damage: str) -> bool:
    if on_damage not in ("fail", "keep"):
        raise ValueError("on_damage is 'fail' or 'keep'")
    return on_damage == "fail"


def spark_text(reader):
    """Options for gz and bz2 on a batch or streaming reader.

    Damaged content and files that vanish after listing fail the job: Spark could
    pass over them, but not report them. Lines end at a newline only.
    """
    return (
        reader.format("text")
        .option("lineSep", "\n")
        .option("ignoreMissingFiles", "false")
        .option("ignoreCorruptFiles", "false")
    )


def text_lines(loaded: DataFrame) -> DataFrame:
    return loaded.select(
        F.col("_metadata.file_path").alias("file_path"),
        "value",
        F.lit(None).cast("string").alias("error"),
    )


def task_lines(paths: DataFrame, on_damage: str) -> DataFrame:
    """Lines of the files at ``paths``, a frame of which only the column path is read.

    Read in tasks, which report damage and files that cannot be opened.
    """
    require_decoders()
    read = decoders.line_reader(_check_mode(on_damage))
    return (
        paths.select("path")
        .mapInArrow(read, _BINARY_DDL)
        .select("file_path", F.col("value").cast("string").alias("value"), "error")
    )


def _unopenable(spark: SparkSession, files: list[ArchiveFile]) -> list[tuple[str, None, str]]:
    """Error rows of the gz and bz2 files that cannot be opened, at most one per file."""
    if not files:
        return []
    paths = spark.read.format("binaryFile").load([f.path for f in files]).select("path")
    found = paths.mapInArrow(decoders.open_check, _BINARY_DDL).select("file_path", "error")
    return [(r["file_path"], None, r["error"]) for r in found.collect()]


def require_decoders() -> None:
    """Fail before the job starts, not file by file, where a decoder is missing.

    Executors have what the driver has; if one has not, its tasks fail.
    """
    import zstandard  # noqa: F401


def hidden(path: str) -> bool:
    """Whether Spark's readers pass over a file for its name."""
    return path.rpartition("/")[2].startswith(("_", "."))


def spread_partitions(files: list[ArchiveFile], parallelism: int) -> int | None:
    """Number of partitions to spread unsplittable files over, or None to leave them.

    A gz, xz or zst file is one task. When the largest such file is much more
    than an even share of the bytes, parsing would wait for it.
    """
    sizes = [f.size for f in files]
    if not sizes or max(sizes) < SPREAD_BYTES // EXPANSION:
        return None
    if max(sizes) * parallelism <= 2 * sum(sizes):
        return None
    wanted = sum(sizes) * EXPANSION // SPREAD_BYTES
    # Lines stream through, so a few partitions per core do for any amount.
    return max(parallelism, min(wanted, MOST_PER_CORE * parallelism))


def spread(lines: DataFrame, partitions: int) -> DataFrame:
    """Deal lines evenly over partitions.

    The row's position is the key: a scan gives the same positions when a task
    is run again, and equal lines do not pile up as they would by content hash.
    """
    return (
        lines.withColumn("_position", F.monotonically_increasing_id())
        .repartition(partitions, "_position")
        .drop("_position")
    )


def unread_files(files: list[ArchiveFile]) -> list[tuple[str, None, str]]:
    """Error rows of the files that no reader takes."""
    return [
        (f.path, None, "unknown file extension")
        for f in files
        if f.extension not in SPARK_CODECS + TASK_CODECS
    ]


def list_parts(
    spark: SparkSession, files: list[ArchiveFile], part_bytes: int | None = None
) -> list[blocks.Part]:
    """The parts of the xz and zst files among ``files`` that have several, by path and place.

    Looked up in tasks: an xz file's index is at its end, a zst file without a seek table
    is read through, but not decoded.
    """
    least = PART_BYTES if part_bytes is None else part_bytes
    large = [f for f in files if f.extension in TASK_CODECS and f.size > least]
    if not large:
        return []
    least = max(least, sum(f.size for f in large) // MOST_PARTS)
    paths = spark.createDataFrame([(f.path,) for f in large], "path string").repartition(
        min(len(large), MOST_PER_CORE * spark.sparkContext.defaultParallelism)
    )
    rows = paths.mapInArrow(blocks.part_lister(least), blocks.PART_DDL).where(
        F.col("start") != blocks.WHOLE
    )
    return sorted(blocks.Part(*r) for r in rows.collect())


def part_lines(spark: SparkSession, parts: list[blocks.Part]) -> DataFrame:
    """Lines of some parts, at most a few parts to a task."""
    most = MOST_PER_CORE * spark.sparkContext.defaultParallelism
    frame = spark.createDataFrame([tuple(p) for p in parts], blocks.PART_DDL)
    # By position: the parts of one file must not fall into one task by chance.
    dealt = spread(frame.coalesce(1), min(len(parts), most))
    return dealt.mapInArrow(blocks.part_reader, _BINARY_DDL).select(
        "file_path", F.col("value").cast("string").alias("value"), "error"
    )


def read_files(
    spark: SparkSession,
    files: list[ArchiveFile],
    on_damage: str = "fail",
    spread_over: int | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    parts: list[blocks.Part] | None = None,
    errors: list[tuple[str, None, str]] = (),
    part_bytes: int | None = None,
) -> DataFrame:
    """All lines of some archives with known extensions, as ``read_lines`` gives them.

    ``parts`` are read besides; by default those of the large files among ``files``.
    ``errors`` are rows to be added.
    """
    fail = _check_mode(on_damage)
    prepare = prepare or (lambda lines: lines)
    errors = list(errors)
    # Spark hides some names, and cannot report damage or files that vanish; tasks
    # read those by path.
    by_path = {f for f in files if hidden(f.path) or not fail}
    by_spark = [f for f in files if f.extension in SPARK_CODECS and f not in by_path]
    by_task = [f for f in files if f.extension in TASK_CODECS and f not in by_path]
    if by_task or parts:
        require_decoders()
    if parts is None:
        parts = list_parts(spark, by_task, part_bytes)
        in_parts = {p.path for p in parts}
        by_task = [f for f in by_task if f.path not in in_parts]
        files = [f for f in files if f.path not in in_parts]
    bad = _unopenable(spark, by_spark)
    errors += bad
    skipped = {path for path, _, _ in bad}
    by_spark = [f for f in by_spark if f.path not in skipped]

    whole, split = [], []
    if found := [f.path for f in by_spark if f.extension == "gz"]:
        whole.append(text_lines(spark_text(spark.read).load(found)))
    if by_task:
        paths = spark.read.format("binaryFile").load([f.path for f in by_task]).select("path")
        # Spark packs up to 128 MB of files into a task, eight times that as text.
        most = MOST_PER_CORE * spark.sparkContext.defaultParallelism
        tasks = min(len(by_task), max(most, sum(f.size for f in by_task) // PART_BYTES))
        # By range: dealt round robin, some tasks would have several files and others none.
        whole.append(task_lines(paths.repartitionByRange(tasks, "path"), on_damage))
    if by_path:
        paths = spark.createDataFrame([(f.path,) for f in sorted(by_path, key=lambda f: f.path)], "path string")
        tasks = min(len(by_path), MOST_PER_CORE * spark.sparkContext.defaultParallelism)
        whole.append(task_lines(paths.repartition(tasks), on_damage))
    if found := [f.path for f in by_spark if f.extension == "bz2"]:
        split.append(text_lines(spark_text(spark.read).load(found)))
    if parts:
        split.append(part_lines(spark, parts))

    partitions = spread_over or spread_partitions(
        [f for f in files if f.extension in UNSPLITTABLE], spark.sparkContext.defaultParallelism
    )
    if whole and partitions:
        whole = [spread(prepare(reduce(DataFrame.unionAll, whole)), partitions)]
    else:
        whole = [prepare(frame) for frame in whole]
    frames = whole + [prepare(frame) for frame in split]
    if errors or not frames:
        frames.append(spark.createDataFrame(errors, LINE_DDL))
    return reduce(DataFrame.unionAll, frames)


def known_files(files: list[ArchiveFile]) -> list[ArchiveFile]:
    return [f for f in files if f.extension in SPARK_CODECS + TASK_CODECS]


def read_lines(
    spark: SparkSession,
    directory: str,
    on_damage: str = "fail",
    spread_over: int | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    part_bytes: int | None = None,
) -> DataFrame:
    """All lines of the gz, bz2, xz and zst files directly inside ``directory``.

    Files with another extension and files that cannot be opened become error
    rows. Damage fails the job, or with ``on_damage="keep"`` ends its file with an
    error row after the lines before it. Large xz and zst files of several blocks or
    frames are read in parts of ``part_bytes`` compressed bytes (``PART_BYTES`` by default)
    where damage fails the job; otherwise a file is one task.
    ``spread_over`` forces the number of partitions that the lines of files read as a
    whole are dealt over; by default it is decided from the file sizes. ``prepare`` is
    applied to lines before they are dealt out.
    """
    _check_mode(on_damage)
    files = list_archives(spark, directory)
    return read_files(
        spark, known_files(files), on_damage, spread_over, prepare, errors=unread_files(files),
        part_bytes=part_bytes,
    )


def rounds(
    spark: SparkSession, files: list[ArchiveFile], on_damage: str, most_bytes: int | None,
    part_bytes: int | None = None,
) -> list[tuple[list[ArchiveFile], list[blocks.Part]]]:
    """Files, and parts of large ones, in turns of about ``most_bytes`` compressed bytes.

    By path and place, so the same files give the same rounds. A file of one block is
    never cut; larger ones into parts that are no larger than a round, and small enough
    for the parts of a round to keep all cores at work.
    """
    whole = sorted(files, key=lambda f: f.path)
    if most_bytes is None:
        return [(whole, None)]
    fail = _check_mode(on_damage)
    even = most_bytes // (ROUND_PARTS_PER_CORE * spark.sparkContext.defaultParallelism)
    part_bytes = min(
        most_bytes, max(even, LEAST_PART_BYTES), PART_BYTES if part_bytes is None else part_bytes
    )
    parts = list_parts(spark, [f for f in whole if fail and not hidden(f.path)], part_bytes)
    by_path: dict[str, list[blocks.Part]] = {}
    for part in parts:
        by_path.setdefault(part.path, []).append(part)
    out, size = [([], [])], 0
    for file in whole:
        for piece in by_path.get(file.path, [file]):
            if size and size + piece.size > most_bytes:
                out.append(([], []))
                size = 0
            out[-1][isinstance(piece, blocks.Part)].append(piece)
            size += piece.size
    return out
