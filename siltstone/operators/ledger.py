"""What a table's id ranges hold, told beside the data.

For each id range, which is a folder of the table, an entry has the least and largest
``created_utc`` and points to an exact bitmap of the ids. An entry is an empty file
whose name also has a digest of the data files it was made from. Where that does not
match the files there, since a writer fell in between or something else wrote into the
folder, the entry is not believed: such a range is read, whatever the entry says.

* ``_ledger/id_range=R/<digest>~<least>~<largest>~<version>``: an entry;
* ``_ledger_ids/version=V/id_range=R``: bucket, bits: bitmaps of 32,768 ids each.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.workspace import child_names, delete_path, path_exists, touch_path

_BITMAP_DDL = "bucket bigint, bits binary, id_range int"
TIME = "created_utc"


@dataclass(frozen=True)
class Span:
    """Least and largest time of a range's rows; None where no row has one."""

    least: int | None
    largest: int | None

    def joined(self, other: Span) -> Span:
        def of(choose, a, b):
            given = [x for x in (a, b) if x is not None]
            return choose(given) if given else None

        return Span(of(min, self.least, other.least), of(max, self.largest, other.largest))

    def overlaps(self, low: int | None, high: int | None) -> bool:
        if self.least is None:
            return False  # no row has a time, so none is within bounds
        return (high is None or self.least <= high) and (low is None or self.largest >= low)


def spans_of(rows: DataFrame) -> dict[int, Span]:
    """The span of each ``id_range`` of some rows. A row per range comes to the driver."""
    found = rows.groupBy("id_range").agg(F.min(TIME).alias("a"), F.max(TIME).alias("b"))
    return {r["id_range"]: Span(r["a"], r["b"]) for r in found.collect()}


def bitmaps(ids: DataFrame, key: str) -> DataFrame:
    """bucket, bits, id_range of the ids of some rows; combined before the shuffle."""
    return (
        ids.select("id_range", F.bitmap_bucket_number(key).alias("bucket"),
                   F.bitmap_bit_position(key).alias("bit"))
        .groupBy("id_range", "bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .select("bucket", "bits", "id_range")
    )


def absent(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose id no bitmap of ``known`` has; ``rows`` carry their ``id_range``."""
    columns = rows.columns
    marked = rows.withColumns(
        {"_bucket": F.bitmap_bucket_number(key), "_bit": F.bitmap_bit_position(key)}
    )
    maps = known.select(F.col("id_range"), F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    # The byte that holds the bit, then the bit: null without a bitmap.
    byte = "cast(conv(hex(substr(_bits, cast(_bit div 8 AS int) + 1, 1)), 16, 10) AS int)"
    held = F.expr(f"coalesce(shiftright({byte}, cast(_bit % 8 AS int)) % 2 = 1, false)")
    return marked.join(maps, ["id_range", "_bucket"], "left").where(~held).select(*columns)


class Ledger:
    """Entries of the table at ``path``. One writer at a time, like the table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def ranges(self) -> set[int]:
        """Id ranges the table has."""
        names = child_names(self.spark, self.path)
        return {int(n.partition("=")[2]) for n in names if n.startswith("id_range=")}

    def _digest(self, number: int) -> str:
        """Digest of the names of a range's data files; empty when there are none."""
        names = [
            n for n in child_names(self.spark, f"{self.path}/id_range={number}")
            if not n.startswith(("_", "."))
        ]
        return hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()[:32] if names else ""

    def _entry(self, number: int) -> tuple[Span, str] | None:
        """Span and bitmap version of a range, if its entry is to be believed."""
        names = child_names(self.spark, f"{self.path}/_ledger/id_range={number}")
        digest = self._digest(number) if names else ""
        for name in names:
            made_from, least, largest, version = name.split("~")
            if made_from == digest:
                return Span(*(None if x == "none" else int(x) for x in (least, largest))), version
        return None

    def believed(self, ranges: Iterable[int]) -> dict[int, tuple[Span, str]]:
        found = {n: self._entry(n) for n in sorted(ranges)}
        return {n: entry for n, entry in found.items() if entry is not None}

    def known_ids(self, entries: dict[int, tuple[Span, str]]) -> DataFrame:
        """Bitmaps of some believed ranges."""
        base = f"{self.path}/_ledger_ids"
        paths = [f"{base}/version={version}/id_range={n}" for n, (_, version) in sorted(entries.items())]
        # A range whose rows were all deleted has an entry and no bitmap.
        paths = [p for p in paths if path_exists(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], _BITMAP_DDL)
        return (
            self.spark.read.schema(_BITMAP_DDL + ", version string")
            .option("basePath", base).parquet(*paths).select("bucket", "bits", "id_range")
        )

    def write_ids(self, maps: DataFrame) -> str:
        """Write bitmaps as a new version, which counts when entries name it."""
        version = uuid.uuid4().hex
        (
            maps.groupBy("id_range", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
            .hint("rebalance", "id_range")
            .sortWithinPartitions("id_range", "bucket")
            .write.partitionBy("id_range").parquet(f"{self.path}/_ledger_ids/version={version}")
        )
        return version

    def record(self, spans: dict[int, Span], version: str) -> None:
        """Put entries for ranges as their files are now, and drop what they replace."""
        for number, span in sorted(spans.items()):
            folder = f"{self.path}/_ledger/id_range={number}"
            old = child_names(self.spark, folder)
            least, largest = ("none" if x is None else x for x in (span.least, span.largest))
            name = f"{self._digest(number)}~{least}~{largest}~{version}"
            touch_path(self.spark, f"{folder}/{name}")
            for other in old:
                if other != name:
                    delete_path(self.spark, f"{folder}/{other}")
                    version_path = f"{self.path}/_ledger_ids/version={other.split('~')[3]}"
                    delete_path(self.spark, f"{version_path}/id_range={number}")
                    if not [n for n in child_names(self.spark, version_path) if n.startswith("id_range=")]:
                        delete_path(self.spark, version_path)

    def within(self, low: int | None, high: int | None) -> list[int] | None:
        """Ranges that may hold a row between two times, or None when all may."""
        present = self.ranges()
        entries = self.believed(present)
        kept = [n for n in sorted(present) if n not in entries or entries[n][0].overlaps(low, high)]
        return None if len(kept) == len(present) else kept
