"""A stored inverted index over the text columns of a table.

Layout under the index path:

* ``postings/buckets=B/batch=N/term_bucket=K``: a row per term, field and document with
  the sorted positions, sorted by term, so that a term reads one bucket and a few pages
  of its files. B goes with the size of the batch, so small batches make few files;
* ``terms/buckets=B/batch=N``: the batch's terms as a sorted dictionary, which tells the
  buckets of a prefix and the number of documents of a term;
* ``bounds/batch=N``: per frequent term and block of documents the largest frequency
  and share of a document, which bound the rank of the block's documents;
* ``docs/batch=N/id_range=R``: doc_id, doc_len; a batch counts once this part is complete;
* ``facts/batch=N``: an empty file whose name tells the size of the batch;
* ``removed/batch=N``: doc_ids whose older postings no longer count, once batch N is
  complete;
* ``replaces/batch=N/M``: empty files: batch N holds what was live of batch M, which no
  longer counts once batch N is complete;
* ``covers_table``: there while the index holds every row of its table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import tokens
from siltstone.operators import grouping, store, term_dictionary
from siltstone.operators.grouping import DOC_BUCKET
from siltstone.operators.term_dictionary import is_prefix
from siltstone.workspace import child_names, delete_path, drop_shuffles, path_exists, touch_path

# The dictionary's coding and the grouping travel with the task, so executors need no copy
# of this package.
cloudpickle.register_pickle_by_value(grouping)
cloudpickle.register_pickle_by_value(term_dictionary)

DEFAULT_BUCKETS = 256
# Documents per bucket of a batch, until there are as many buckets as the index may have.
BUCKET_DOCS = 1024
# Small pages let searches skip documents of a frequent term.
PAGE_ROWS = 2048
# Documents per block, on average, and from how many documents on a term has bounds.
BLOCK_DOCS = 128
BOUNDED_DOCS = 1024
# So many batches of one size are merged into one; batches beyond the last size are not.
MERGE_BATCHES = 4
MERGED_DOCS = 1 << 24
# From how many documents on the shuffle of a batch's postings is worth deleting at once.
DROPPED_DOCS = 1 << 15
# What packed postings take of the bytes that the rows would.
PACKED_SHARE = 0.25
ADVISORY_SETTING = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

_POSTING_DDL = (
    "term string, field string, doc_id bigint, block bigint, first boolean, tf int, "
    "positions array<int>, doc_len int, buckets int, batch int, term_bucket int"
)
_TERM_DDL = term_dictionary.BLOCK_DDL + ", buckets int, batch int"
_BOUND_DDL = "term string, block bigint, field string, most int, densest double, batch int"
_DOC_DDL = "doc_id bigint, doc_len int, batch int, id_range int"
_REMOVED_DDL = "doc_id bigint, batch int"


def tokenized(rows: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    """doc_id, the tokens of each field, and the document length over all fields."""
    cut = rows.select(
        F.col(key).alias("doc_id"), *[tokens(F.col(f)).alias(f"_t_{f}") for f in fields]
    )
    sizes = [F.size(f"_t_{f}") for f in fields]
    return cut.withColumn("doc_len", sum(sizes[1:], sizes[0]))


def postings_of(rows: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    """One row per token occurrence: term, field, doc_id, pos, doc_len. No shuffle."""
    cut = tokenized(rows, key, fields)
    if len(fields) == 1:
        cut = cut.select("doc_id", "doc_len", F.lit(fields[0]).alias("field"),
                         F.col(f"_t_{fields[0]}").alias("tokens"))
    else:
        each = [
            F.struct(F.lit(f).alias("field"), F.col(f"_t_{f}").alias("tokens")) for f in fields
        ]
        cut = cut.select("doc_id", "doc_len", F.inline(F.array(*each)))
    # The outer form keeps Spark from adding a filter on the array's size, which
    # would cut the text a second time.
    return (
        cut.select("doc_id", "doc_len", "field", F.posexplode_outer("tokens").alias("pos", "term"))
        .where("term IS NOT NULL")
        .select("term", "field", "doc_id", "pos", "doc_len")
    )


def entries_of(
    rows: DataFrame, key: str, fields: tuple[str, ...], with_docs: bool = False
) -> DataFrame:
    """One row per term, field and document: term, field, doc_id, first, tf, positions, doc_len.

    ``first`` marks the first field of a document that holds the term, so those rows
    count documents. Grouped within the document's own row: no shuffle. ``with_docs``
    adds a row without a term for each document. Documents are taken many at a time.
    """
    grouper = grouping.grouper(tuple(fields), with_docs)
    return _for_grouping(rows, key, fields).mapInArrow(grouper, grouping.ENTRY_DDL)


def _for_grouping(rows: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    return tokenized(rows, key, fields).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "doc_len",
        *[F.col(f"_t_{f}").alias(f"_t_{n}") for n, f in enumerate(fields)],
    )


def packed_rows(rows: DataFrame, key: str, fields: tuple[str, ...], buckets: int) -> DataFrame:
    """``entries_of`` with documents, in packed runs: term_bucket, packed."""
    packer = grouping.packer(buckets, tuple(fields))
    return _for_grouping(rows, key, fields).mapInArrow(packer, grouping.PACKED_DDL)


def packed_entries(entries: DataFrame, buckets: int) -> DataFrame:
    """Postings (see ``entries_of``) in packed runs."""
    columns = grouping.ENTRY_SCHEMA.names
    return entries.select(*columns).mapInArrow(grouping.packer(buckets), grouping.PACKED_DDL)


@contextmanager
def packed_partitions(spark: SparkSession) -> Iterator[None]:
    """Within it, a partition of packed postings is advised to hold as many rows as one of
    plain rows otherwise would."""
    before = spark.conf.get(ADVISORY_SETTING, None)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get(ADVISORY_SETTING)
    )
    spark.conf.set(ADVISORY_SETTING, str(max(1, int(size * PACKED_SHARE))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ADVISORY_SETTING)
        else:
            spark.conf.set(ADVISORY_SETTING, before)


def docs_of(rows: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    """One row per document: doc_id, doc_len."""
    return tokenized(rows, key, fields).select("doc_id", "doc_len")


def with_changes(
    postings: DataFrame, changed_ids: DataFrame, new_rows: DataFrame, key: str,
    fields: tuple[str, ...],
) -> DataFrame:
    """Postings after deleting ``changed_ids`` (one column) and adding ``new_rows``.

    An update is a changed id with a new row, a delete one without.
    """
    gone = changed_ids.toDF("doc_id")
    kept = postings.join(gone, "doc_id", "left_anti").select(*postings.columns)
    return kept.unionByName(postings_of(new_rows, key, fields).select(*postings.columns))


def term_bucket(term: Column, buckets: Column | int) -> Column:
    buckets = F.lit(buckets) if isinstance(buckets, int) else buckets
    return F.pmod(F.crc32(term.cast("binary")), buckets).cast("int")


def block_bounds() -> list[Column]:
    """Aggregates of a block's postings: largest frequency and largest share of a document."""
    return [F.max("tf").alias("most"), F.max(F.col("tf") / F.col("doc_len")).alias("densest")]


def bounds_of(entries: DataFrame, frequent: DataFrame) -> DataFrame:
    """Per term, block and field of the frequent terms. Small: a row stands for the postings
    of a block.

    Other terms have a block for almost every posting, so they go before any shuffle. There
    is a frequent term for ``BOUNDED_DOCS`` postings at most.
    """
    return (
        entries.join(F.broadcast(frequent), "term", "left_semi")
        .groupBy("term", "block", "field").agg(*block_bounds())
        .select("term", "block", "field", "most", "densest")
    )


@dataclass(frozen=True)
class BatchFacts:
    """What the name of a batch's facts file tells."""

    docs: int
    tokens: int


class TextIndex:
    """Index of ``fields`` of a table keyed by the BIGINT column ``key``.

    One writer at a time. Batches are numbered from the complete ones found on
    disk, so work left by a crashed writer is ignored by readers and overwritten
    by the next writer. Small batches are merged as they come, ``MERGE_BATCHES`` of one
    size at a time, so their number grows with the logarithm of the documents; what a
    merge has replaced is deleted by the next write, for searches that still read it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        fields: tuple[str, ...],
        buckets: int = DEFAULT_BUCKETS,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.fields = tuple(fields)
        self.buckets = buckets

    # --- what is there -----------------------------------------------------------

    def _numbers(self, part: str) -> list[int]:
        names = child_names(self.spark, f"{self.path}/{part}")
        return [int(n.partition("=")[2]) for n in names if n.startswith("batch=")]

    def _complete(self) -> list[int]:
        done = [
            n for n in self._numbers("docs")
            if path_exists(self.spark, f"{self.path}/docs/batch={n}/_SUCCESS")
        ]
        return sorted(done)

    def _last_batch(self) -> int:
        return max(self._complete(), default=-1)

    def _replaced(self, complete: list[int]) -> set[int]:
        """Batches whose content a complete batch holds."""
        by = [n for n in self._numbers("replaces") if n in complete]
        return {
            int(name) for n in by for name in child_names(self.spark, f"{self.path}/replaces/batch={n}")
        }

    def batches(self) -> list[int]:
        """Numbers of the batches that count."""
        complete = self._complete()
        return sorted(set(complete) - self._replaced(complete))

    def _facts(self, batch: int) -> BatchFacts:
        for name in child_names(self.spark, f"{self.path}/facts/batch={batch}"):
            docs, _, length = name.removeprefix("docs-").partition("-tokens-")
            return BatchFacts(int(docs), int(length))
        # A writer that fell between the batch and its facts.
        row = self._read("docs", _DOC_DDL).where(F.col("batch") == batch).agg(
            F.count(F.lit(1)), F.coalesce(F.sum("doc_len"), F.lit(0))
        ).first()
        return BatchFacts(row[0], row[1])

    def _read(self, part: str, ddl: str) -> DataFrame:
        path = f"{self.path}/{part}"
        if not child_names(self.spark, path):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).option("basePath", path).parquet(path)

    def _has_removed(self) -> bool:
        return path_exists(self.spark, f"{self.path}/removed")

    def _live(self, rows: DataFrame) -> DataFrame:
        complete = self._complete()
        alive = sorted(set(complete) - self._replaced(complete))
        rows = rows.where(F.col("batch").isin(alive))
        if not self._has_removed():
            return rows
        removed = self._read("removed", _REMOVED_DDL).where(
            F.col("batch") <= max(complete, default=-1)
        ).groupBy("doc_id").agg(F.max("batch").alias("_removed"))
        dead = (rows["doc_id"] == removed["doc_id"]) & (rows["batch"] < removed["_removed"])
        return rows.join(removed, dead, "left_anti")

    def entries(self, searched: list[str] | None = None) -> DataFrame:
        """Current postings, a row per term, field and document.

        ``searched`` are query tokens, those that end in ``*`` standing for all terms
        they begin: then only the buckets that hold such a term are read. The rows
        still have to be filtered by term.
        """
        rows = self._read("postings", _POSTING_DDL).where(F.col("term_bucket") > DOC_BUCKET)
        if searched is not None:
            rows = rows.where(self._homes(searched))
        return self._live(rows)

    def _homes(self, searched: list[str]) -> Column:
        """Condition on the folders that hold a term of one of the tokens."""
        exact = sorted({t for t in searched if not is_prefix(t)})
        homes = F.col("term_bucket").isin([term_bucket(F.lit(t), F.col("buckets")) for t in exact])
        prefixes = sorted({t for t in searched if is_prefix(t)})
        if not prefixes:
            return homes if exact else F.lit(False)
        # A pair per folder at most, however many terms start with the prefix.
        found = self.lookup(prefixes).select(
            "buckets", "batch", term_bucket(F.col("term"), F.col("buckets")).alias("home")
        ).distinct().collect()
        condition = homes if exact else F.lit(False)
        by_batch: dict[tuple[int, int], list[int]] = {}
        for row in found:
            by_batch.setdefault((row["buckets"], row["batch"]), []).append(row["home"])
        for (buckets, batch), folders in sorted(by_batch.items()):
            condition = condition | (
                (F.col("buckets") == buckets) & (F.col("batch") == batch)
                & F.col("term_bucket").isin(sorted(folders))
            )
        return condition

    def lookup(self, searched: list[str]) -> DataFrame:
        """Dictionary rows of the terms that match: buckets, batch, term, docs, field_docs.

        A row per batch; documents removed since it was written are still counted.
        """
        terms = self._read("terms", _TERM_DDL).where(F.col("batch").isin(self.batches()))
        return term_dictionary.lookup(terms, searched, ["buckets", "batch"])

    def postings(self) -> DataFrame:
        """Current postings, a row per occurrence: term, field, doc_id, pos, doc_len, and
        the folder columns, which let searches prune."""
        return self.entries().select(
            "term", "field", "doc_id", F.explode("positions").alias("pos"), "doc_len",
            "buckets", "batch", "term_bucket",
        )

    def docs(self) -> DataFrame:
        return self._live(self._read("docs", _DOC_DDL))

    def bounds(self, terms: list[str]) -> DataFrame:
        """Bounds of the frequent ones of ``terms``: a row per batch, term, block and field."""
        return self._read("bounds", _BOUND_DDL).where(
            F.col("term").isin(sorted(set(terms))) & F.col("batch").isin(self.batches())
        )

    def corpus(self) -> tuple[int, int]:
        """Number of documents and of their tokens; from the batches' facts where nothing
        was removed."""
        if self._has_removed():
            row = self.docs().agg(F.count(F.lit(1)), F.coalesce(F.sum("doc_len"), F.lit(0))).first()
            return row[0], row[1]
        facts = [self._facts(n) for n in self.batches()]
        return sum(f.docs for f in facts), sum(f.tokens for f in facts)

    def covers(self) -> bool:
        """Whether the index is known to hold every row of its table.

        That is recorded, not counted: see ``uncover``.
        """
        return path_exists(self.spark, f"{self.path}/covers_table")

    def uncover(self) -> None:
        """To be called before the table changes; ``cover`` when the index has followed.

        After a crash in between, the next writer compares the whole table.
        """
        delete_path(self.spark, f"{self.path}/covers_table")

    def cover(self) -> None:
        touch_path(self.spark, f"{self.path}/covers_table")

    # --- writing -------------------------------------------------------------------

    _PARTS = ("docs", "bounds", "facts", "replaces", "removed")
    _BUCKETED = ("postings", "terms")

    def _delete_batch(self, batch: int, parts: tuple[str, ...]) -> None:
        for part in parts:
            delete_path(self.spark, f"{self.path}/{part}/batch={batch}")
        for part in self._BUCKETED:
            for folder in child_names(self.spark, f"{self.path}/{part}"):
                delete_path(self.spark, f"{self.path}/{part}/{folder}/batch={batch}")

    def _begin(self) -> int:
        """The next batch's number, with all that a crashed writer left under it removed,
        and what earlier merges have replaced."""
        complete = self._complete()
        batch = max(complete, default=-1) + 1
        self._delete_batch(batch, self._PARTS)
        replaced = self._replaced(complete)
        for old in sorted(replaced):
            # Older ones first, so that none comes back. What a batch has removed from
            # older batches stays removed.
            self._delete_batch(old, ("docs", "bounds", "facts", "replaces"))
        alive = set(complete) - replaced
        for n in self._numbers("removed"):
            if not any(b < n for b in alive):
                delete_path(self.spark, f"{self.path}/removed/batch={n}")
        if self._has_removed() and not self._numbers("removed"):
            delete_path(self.spark, f"{self.path}/removed")
        return batch

    def _write_removed(self, ids: DataFrame, batch: int) -> None:
        ids.toDF("doc_id").distinct().write.parquet(f"{self.path}/removed/batch={batch}")

    def _write(self, rows: DataFrame, batch: int, replacing: bool = False) -> None:
        """Index rows as a batch, if there are any. Text is cut once.

        A batch that removes documents counts without rows, too.
        """
        size = self._size(rows, self.key)
        if size[0] or replacing:
            packed = partial(packed_rows, rows, self.key, self.fields)
            self._write_entries(packed, size, batch)
            self._merge_small()

    @staticmethod
    def _size(rows: DataFrame, key: str) -> tuple[int, int, int]:
        """Number of documents, least and largest id."""
        return tuple(rows.agg(F.count(F.lit(1)), F.min(key), F.max(key)).first())

    def _write_entries(
        self, packed: Callable[[int], DataFrame], size: tuple[int, int, int], batch: int
    ) -> None:
        """Postings, what is derived from them, then docs, which complete the batch.

        ``packed`` gives them for a number of buckets, with a row without a term for each
        document. ``size`` is the number of documents and their least and largest id.
        """
        n, least, largest = size
        if not n:
            self._write_no_docs(batch)
            return
        buckets = min(self.buckets, 1 << max(0, (n - 1) // BUCKET_DOCS).bit_length())
        ids_per_block = BLOCK_DOCS * ((largest or 0) - (least or 0) + 1) // n
        bits = max(0, ids_per_block.bit_length() - 1)
        path = f"{self.path}/postings/buckets={buckets}/batch={batch}"
        # Rebalancing groups each bucket and lets AQE cut the bucket of a very
        # frequent term into several evenly sized files.
        runs = packed(buckets).hint("rebalance", "term_bucket")
        entries = runs.mapInArrow(grouping.unpacked, grouping.ENTRY_DDL + ", term_bucket int")
        with packed_partitions(runs.sparkSession):
            (
                entries.select(
                    "term", "field", "doc_id", F.shiftright("doc_id", bits).alias("block"), "first",
                    "tf", "positions", "doc_len", "term_bucket",
                )
                .sortWithinPartitions("term_bucket", "term", "field", "doc_id")
                .write.mode("overwrite")
                .option("compression", "zstd")
                .option("parquet.writer.version", "PARQUET_2_0")
                .option("parquet.enable.dictionary#block", "false")
                .option("parquet.page.row.count.limit", PAGE_ROWS)
                .partitionBy("term_bucket")
                .parquet(path)
            )
        written = self.spark.read.schema(_POSTING_DDL.partition(", buckets")[0] + ", term_bucket int").parquet(path)
        real = written.where(F.col("term_bucket") > DOC_BUCKET)
        terms = term_dictionary.blocks_of(real, self.fields)
        terms_path = f"{self.path}/terms/buckets={buckets}/batch={batch}"
        terms.write.mode("overwrite").parquet(terms_path)
        if n >= DROPPED_DOCS:
            # Of the postings; Spark lets go of a step's shuffle a moment after it has ended.
            drop_shuffles(self.spark)
        if n >= BOUNDED_DOCS:
            listed = term_dictionary.lookup(self.spark.read.parquet(terms_path), ["*"], [])
            frequent = listed.where(F.col("docs") >= BOUNDED_DOCS).select("term")
            self._write_bounds(bounds_of(real, frequent), f"{self.path}/bounds/batch={batch}")
        self._write_docs(
            written.where(F.col("term_bucket") == DOC_BUCKET).select("doc_id", "doc_len"), batch
        )
        delete_path(self.spark, f"{path}/term_bucket={DOC_BUCKET}")

    def _write_bounds(self, bounds: DataFrame, path: str) -> None:
        bounds.sortWithinPartitions("term", "block").write.mode("overwrite").parquet(path)

    def _write_docs(self, docs: DataFrame, batch: int) -> None:
        seen = Observation()
        (
            docs.withColumn("id_range", store.id_range(F.col("doc_id")))
            .hint("rebalance", "id_range")
            .sortWithinPartitions("id_range", "doc_id")
            .observe(seen, F.count(F.lit(1)).alias("docs"), F.sum("doc_len").alias("tokens"))
            .write.mode("overwrite")
            .partitionBy("id_range")
            .parquet(f"{self.path}/docs/batch={batch}")
        )
        self._write_facts(batch, seen.get["docs"], seen.get["tokens"])

    def _write_no_docs(self, batch: int) -> None:
        empty = self.spark.createDataFrame([], "doc_id bigint, doc_len int, id_range int")
        empty.write.mode("overwrite").partitionBy("id_range").parquet(f"{self.path}/docs/batch={batch}")
        self._write_facts(batch, 0, 0)

    def _write_facts(self, batch: int, docs: int, length: int) -> None:
        touch_path(self.spark, f"{self.path}/facts/batch={batch}/docs-{docs}-tokens-{length}")

    def _merge_small(self) -> None:
        """Merge batches of about one size, while there are ``MERGE_BATCHES`` of them.

        The merged batch counts when it is complete, and from then on the others do not.
        """
        while True:
            tiers: dict[int, list[int]] = {}
            for n in self.batches():
                docs = self._facts(n).docs
                if 0 < docs <= MERGED_DOCS:
                    tiers.setdefault(docs.bit_length() // 2, []).append(n)
            full = [t for t in sorted(tiers) if len(tiers[t]) >= MERGE_BATCHES]
            if not full:
                return
            # Smaller ones come along: they would only wait for the next merge.
            self._merge([n for t in tiers if t <= full[0] for n in tiers[t]])

    def _merge(self, numbers: list[int]) -> None:
        within = F.col("batch").isin(numbers)
        docs = self.docs().where(within).select("doc_id", "doc_len")
        size = self._size(docs, "doc_id")
        columns = ["term", "field", "doc_id", "first", "tf", "positions", "doc_len"]
        entries = self.entries().where(within).select(*columns).unionByName(
            docs.select("doc_id", "doc_len", F.lit(0).alias("tf"), F.lit(False).alias("first")),
            allowMissingColumns=True,
        )
        complete = self._complete()
        batch = max(complete) + 1
        self._delete_batch(batch, self._PARTS)
        for n in numbers:
            touch_path(self.spark, f"{self.path}/replaces/batch={batch}/{n}")
        self._write_entries(partial(packed_entries, entries), size, batch)

    def add_missing(self, table: DataFrame, ranges: list[int] | None = None) -> None:
        """Index the rows of ``table`` the index does not hold yet.

        ``ranges`` limits the comparison to some id ranges, for callers that know
        the rest is covered.
        """
        docs = self.docs()
        if ranges is not None:
            table = table.where(F.col("id_range").isin(ranges))
            docs = docs.where(F.col("id_range").isin(ranges))
        missing = table.select(self.key, *self.fields)
        if self.batches():
            known = docs.select(F.col("doc_id").alias(self.key))
            missing = missing.join(known, self.key, "left_anti")
        self._write(missing, self._begin())

    def remove(self, ids: DataFrame) -> None:
        """Forget documents; ``ids`` has one column. Counts as a whole or not at all."""
        batch = self._begin()
        self._write_removed(ids, batch)
        self._write_no_docs(batch)

    def replace(self, rows: DataFrame) -> None:
        """Index new versions of documents in place of the old ones, all of them or none."""
        batch = self._begin()
        self._write_removed(rows.select(self.key), batch)
        self._write(rows, batch, replacing=True)

    def drop_absent(self, table: DataFrame) -> None:
        """Forget documents that ``table`` does not have."""
        gone = self.docs().select(F.col("doc_id").alias(self.key)).join(table, self.key, "left_anti")
        if not gone.isEmpty():
            self.remove(gone)

    def compact(self, path: str) -> TextIndex:
        """Write the current content as a fresh single-batch index at ``path``."""
        fresh = TextIndex(self.spark, path, self.key, self.fields, self.buckets)
        docs = self.docs().select("doc_id", "doc_len")
        size = self._size(docs, "doc_id")
        entries = self.entries().select("term", "field", "doc_id", "first", "tf", "positions", "doc_len")
        documents = docs.select("doc_id", "doc_len", F.lit(0).alias("tf"), F.lit(False).alias("first"))
        entries = entries.unionByName(documents, allowMissingColumns=True)
        fresh._write_entries(partial(packed_entries, entries), size, 0)
        return fresh
