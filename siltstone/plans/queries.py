"""Every operator as a query over the test tables, keyed by name.

The tables hold no archives, so queries shape their rows into archive lines,
filter records or text documents first; see ``samples``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import coerce, ids
from siltstone.functions.text import highlight, query_tokens, tokens
from siltstone.operators import filters, normalize, store, text_index, text_search
from siltstone.operators.filters import FilterSpec
from siltstone.plans import ingest as jobs
from siltstone.plans import samples
from siltstone.plans.samples import event_records, document_records, table
from siltstone.schema import (
    COMMENT,
    DISTINGUISHED,
    POST_HINTS,
    REMOVED_BY,
    SUBMISSION,
    SUBREDDIT_TYPES,
    SUGGESTED_SORTS,
)
from siltstone.sources.archives import list_archives, read_lines
from siltstone.streaming.incremental import start_ingest
from siltstone.workspace import child_names, rename_path, work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- Filters ---------------------------------------------------------------


@query
def filter_composite(spark, sf):
    spec = FilterSpec(
        users={"src1", "src2", "src3"}, subreddits={"fr", "es"}, min_score=0, max_score=0,
        min_datetime=500, max_datetime=6000,
    )
    return filters.apply_filter(document_records(spark, sf), spec)


@query
def filter_score_null_passes(spark, sf):
    kept = filters.apply_filter(document_records(spark, sf), FilterSpec(min_score=1, max_score=1))
    return kept.select("doc_id", "score")


@query
def filter_inverted_bounds(spark, sf):
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        spec = FilterSpec(min_score=1, max_score=0)
    return filters.apply_filter(document_records(spark, sf), spec).select("doc_id", "score")


@query
def filter_inverted_warns(spark, sf):
    import warnings

    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        dates = FilterSpec(min_datetime=2_000_000_000, max_datetime=0)
        scores = FilterSpec(min_score=1, max_score=0)
    late = filters.apply_filter(event_records(spark, sf), dates).select(F.lit("datetime").alias("bounds"))
    unscored = filters.apply_filter(document_records(spark, sf), scores).select(F.lit("score"))
    return late.unionAll(unscored).groupBy("bounds").agg(F.count(F.lit(1)).alias("kept")).withColumn(
        "warned", F.lit(len(told))
    )


@query
def filter_datetime_range(spark, sf):
    spec = FilterSpec(min_datetime="2024-01-10-00:00:00", max_datetime="2024-01-20-12:30:00")
    return filters.apply_filter(event_records(spark, sf), spec)


@query
def filter_user_or_group(spark, sf):
    spec = FilterSpec(users={"8", "46", "101"}, subreddits={"error"})
    return filters.apply_filter(event_records(spark, sf), spec)


@query
def filter_user_only(spark, sf):
    return filters.apply_filter(event_records(spark, sf), FilterSpec(users={"8", "46", "101"}))


@query
def filter_group_only(spark, sf):
    # Case-sensitive: "Click" matches nothing.
    return filters.apply_filter(event_records(spark, sf), FilterSpec(subreddits={"view", "Click"}))


@query
def filter_empty_sets(spark, sf):
    return filters.apply_filter(event_records(spark, sf), FilterSpec())


@query
def filter_large_list(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    suppliers = table(spark, sf, "supplier").where("s_acctbal < 0").select("s_suppkey")
    parts = table(spark, sf, "part").where("p_brand = 'Brand#2'").select("p_partkey")
    return filters.keep_listed(items, suppliers, parts, "l_suppkey", "l_partkey")


@query
def filter_datetime_argument(spark, sf):
    ts = F.col("ts").cast("timestamp")
    text = F.when(F.col("event_id") % 5 == 0, F.date_format(ts, "yyyy/MM/dd HH:mm:ss")).otherwise(
        F.date_format(ts, "yyyy-MM-dd-HH:mm:ss")
    )
    return table(spark, sf, "events").select(
        "event_id", filters.parse_datetime_column(text).alias("epoch")
    )


# --- Lines, coercions, ids -------------------------------------------------


def _parse(df: DataFrame, keep: list[str], line: str, keys: list[str]) -> DataFrame:
    """Columns ``keep``, then for each key its VARIANT ``v_`` and type name ``k_``."""
    return (
        df.selectExpr(*keep, f"{line} AS _line")
        .selectExpr(*keep, "_line", f"{normalize.parse_pair('_line', keys)} AS _pair")
        .selectExpr(*keep, f"{normalize.whole_object('_pair', '_line')} AS _doc")
        .selectExpr(
            *keep,
            "_doc IS NOT NULL AS is_object",
            *[f"_doc.{k} AS v_{k}" for k in keys],
            *[f"schema_of_variant(_doc.{k}) AS k_{k}" for k in keys],
        )
    )


def _variants(key: str, *texts: str) -> str:
    """One of ``texts`` per row, chosen by the key's remainder."""
    arms = " ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(texts))
    return f"CASE {key} % {len(texts)} {arms} END"


@query
def trim_json_line(spark, sf):
    junk = _variants(
        "event_id",
        "props",
        r"concat('\uFEFF', props)",
        r"concat('\0[', props, '],')",
        r"concat(' ', props, '\r')",
    )
    events = table(spark, sf, "events").selectExpr("event_id", f"{junk} AS junk")
    parsed = _parse(events, ["event_id"], normalize.trim_line("junk"), ["k"])
    return parsed.selectExpr("event_id", f"{coerce.integer('v_k', 'k_k', 'int64')} AS k")


@query
def line_guard(spark, sf):
    line = _variants(
        "event_id",
        "props",
        "concat(props, props)",
        "concat(props, ',', props)",
        "concat(props, ' x}')",
        "concat(props, '] {}')",
        "replace(props, '}', '')",
        """replace(props, '"', "'")""",
    )
    parsed = _parse(table(spark, sf, "events"), ["event_id"], line, ["k"])
    return parsed.select("event_id", "is_object")


@query
def repeated_key(spark, sf):
    line = _variants(
        "event_id",
        "props",
        """replace(props, '}', ', "k": 1}')""",
        """replace(props, '}', ', "z": 1, "z": 2}')""",
    )
    keys = table(spark, sf, "events").selectExpr("event_id", f"json_object_keys({line}) AS keys")
    return keys.selectExpr("event_id", f"{normalize.repeats_a_key('keys', ['k'])} AS repeats")


def _coerced(spark, sf, *texts: str) -> DataFrame:
    """event_id, then ``v_x`` and ``k_x`` of {"x": one of texts}.

    In the texts, S stands for the event's epoch seconds.
    """
    events = table(spark, sf, "events").selectExpr(
        "event_id", "cast(unix_seconds(cast(ts AS timestamp)) AS string) AS s"
    )
    spelled = [f"""replace('{{"x": {text}}}', 'S', s)""" for text in texts]
    return _parse(events, ["event_id"], _variants("event_id", *spelled), ["x"])


@query
def coerce_time(spark, sf):
    rows = _coerced(spark, sf, "S", "S.5", '"S"', '" S "', "true", "-S.5", "null")
    return rows.selectExpr("event_id", f"{coerce.time('v_x', 'k_x')} AS value")


@query
def coerce_optional_time(spark, sf):
    rows = _coerced(spark, sf, "S", "S.4", '"+S"', "null", "false", "[1]")
    return rows.selectExpr("*", f"{coerce.time('v_x', 'k_x')} AS value").selectExpr(
        "event_id", "value", "value IS NOT NULL OR k_x IN ('VOID', 'BOOLEAN') AS fits"
    )


@query
def coerce_score(spark, sf):
    rows = _coerced(spark, sf, "-S", '"-S"', "S.0", "null", "true")
    return rows.selectExpr("*", f"{coerce.score('v_x', 'k_x')} AS value").selectExpr(
        "event_id", "value", "value IS NOT NULL OR k_x = 'VOID' AS fits"
    )


@query
def coerce_integer_range(spark, sf):
    rows = _coerced(spark, sf, "S", "S00", '"S"', "S.0", "-S")
    widths = ("int32", "uint32", "int64")
    return rows.selectExpr(
        "event_id", *[f"{coerce.integer('v_x', 'k_x', w)} AS as_{w}" for w in widths]
    )


@query
def default_false_bool(spark, sf):
    lines = [f"""'{{"x": {text}}}'""" for text in ("true", "false", "null", "1")]
    lines.append("""'{"y": true}'""")
    events = table(spark, sf, "events")
    rows = _parse(events, ["event_id"], _variants("event_id", *lines), ["x"])
    return rows.selectExpr("*", f"{coerce.boolean('v_x', 'k_x')} AS b").selectExpr(
        "event_id", "coalesce(b, false) AS value", "v_x IS NULL OR b IS NOT NULL AS fits"
    )


@query
def refid_parse(spark, sf):
    key = ids.base36_encode("(o_orderkey * 1000003 + 7)")
    text = f"concat(if(o_orderkey % 7 = 6, 'xt', 't'), o_orderkey % 10, '_', {key})"
    orders = table(spark, sf, "orders").selectExpr("o_orderkey", f"{text} AS ref")
    return orders.selectExpr("o_orderkey", f"{ids.ref_from_text('ref')} AS r").select(
        "o_orderkey", "r.*"
    )


@query
def refid_from_int(spark, sf):
    ref = ids.ref_from_int("(o_orderkey * 1000003 + 45000000000)")
    return table(spark, sf, "orders").selectExpr("o_orderkey", f"{ref} AS r").select(
        "o_orderkey", "r.*"
    )


@query
def base36_decode(spark, sf):
    spelled = _variants(
        "o_orderkey", "t", "upper(t)", "concat('000', t)", "concat('-', t)", "concat(t, '!@#')",
        "concat(t, t)", "''",
    )
    text = ids.base36_encode("(o_orderkey + 45000000000)")
    return (
        table(spark, sf, "orders")
        .selectExpr("o_orderkey", f"{text} AS t")
        .selectExpr("o_orderkey", f"{spelled} AS spelled")
        .selectExpr("o_orderkey", f"{ids.base36_decode('spelled')} AS decoded")
    )


@query
def enum_canon(spark, sf):
    words = "gallery hosted:video image link rich:video self video Image unknown".split()
    spelled = _variants("o_orderkey", *[f"'{w}'" for w in words])
    orders = table(spark, sf, "orders").selectExpr("o_orderkey", f"{spelled} AS spelled")
    return orders.selectExpr("o_orderkey", f"{coerce.canonical('spelled', POST_HINTS)} AS stored")


# Spellings as the archives may have them, right and wrong, next to the map that judges them.
_SPELLINGS = {
    "subreddit_type": (
        SUBREDDIT_TYPES,
        "public restricted user archived gold_restricted gold_only private employees_only Public gold",
    ),
    "distinguished": (DISTINGUISHED, "admin moderator special user Admin"),
    "suggested_sort": (SUGGESTED_SORTS, "confidence controversial live new old qa random top best"),
    "removed_by_category": (
        REMOVED_BY,
        "author automod_filtered content_takedown deleted moderator reddit anti_evil_ops "
        "community_ops copyright_takedown admin",
    ),
}


@query
def enum_others(spark, sf):
    orders = table(spark, sf, "orders")
    parts = []
    for key, (values, words) in _SPELLINGS.items():
        spelled = _variants("o_orderkey", *[f"'{w}'" for w in words.split()])
        rows = orders.selectExpr("o_orderkey", f"{spelled} AS spelled")
        parts.append(rows.selectExpr(
            "o_orderkey", f"'{key}' AS key", "spelled", f"{coerce.canonical('spelled', values)} AS stored"
        ))
    return reduce(DataFrame.unionAll, parts)


@query
def uuid_bytes(spark, sf):
    dashed = "regexp_replace(d, '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '$1-$2-$3-$4-$5')"
    spelled = _variants(
        "o_orderkey", dashed, "upper(d)", f"concat('{{', {dashed}, '}}')",
        f"concat('urn:uuid:', {dashed})", f"replace({dashed}, '-', ':')", "''",
    )
    return (
        table(spark, sf, "orders")
        .selectExpr("o_orderkey", "md5(cast(cast(o_orderkey AS string) AS binary)) AS d")
        .selectExpr("o_orderkey", f"{spelled} AS spelled")
        .selectExpr("o_orderkey", f"lower(hex({ids.uuid_bytes('spelled')})) AS uuid_hex")
    )


# --- Records and rejects ---------------------------------------------------


@query
def comment_normalize(spark, sf):
    lines = samples.conversation_lines(spark, sf)
    return normalize.records(normalize.normalize(lines, COMMENT), COMMENT)


@query
def submission_normalize(spark, sf):
    lines = samples.document_lines(spark, sf)
    rows = normalize.records(normalize.normalize(lines, SUBMISSION), SUBMISSION)
    return rows.withColumn(
        "link_flair_template_id", F.lower(F.hex("link_flair_template_id"))
    ).withColumn("author_flair_template_id", F.lower(F.hex("author_flair_template_id")))


# The number in each event's props, which picks a variant.
NUMBER = r"""cast(regexp_extract(value, r'k\W+: ([0-9]+)', 1) AS int) AS number"""


def _broken_lines(spark, sf) -> DataFrame:
    """Event lines, most of them broken in one of several ways."""
    broken = _variants(
        "number",
        "value",
        """regexp_replace(value, '"author":"[0-9]+",', '')""",
        """regexp_replace(value, '"score":-?[0-9]+', '"score":1.5')""",
        """replace(value, '"created_utc":', '"created_utc":"x","created":')""",
        """replace(value, '"link_id":"t3_', '"link_id":"tt_')""",
        """replace(value, '"edited":false', '"stickied":null,"edited":null')""",
        """regexp_replace(value, '}$', '')""",
        """concat('{"a":1}', value)""",
        """replace(value, '"edited":false', '"edited":false,"edited":false')""",
        """regexp_replace(value, '"id":"[0-9a-z]+"', '"id":"invalid!@#"')""",
    )
    lines = samples.event_lines(spark, sf).selectExpr("*", NUMBER)
    return lines.selectExpr("file_path", f"{broken} AS value", "error")


@query
def rejects_by_reason(spark, sf):
    judged = jobs.judged(_broken_lines(spark, sf), COMMENT)
    return judged.groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n"))


# --- Tables ----------------------------------------------------------------


@query
def keep_first(spark, sf):
    docs = samples.dealt(table(spark, sf, "documents"))
    digests = docs.select("doc_id", "source", "lang", F.sha2("text", 256).alias("digest"))
    return store.keep_first(digests, "digest", ["doc_id"]).drop("digest")


@query
def insert_if_absent(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    existing = orders.where("o_orderstatus in ('F', 'O')")
    incoming = orders.where("o_orderstatus in ('O', 'P')").withColumn("o_totalprice", F.lit(-1.0))
    twice = incoming.unionAll(incoming)
    fresh = store.insert_if_absent(existing, twice, "o_orderkey", ["o_totalprice"])
    return existing.unionByName(fresh)


def _conversation_table(spark, sf, times: int = 1, out: str | None = None) -> DataFrame:
    out = out or work_dir(spark)
    for _ in range(times):
        jobs.ingest_lines(spark, samples.conversation_lines(spark, sf), out, COMMENT)
    return store.read_table(spark, jobs.table_path(out, COMMENT), COMMENT)


@query
def insert_twice(spark, sf):
    stored = _conversation_table(spark, sf, times=2)
    return stored.select("decoded_reddit_id", "reddit_id", "author", "body", "created_utc")


@query
def key_is_decoded(spark, sf):
    out = work_dir(spark)
    lines = samples.conversation_lines(spark, sf)
    jobs.ingest_lines(spark, lines, out, COMMENT)
    found = r"""regexp_extract(value, '"id":"([0-9a-z]+)"', 1)"""
    for spelled in (f"upper({found})", f"concat('00', {found})"):
        again = f"""replace(replace(value, concat('"id":"', {found}), concat('"id":"', {spelled})),
            '"body":"', '"body":"again ')"""
        jobs.ingest_lines(spark, lines.selectExpr("file_path", f"{again} AS value", "error"), out, COMMENT)
    return _stored_comments(spark, out).select("decoded_reddit_id", "reddit_id", "body")


@query
def point_lookup(spark, sf):
    found = store.lookup(_conversation_table(spark, sf), 45000007001)
    return found.select("decoded_reddit_id", "reddit_id", "author", "body", "parent_type")


@query
def table_count(spark, sf):
    return store.row_count(_conversation_table(spark, sf))


@query
def sql_over_views(spark, sf):
    out = work_dir(spark)
    _conversation_table(spark, sf, out=out)
    jobs.register_views(spark, out)
    return spark.sql(
        """
        SELECT author, replies_to_submission, count(*) AS n, max(unix_seconds(created_at)) AS latest,
               sum(CAST(stickied AS INT)) AS stickied
        FROM comment GROUP BY author, replies_to_submission
        """
    )


@query
def parent_join(spark, sf):
    lines = samples.conversation_lines(spark, sf)
    rows = normalize.records(normalize.normalize(lines, COMMENT), COMMENT)
    replies = rows.where("parent_type = 1").select(
        F.col("decoded_reddit_id").alias("child"), F.col("decoded_parent_id").alias("parent")
    )
    parents = rows.select(
        F.col("decoded_reddit_id").alias("parent"), F.col("author").alias("parent_author")
    )
    return replies.join(parents, "parent")


# --- Sources and jobs ------------------------------------------------------


def _round_trip(spark, sf, *codecs: str) -> DataFrame:
    """Events written as archives and read back, with what was on each line."""
    directory = work_dir(spark)
    lines = samples.event_lines(spark, sf).select("value")
    for codec in codecs:
        samples.write_archives(lines, directory, codec)
    read = read_lines(spark, directory).where("error is null")
    rows = normalize.normalize(read, COMMENT)
    return rows.where("reason is null").select(
        "decoded_reddit_id", "author", "subreddit", "body", "score", "created_utc"
    )


@query
def source_gzip(spark, sf):
    return _round_trip(spark, sf, "gzip")


@query
def source_bzip2(spark, sf):
    return _round_trip(spark, sf, "bzip2")


@query
def source_xz(spark, sf):
    return _round_trip(spark, sf, "xz")


@query
def source_zstd(spark, sf):
    return _round_trip(spark, sf, "zstd")


def _split_trip(spark, sf, codec: str) -> DataFrame:
    """Events in archives of many small blocks, read in parts, a few blocks each."""
    directory = work_dir(spark)
    samples.write_archives(samples.event_lines(spark, sf), directory, codec, block_bytes=50_000)
    read = read_lines(spark, directory, part_bytes=8_000).where("error is null")
    return normalize.normalize(read, COMMENT).where("reason is null").select(
        "decoded_reddit_id", "author", "subreddit", "body", "score", "created_utc"
    )


@query
def source_split_xz(spark, sf):
    return _split_trip(spark, sf, "xz")


@query
def source_split_zstd(spark, sf):
    return _split_trip(spark, sf, "zstd")


@query
def source_line_ends(spark, sf):
    directory = work_dir(spark)
    ended = _variants(
        "number", "value", "concat(value, '\\r')", "concat(value, cast(X'FF' AS string))",
        "concat('\\u2028', value)",
    )
    lines = samples.event_lines(spark, sf).selectExpr("*", NUMBER).selectExpr(f"{ended} AS value")
    samples.write_archives(lines, directory, "gzip")
    rows = normalize.normalize(read_lines(spark, directory), COMMENT)
    return rows.groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.min("decoded_reddit_id").alias("least")
    )


@query
def source_directory_check(spark, sf):
    directory = work_dir(spark)
    samples.write_archives(samples.event_lines(spark, sf), directory, "gzip")
    refused = 0
    for path in (f"{directory}/missing", f"{directory}/{child_names(spark, directory)[0]}"):
        try:
            read_lines(spark, path)
        except ValueError:
            refused += 1
    return _lines_and_errors(read_lines(spark, directory)).withColumn("refused", F.lit(refused))


@query
def source_mixed(spark, sf):
    rows = _round_trip(spark, sf, "gzip", "bzip2", "xz", "zstd")
    return rows.groupBy("decoded_reddit_id", "author", "subreddit").agg(
        F.count(F.lit(1)).alias("copies")
    )


@query
def source_skips(spark, sf):
    directory = work_dir(spark)
    samples.write_archives(samples.event_lines(spark, sf), directory, "gzip")
    _plain_files(spark, directory, 1)
    read = read_lines(spark, directory)
    return read.groupBy(F.coalesce("error", F.lit("line")).alias("what")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _lines_and_errors(read: DataFrame) -> DataFrame:
    """Number of lines, and of error rows by the part of their text before a colon."""
    what = F.substring_index(F.coalesce("error", F.lit("line")), ":", 1)
    return read.groupBy(what.alias("what")).agg(F.count(F.lit(1)).alias("n"))


def _plain_files(spark, directory: str, n: int) -> None:
    """A number of small text files that are no archives."""
    spark.range(0, n, 1, n).selectExpr("concat('no archive ', id) AS value").write.mode("append").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).text(directory)


def _renamed(spark, directory: str, prefix: str = "", suffix: str = "") -> None:
    for name in child_names(spark, directory):
        if name.endswith((".gz", ".txt")):
            rename_path(spark, f"{directory}/{name}", f"{directory}/{prefix}{name}{suffix}")


@query
def source_hidden(spark, sf):
    directory = work_dir(spark)
    lines = samples.event_lines(spark, sf)
    samples.write_archives(lines, directory, "gzip")
    _renamed(spark, directory, prefix="_")
    samples.write_archives(lines, directory, "gzip")
    return _lines_and_errors(read_lines(spark, directory))


@query
def source_damaged_keep(spark, sf):
    directory = work_dir(spark)
    samples.write_archives(samples.event_lines(spark, sf), directory, "gzip")
    # Four archives without a line, and with something behind their end.
    none = spark.range(0, 4, 1, 4).where("id < 0").selectExpr("cast(id AS string) AS value")
    samples.write_archives(none, directory, "gz", b"junk behind the archive")
    return _lines_and_errors(read_lines(spark, directory, on_damage="keep"))


def _with_unopenable(spark, sf, directory: str) -> None:
    """Good archives and four files with a gz name that are none."""
    _plain_files(spark, directory, 4)
    _renamed(spark, directory, suffix=".gz")
    samples.write_archives(samples.event_lines(spark, sf), directory, "gzip")


@query
def source_unopenable(spark, sf):
    directory = work_dir(spark)
    _with_unopenable(spark, sf, directory)
    return _lines_and_errors(read_lines(spark, directory))


@query
def ingest_quiet_errors(spark, sf):
    root = work_dir(spark)
    _with_unopenable(spark, sf, f"{root}/in")
    spec = FilterSpec(subreddits={"error"})
    counts = jobs.ingest(spark, f"{root}/out", f"{root}/in", filters=spec, report_rejects=False)
    reported = jobs.read_rejects(spark, f"{root}/out").count()
    return _counts_row(spark, counts["comment"]).withColumn(
        "reported", F.lit(reported).cast("bigint")
    )


@query
def stream_two_checkpoints(spark, sf):
    root = work_dir(spark)
    for n in ("one", "two"):
        junk = samples.event_lines(spark, sf).select(
            F.concat(F.lit(n), F.substring("value", 2, 1_000_000)).alias("value")
        )
        samples.write_archives(junk, f"{root}/{n}", "bzip2" if n == "one" else "zstd")
        start_ingest(
            spark, f"{root}/{n}", f"{root}/out", COMMENT, f"{root}/checkpoint-{n}"
        ).awaitTermination()
    return jobs.read_rejects(spark, f"{root}/out").groupBy(
        F.substring("line", 1, 3).alias("starts"), "reason"
    ).agg(F.count(F.lit(1)).alias("n"))


def _counts_row(spark: SparkSession, counts: jobs.IngestCounts) -> DataFrame:
    names = ["lines", "rejected", "filtered", "kept", "stored"]
    values = [tuple(getattr(counts, n) for n in names)]
    return spark.createDataFrame(values, ", ".join(f"{n} bigint" for n in names))


@query
def ingest_counts(spark, sf):
    lines = _broken_lines(spark, sf)
    spec = FilterSpec(min_score=5, subreddits={"error", "click", "view"})
    counts = jobs.ingest_lines(spark, lines.unionAll(lines), work_dir(spark), COMMENT, spec)
    return _counts_row(spark, counts)


@query
def ingest_rejects(spark, sf):
    out = work_dir(spark)
    jobs.ingest_lines(spark, _broken_lines(spark, sf), out, COMMENT)
    return jobs.read_rejects(spark, out).groupBy("entity", "reason").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def ingest_prefiltered(spark, sf):
    out = work_dir(spark)
    spec = FilterSpec(users={"8", "46"}, subreddits={"error"}, max_score=40)
    jobs.ingest_lines(spark, samples.event_lines(spark, sf), out, COMMENT, spec,
                      report_rejects=False)
    stored = store.read_table(spark, jobs.table_path(out, COMMENT), COMMENT)
    return stored.select("decoded_reddit_id", "author", "subreddit", "score")


@query
def ingest_archives(spark, sf):
    root = work_dir(spark)
    samples.write_archives(samples.conversation_lines(spark, sf), f"{root}/in/c", "zstd")
    samples.write_archives(samples.document_lines(spark, sf), f"{root}/in/s", "xz")
    jobs.ingest(spark, f"{root}/out", f"{root}/in/c", f"{root}/in/s",
                FilterSpec(subreddits={"talk", "fr", "de"}))
    comments = store.read_table(spark, f"{root}/out/comment", COMMENT)
    submissions = store.read_table(spark, f"{root}/out/submission", SUBMISSION)
    return comments.select(
        F.lit("comment").alias("kind"), "decoded_reddit_id", "author", F.col("body").alias("text")
    ).unionAll(
        submissions.select(F.lit("submission"), "decoded_reddit_id", "author", "selftext")
    )


def _event_table(spark, sf) -> str:
    out = work_dir(spark)
    jobs.ingest_lines(spark, samples.event_lines(spark, sf), out, COMMENT)
    return out


def _stored_comments(spark, out: str) -> DataFrame:
    return store.read_table(spark, jobs.table_path(out, COMMENT), COMMENT)


@query
def table_time_range(spark, sf):
    spec = FilterSpec(
        min_datetime="2024-01-10-00:00:00", max_datetime="2024-01-20-12:30:00", max_score=60,
    )
    found = jobs.read_filtered(spark, _event_table(spark, sf), COMMENT, spec)
    return found.select("decoded_reddit_id", "author", "score", "created_utc")


@query
def table_delete(spark, sf):
    out = _event_table(spark, sf)
    ids = _stored_comments(spark, out).where("decoded_reddit_id % 3 = 0").select(COMMENT.key)
    jobs.delete_stored(spark, out, COMMENT, ids.union(spark.range(5)))
    return _stored_comments(spark, out).select("decoded_reddit_id", "author", "score")


@query
def table_update(spark, sf):
    out = _event_table(spark, sf)
    rows = _stored_comments(spark, out).where("decoded_reddit_id % 5 = 0")
    unknown = rows.withColumn(COMMENT.key, F.col(COMMENT.key) + 10_000_000_000)
    jobs.update_stored(spark, out, COMMENT, rows.union(unknown).withColumn("score", F.lit(-1)))
    return _stored_comments(spark, out).select("decoded_reddit_id", "author", "score")


@query
def fts_follows_changes(spark, sf):
    out = work_dir(spark)
    lines = samples.conversation_lines(spark, sf)
    turn = F.get_json_object("value", "$.score").cast("bigint")
    early, late = lines.where(turn < 2), lines.where(turn >= 2)
    jobs.ingest_lines(spark, early, out, COMMENT, build_index=True, index_buckets=16)
    stored = _stored_comments(spark, out)
    jobs.delete_stored(spark, out, COMMENT, stored.where("score = 0").select(COMMENT.key))
    jobs.update_stored(
        spark, out, COMMENT,
        _stored_comments(spark, out).where("score = 1").withColumn("body", F.reverse("body")),
    )
    jobs.ingest_lines(spark, late, out, COMMENT, build_index=True, index_buckets=16)
    index = text_index.TextIndex(spark, jobs.index_path(out, COMMENT), COMMENT.key, ("body",))
    return _by_term(index.entries())


@query
def stream_ingest(spark, sf):
    root = work_dir(spark)
    lines = samples.event_lines(spark, sf).select("value")
    # Overlapping deliveries: everything in one codec, then everything in another.
    for codec in ("gzip", "xz"):
        samples.write_archives(lines, f"{root}/in", codec)
        start_ingest(
            spark, f"{root}/in", f"{root}/out", COMMENT, f"{root}/checkpoint"
        ).awaitTermination()
    stored = store.read_table(spark, f"{root}/out/comment", COMMENT)
    return stored.select("decoded_reddit_id", "author", "subreddit", "body", "created_utc")


@query
def stream_large_file(spark, sf):
    root = work_dir(spark)
    lines = samples.event_lines(spark, sf)
    samples.write_one_archive(lines, f"{root}/in", "xz", block_bytes=100_000)
    files = list_archives(spark, f"{root}/in")
    start_ingest(
        spark, f"{root}/in", f"{root}/out", COMMENT, f"{root}/checkpoint",
        max_bytes_per_round=1 + sum(f.size for f in files) // 3,
    ).awaitTermination()
    return _stored_comments(spark, f"{root}/out").select(
        "decoded_reddit_id", "author", "subreddit", "body", "created_utc"
    )


# --- Full text -------------------------------------------------------------

TALK_KEY = "conv_id * 1000 + turn"


def _talk(spark, sf) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.expr(TALK_KEY).alias("doc_id"), "role", "text"
    )


def _documents(spark, sf) -> DataFrame:
    return samples.spread(table(spark, sf, "documents").select("doc_id", "text", "lang"))


def _postings(spark, sf) -> DataFrame:
    return text_index.entries_of(_documents(spark, sf), "doc_id", ("text",))


@query
def fts_tokens(spark, sf):
    return _documents(spark, sf).select(
        "doc_id", F.array_join(tokens(F.col("text")), " ").alias("folded")
    )


@query
def fts_postings(spark, sf):
    return text_index.postings_of(_talk(spark, sf), "doc_id", ("role", "text"))


@query
def fts_term(spark, sf):
    docs = samples.dealt(table(spark, sf, "documents").select("doc_id", "source", "lang", "text"))
    return docs.where(F.array_contains(tokens(F.col("text")), "para")).drop("text")


@query
def fts_term_rows(spark, sf):
    found = text_search.term_docs(_postings(spark, sf), "nicht")
    return text_search.rows_of(table(spark, sf, "documents"), found, "doc_id").select(
        "doc_id", "source", "n_chars"
    )


@query
def fts_and(spark, sf):
    return text_search.all_terms_docs(_postings(spark, sf), ["the", "with", "for"])


@query
def fts_or(spark, sf):
    return text_search.any_term_docs(_postings(spark, sf), ["para", "nicht"])


@query
def fts_not(spark, sf):
    postings = _postings(spark, sf)
    return text_search.but_not(
        text_search.term_docs(postings, "la"), text_search.term_docs(postings, "dans")
    )


@query
def fts_boolean_tree(spark, sf):
    postings = _postings(spark, sf)
    either = text_search.any_of(
        text_search.term_docs(postings, "para"), text_search.prefix_docs(postings, "nich")
    )
    return text_search.all_of(either, text_search.term_docs(postings, "de"))


@query
def fts_prefix(spark, sf):
    return text_search.prefix_docs(_postings(spark, sf), "para")


@query
def fts_phrase(spark, sf):
    return text_search.phrase_docs(_postings(spark, sf), query_tokens(spark, "of THE"))


@query
def fts_phrase_prefix(spark, sf):
    return text_search.phrase_docs(_postings(spark, sf), ["de", "l*"])


@query
def fts_near(spark, sf):
    return text_search.near_docs(_postings(spark, sf), [["que"], ["de", "la"]], 3)


@query
def fts_column(spark, sf):
    postings = text_index.postings_of(_talk(spark, sf), "doc_id", ("role", "text"))
    return text_search.term_docs(postings, "user", field="role")


@query
def fts_any_column(spark, sf):
    postings = text_index.postings_of(_talk(spark, sf), "doc_id", ("role", "text"))
    return text_search.any_term_docs(postings, ["system", "for"])


@query
def fts_bm25_topk(spark, sf):
    rows = _documents(spark, sf)
    ranks = text_search.ranked(
        text_index.entries_of(rows, "doc_id", ("text",)),
        text_index.docs_of(rows, "doc_id", ("text",)),
        [["que"], ["para"]],
        require_all=False,
    )
    return text_search.top_k(ranks.withColumn("rank", F.round("rank", 6)), 20)


@query
def fts_bm25_all(spark, sf):
    rows = _documents(spark, sf)
    ranks = text_search.ranked(
        text_index.entries_of(rows, "doc_id", ("text",)),
        text_index.docs_of(rows, "doc_id", ("text",)),
        [["the"], ["that"]],
    )
    return ranks.withColumn("rank", F.round("rank", 6))


@query
def fts_highlight(spark, sf):
    return _documents(spark, sf).select(
        "doc_id", highlight(F.col("text"), [["the"], ["ete"]], "[", "]").alias("marked")
    )


@query
def fts_snippet(spark, sf):
    return text_search.snippets(_documents(spark, sf), "doc_id", "text", [["que"], ["para"]])


@query
def fts_changes(spark, sf):
    docs = _documents(spark, sf)
    changed = docs.where("lang in ('de', 'es')").select("doc_id")
    new = docs.where("lang = 'de'").select("doc_id", F.reverse("text").alias("text"))
    postings = text_index.with_changes(
        text_index.postings_of(docs, "doc_id", ("text",)), changed, new, "doc_id", ("text",)
    )
    return postings.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.countDistinct("term").alias("n_terms")
    )


def _stored_index(spark, sf) -> text_index.TextIndex:
    return text_index.TextIndex(spark, work_dir(spark), "doc_id", ("text",), buckets=16)


def _by_term(entries: DataFrame) -> DataFrame:
    return entries.groupBy("term").agg(
        F.count(F.when(F.col("first"), 1)).alias("n_docs"), F.sum("tf").alias("n_hits")
    )


@query
def fts_index_build(spark, sf):
    index = _stored_index(spark, sf)
    index.add_missing(_documents(spark, sf))
    index.add_missing(_documents(spark, sf))  # nothing left to add
    return _by_term(index.entries())


@query
def fts_index_update(spark, sf):
    index = _stored_index(spark, sf)
    docs = _documents(spark, sf)
    index.add_missing(docs)
    index.remove(docs.where("lang = 'es'").select("doc_id"))
    index.replace(docs.where("lang = 'de'").withColumn("text", F.reverse("text")))
    return _by_term(index.entries())


@query
def fts_index_search(spark, sf):
    index = _stored_index(spark, sf)
    index.add_missing(_documents(spark, sf))
    ranks = text_search.ranked(
        index.entries(["de", "la", "dans"]), index.docs(), [["de", "la"], ["dans"]]
    )
    return text_search.top_k(ranks.withColumn("rank", F.round("rank", 6)), 25)


@query
def ingest_with_index(spark, sf):
    out = work_dir(spark)
    lines = samples.conversation_lines(spark, sf)
    jobs.ingest_lines(spark, lines, out, COMMENT, FilterSpec(users={"user"}))
    jobs.ingest_lines(spark, lines, out, COMMENT, build_index=True, index_buckets=16)
    index = text_index.TextIndex(spark, jobs.index_path(out, COMMENT), COMMENT.key, ("body",))
    stored = store.read_table(spark, jobs.table_path(out, COMMENT), COMMENT)
    found = text_search.term_docs(index.entries(["the"]), "the", field="body")
    return text_search.rows_of(stored, found, COMMENT.key).select(
        "decoded_reddit_id", "author", "body"
    )


@query
def fts_index_prefix(spark, sf):
    index = _stored_index(spark, sf)
    index.add_missing(_documents(spark, sf))
    return text_search.prefix_docs(index.entries(["para*"]), "para")


@query
def fts_index_topk(spark, sf):
    index = _stored_index(spark, sf)
    index.add_missing(_documents(spark, sf))
    return text_search.best_of_index(index, ["que", "para"], 20, require_all=False, digits=6)


@query
def fts_index_merge(spark, sf):
    index = _stored_index(spark, sf)
    docs = _documents(spark, sf)
    for lang in ("en", "de", "fr", "es"):
        index.add_missing(docs.where(F.col("lang") == lang))
    index.add_missing(docs)
    return _by_term(index.entries())


@query
def fts_submissions(spark, sf):
    out = work_dir(spark)
    lines = samples.document_lines(spark, sf)
    jobs.ingest_lines(spark, lines, out, SUBMISSION, build_index=True, index_buckets=16)
    index = text_index.TextIndex(
        spark, jobs.index_path(out, SUBMISSION), SUBMISSION.key, SUBMISSION.text_fields
    )
    entries = index.entries(["src1", "nicht"])
    found = text_search.any_of(
        text_search.term_docs(entries, "src1", field="title"),
        text_search.term_docs(entries, "nicht", field="selftext"),
    )
    stored = store.read_table(spark, jobs.table_path(out, SUBMISSION), SUBMISSION)
    return text_search.rows_of(stored, found, SUBMISSION.key).select("decoded_reddit_id", "title")
