"""The registry's queries as SQL over the same tables, for checking results."""

from __future__ import annotations

_EPOCH = "(epoch_us(ts) // 1000000)"
_EVENTS = f"""(SELECT event_id, CAST(user_id AS VARCHAR) AS author, event_type AS subreddit,
    value AS score, {_EPOCH} AS created_utc FROM events)"""
_DOCS = """(SELECT d.doc_id, d.source AS author, d.lang AS subreddit,
    CAST(l.quality AS BIGINT) AS score, d.n_chars AS created_utc
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _base36(number: str) -> str:
    return f"lower(to_base({number}, 36))"


# Archive-shaped rows, as the samples build them.
_KEY = "(conv_id * 1000 + turn + 45000000000)"
_COMMENT_VALUES = {
    "decoded_reddit_id": _KEY,
    "reddit_id": _base36(_KEY),
    "author": "role",
    "subreddit": "'talk'",
    "decoded_subreddit_id": "5858204",
    "body": "text",
    "score": "turn",
    "created_utc": "1700000000 + conv_id * 60 + turn",
    "parent_type": "CAST(CASE WHEN turn = 0 THEN 3 ELSE 1 END AS INTEGER)",
    "parent_id": f"CASE WHEN turn = 0 THEN {_base36('(conv_id + 1000)')} "
    f"ELSE {_base36(f'({_KEY} - 1)')} END",
    "decoded_parent_id": f"CASE WHEN turn = 0 THEN conv_id + 1000 ELSE {_KEY} - 1 END",
    "stickied": "role = 'system'",
}
_SUBMISSION_VALUES = {
    "decoded_reddit_id": "doc_id + 3000000000",
    "reddit_id": _base36("(doc_id + 3000000000)"),
    "author": "CASE WHEN lang <> 'de' THEN source END",
    "title": "'about ' || source || ' ' || lang",
    "link_flair_template_id": "CASE WHEN lang <> 'en' THEN md5(source) END",
    "subreddit": "lang",
    "decoded_crosspost_parent_id": "CASE WHEN lang = 'es' THEN doc_id + 3000000001 END",
    "post_hint": "CASE WHEN lang = 'fr' THEN 'hosted_video' ELSE 'slf' END",
    "selftext": "text",
    "permalink": "'/d/' || doc_id",
    "score": "doc_id",
    "created_utc": "n_chars + 1700000000",
    "is_self": "true",
    "over_18": "false",
    "spoiler": "CASE WHEN lang = 'fr' THEN true END",
    "num_comments": "CAST(n_chars AS INTEGER)",
}
# Stored columns and types, written out so that the schema under test does not vouch for
# itself. Flags that are false when missing have a mark.
_COMMENT_COLUMNS = """decoded_reddit_id BIGINT, reddit_id VARCHAR, permalink VARCHAR, author VARCHAR,
    author_premium BOOLEAN, subreddit VARCHAR, subreddit_type VARCHAR, decoded_subreddit_id BIGINT,
    body VARCHAR, score BIGINT, ups INTEGER, downs INTEGER, created_utc BIGINT, retrieved_on BIGINT,
    edited_utc BIGINT, parent_type INTEGER, parent_id VARCHAR, decoded_parent_id BIGINT,
    stickied BOOLEAN!, parent_is_post BOOLEAN!, is_submitter BOOLEAN!, archived BOOLEAN!,
    locked BOOLEAN!, collapsed BOOLEAN!, distinguished VARCHAR"""
_SUBMISSION_COLUMNS = """decoded_reddit_id BIGINT, reddit_id VARCHAR, author VARCHAR,
    author_premium BOOLEAN, title VARCHAR, author_flair_text VARCHAR, author_flair_template_id VARCHAR,
    link_flair_template_id VARCHAR, link_flair_text VARCHAR, subreddit VARCHAR,
    decoded_subreddit_id BIGINT, subreddit_subscribers BIGINT, subreddit_type VARCHAR,
    suggested_sort VARCHAR, decoded_crosspost_parent_id BIGINT, post_hint VARCHAR,
    removed_by_category VARCHAR, selftext VARCHAR, permalink VARCHAR, domain VARCHAR, url VARCHAR,
    score BIGINT, ups INTEGER, downs INTEGER, created_utc BIGINT, edited_utc BIGINT,
    retrieved_on BIGINT, is_self BOOLEAN!, over_18 BOOLEAN!, spoiler BOOLEAN, pinned BOOLEAN,
    stickied BOOLEAN!, is_created_from_ads_ui BOOLEAN!, is_gallery BOOLEAN!, is_video BOOLEAN!,
    is_original_content BOOLEAN, is_reddit_media_domain BOOLEAN!, quarantine BOOLEAN,
    num_comments INTEGER, contest_mode BOOLEAN!, num_crossposts BIGINT"""


def _record(columns: str, values: dict[str, str]) -> str:
    """Select list of a whole stored row; columns not given are NULL or false."""
    parts = []
    for column in columns.split(","):
        name, kind = column.split()
        value = values.get(name, "false" if kind.endswith("!") else "NULL")
        parts.append(f"CAST({value} AS {kind.rstrip('!')}) AS {name}")
    return ", ".join(parts)


_EVENT_ROWS = f"""(SELECT event_id + 45000000000 AS decoded_reddit_id,
    CAST(user_id AS VARCHAR) AS author, event_type AS subreddit, props AS body,
    CAST(floor(value) AS BIGINT) AS score, {_EPOCH} AS created_utc,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 10 AS damage FROM events)"""

# What each kind of damage to an event line leads to.
_REASON = """CASE damage WHEN 1 THEN 'missing author' WHEN 2 THEN 'invalid score'
    WHEN 3 THEN 'invalid created_utc' WHEN 4 THEN 'invalid link_id'
    WHEN 5 THEN 'invalid stickied' WHEN 6 THEN 'malformed json' WHEN 7 THEN 'malformed json'
    WHEN 8 THEN 'repeated key' WHEN 9 THEN 'invalid id' END"""

# Tokens, as lists and one per row with positions.
_TOKEN_LIST = r"regexp_extract_all(strip_accents(lower({})), '[\p{{L}}\p{{N}}]+')"
_DOC_TOKENS = f"(SELECT *, {_TOKEN_LIST.format('text')} AS toks FROM documents)"
_TALK = "(SELECT conv_id * 1000 + turn AS doc_id, role, text FROM conversations)"
_POSTINGS = f"""(SELECT doc_id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos,
    len(toks) AS doc_len FROM {_DOC_TOKENS})"""


def _bm25(phrases: list[list[str]], require_all: bool) -> str:
    """Rank expression over per-phrase hit counts."""
    hits = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS phrase, doc_len FROM ({_phrase_starts(p)})"
        for i, p in enumerate(phrases)
    )
    together = f"HAVING count(DISTINCT phrase) = {len(phrases)}" if require_all else ""
    return f"""
        WITH hits AS ({hits}),
        tf AS (SELECT doc_id, phrase, any_value(doc_len) AS dl, count(*) AS tf
               FROM hits GROUP BY ALL),
        df AS (SELECT phrase, count(*) AS n FROM tf GROUP BY phrase),
        corpus AS (SELECT count(*) AS n, avg(len(toks)) AS mean FROM {_DOC_TOKENS})
        SELECT doc_id, round(-sum(
            greatest(ln((corpus.n - df.n + 0.5) / (df.n + 0.5)), 1e-6) * tf.tf * 2.2
            / (tf.tf + 1.2 * (0.25 + 0.75 * tf.dl / corpus.mean))), 6) AS rank
        FROM tf JOIN df USING (phrase), corpus GROUP BY doc_id {together}"""


def _phrase_starts(phrase: list[str]) -> str:
    joins = "".join(
        f" JOIN {_POSTINGS} p{i} ON p{i}.doc_id = p0.doc_id AND p{i}.pos = p0.pos + {i}"
        f" AND p{i}.term = '{t}'"
        for i, t in enumerate(phrase)
        if i
    )
    return (
        f"SELECT p0.doc_id, p0.pos AS start, p0.doc_len FROM {_POSTINGS} p0{joins}"
        f" WHERE p0.term = '{phrase[0]}'"
    )


def _has(*terms: str, how: str = "AND") -> str:
    return f" {how} ".join(f"list_contains(toks, '{t}')" for t in terms)


_TERM_COUNTS = """SELECT term, count(*) AS n_docs, CAST(sum(tf) AS BIGINT) AS n_hits
    FROM (SELECT term, doc_id, count(*) AS tf FROM ({}) GROUP BY ALL) GROUP BY term"""
_CHANGED = f"""SELECT doc_id, unnest({_TOKEN_LIST.format('t')}) AS term FROM
    (SELECT doc_id, CASE WHEN lang = 'de' THEN reverse(text) ELSE text END AS t
     FROM documents WHERE lang <> 'es')"""
_HINTS = """WHEN 0 THEN 'gallery' WHEN 1 THEN 'hosted_video' WHEN 2 THEN 'image' WHEN 3 THEN 'link'
    WHEN 4 THEN 'rich_video' WHEN 5 THEN 'slf' WHEN 6 THEN 'video'"""
# Right spellings stay as they are; the last ones of each list are wrong.
_OTHER_ENUMS = (
    ("subreddit_type", 8, "['public', 'restricted', 'user', 'archived', 'gold_restricted', 'gold_only', "
     "'private', 'employees_only', 'Public', 'gold']"),
    ("distinguished", 3, "['admin', 'moderator', 'special', 'user', 'Admin']"),
    ("suggested_sort", 8, "['confidence', 'controversial', 'live', 'new', 'old', 'qa', 'random', 'top', 'best']"),
    ("removed_by_category", 9, "['author', 'automod_filtered', 'content_takedown', 'deleted', 'moderator', "
     "'reddit', 'anti_evil_ops', 'community_ops', 'copyright_takedown', 'admin']"),
)

ORACLES: dict[str, str] = {
    "filter_composite": f"""SELECT * FROM {_DOCS}
        WHERE (score IS NULL OR score = 0) AND created_utc BETWEEN 500 AND 6000
          AND (author IN ('src1', 'src2', 'src3') OR subreddit IN ('fr', 'es'))""",
    "filter_score_null_passes": f"""SELECT doc_id, score FROM {_DOCS}
        WHERE score IS NULL OR score BETWEEN 1 AND 1""",
    "filter_inverted_bounds": f"SELECT doc_id, score FROM {_DOCS} WHERE score IS NULL",
    "filter_datetime_range": f"""SELECT * FROM {_EVENTS} WHERE created_utc BETWEEN
        epoch_us(TIMESTAMP '2024-01-10 00:00:00') // 1000000
        AND epoch_us(TIMESTAMP '2024-01-20 12:30:00') // 1000000""",
    "filter_user_or_group": f"""SELECT * FROM {_EVENTS}
        WHERE author IN ('8', '46', '101') OR subreddit = 'error'""",
    "filter_user_only": f"SELECT * FROM {_EVENTS} WHERE author IN ('8', '46', '101')",
    "filter_group_only": f"SELECT * FROM {_EVENTS} WHERE subreddit IN ('view', 'Click')",
    "filter_empty_sets": f"SELECT * FROM {_EVENTS}",
    "filter_large_list": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
        WHERE EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal < 0)
           OR EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_brand = 'Brand#2')""",
    "filter_datetime_argument": f"""SELECT event_id,
        CASE WHEN event_id % 5 <> 0 THEN {_EPOCH} END AS epoch FROM events""",
    "trim_json_line": """SELECT event_id,
        CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events""",
    "line_guard": "SELECT event_id, event_id % 7 = 0 AS is_object FROM events",
    "repeated_key": "SELECT event_id, event_id % 3 = 1 AS repeats FROM events",
    "coerce_time": f"""SELECT event_id, CASE event_id % 7 WHEN 0 THEN {_EPOCH}
        WHEN 1 THEN {_EPOCH} + 1 WHEN 2 THEN {_EPOCH} WHEN 5 THEN -{_EPOCH} - 1 END AS value
        FROM events""",
    "coerce_optional_time": f"""SELECT event_id,
        CASE WHEN event_id % 6 < 3 THEN {_EPOCH} END AS value, event_id % 6 < 5 AS fits
        FROM events""",
    "coerce_score": f"""SELECT event_id, CASE WHEN event_id % 5 < 2 THEN -{_EPOCH} END AS value,
        event_id % 5 IN (0, 1, 3) AS fits FROM events""",
    "coerce_integer_range": f"""SELECT event_id,
        CASE event_id % 5 WHEN 0 THEN CAST({_EPOCH} AS INTEGER)
            WHEN 4 THEN CAST(-{_EPOCH} AS INTEGER) END AS as_int32,
        CASE WHEN event_id % 5 = 0 THEN {_EPOCH} END AS as_uint32,
        CASE event_id % 5 WHEN 0 THEN {_EPOCH} WHEN 1 THEN {_EPOCH} * 100
            WHEN 4 THEN -{_EPOCH} END AS as_int64
        FROM events""",
    "default_false_bool": """SELECT event_id, event_id % 5 = 0 AS value,
        event_id % 5 IN (0, 1, 4) AS fits FROM events""",
    "refid_parse": f"""SELECT o_orderkey,
        CASE WHEN o_orderkey % 7 <> 6 THEN CAST(o_orderkey % 10 AS INTEGER) END AS parent_type,
        CASE WHEN o_orderkey % 7 <> 6 THEN {_base36('(o_orderkey * 1000003 + 7)')} END AS parent_id,
        CASE WHEN o_orderkey % 7 <> 6 THEN o_orderkey * 1000003 + 7 END AS decoded_parent_id
        FROM orders""",
    "refid_from_int": f"""SELECT o_orderkey, CAST(NULL AS INTEGER) AS parent_type,
        {_base36('(o_orderkey * 1000003 + 45000000000)')} AS parent_id,
        o_orderkey * 1000003 + 45000000000 AS decoded_parent_id FROM orders""",
    "base36_decode": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 3 THEN
        o_orderkey + 45000000000 WHEN o_orderkey % 7 = 3 THEN -(o_orderkey + 45000000000)
        END AS decoded FROM orders""",
    "enum_canon": f"SELECT o_orderkey, CASE o_orderkey % 9 {_HINTS} END AS stored FROM orders",
    "uuid_bytes": """SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 4
        THEN md5(CAST(o_orderkey AS VARCHAR)) END AS uuid_hex FROM orders""",
    "enum_others": " UNION ALL ".join(
        f"""SELECT o_orderkey, '{key}' AS key, w AS spelled,
            CASE WHEN o_orderkey % len({words}) < {right} THEN w END AS stored
        FROM (SELECT o_orderkey, ({words})[1 + o_orderkey % len({words})] AS w FROM orders)"""
        for key, right, words in _OTHER_ENUMS
    ),
    "comment_normalize": f"SELECT {_record(_COMMENT_COLUMNS, _COMMENT_VALUES)} FROM conversations",
    "submission_normalize": f"SELECT {_record(_SUBMISSION_COLUMNS, _SUBMISSION_VALUES)} FROM documents",
    "rejects_by_reason": f"""SELECT CASE WHEN reason IS NULL THEN 'kept' ELSE 'rejected' END
        AS status, reason, count(*) AS n
        FROM (SELECT {_REASON} AS reason FROM {_EVENT_ROWS}) GROUP BY reason""",
    "keep_first": """SELECT doc_id, source, lang FROM (SELECT *, row_number() OVER
        (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
    "insert_if_absent": """SELECT o_orderkey, o_orderstatus,
        CASE WHEN o_orderstatus = 'P' THEN -1.0 ELSE o_totalprice END AS o_totalprice
        FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""",
    "insert_twice": f"""SELECT decoded_reddit_id, reddit_id, author, body, created_utc
        FROM (SELECT {_record(_COMMENT_COLUMNS, _COMMENT_VALUES)} FROM conversations)""",
    "point_lookup": f"""SELECT decoded_reddit_id, reddit_id, author, body, parent_type
        FROM (SELECT {_record(_COMMENT_COLUMNS, _COMMENT_VALUES)} FROM conversations)
        WHERE decoded_reddit_id = 45000007001""",
    "table_count": "SELECT count(*) AS n FROM conversations",
    "sql_over_views": """SELECT role AS author, turn = 0 AS replies_to_submission, count(*) AS n,
        max(1700000000 + conv_id * 60 + turn) AS latest,
        CAST(sum(CASE WHEN role = 'system' THEN 1 ELSE 0 END) AS BIGINT) AS stickied
        FROM conversations GROUP BY role, turn = 0""",
    "parent_join": f"""SELECT c.k AS child, p.k AS parent, p.role AS parent_author
        FROM (SELECT {_KEY} AS k, turn FROM conversations) c
        JOIN (SELECT {_KEY} AS k, role FROM conversations) p ON p.k = c.k - 1
        WHERE c.turn > 0""",
    **{
        name: f"""SELECT decoded_reddit_id, author, subreddit, body, score, created_utc
            FROM {_EVENT_ROWS}"""
        for name in ("source_gzip", "source_bzip2", "source_xz", "source_zstd")
    },
    "source_mixed": f"""SELECT decoded_reddit_id, author, subreddit, CAST(4 AS BIGINT) AS copies
        FROM {_EVENT_ROWS}""",
    "source_skips": """SELECT 'line' AS what, count(*) AS n FROM events
        UNION ALL SELECT 'unknown file extension', CAST(1 AS BIGINT)""",
    "source_hidden": "SELECT 'line' AS what, 2 * count(*) AS n FROM events",
    "source_damaged_keep": """SELECT 'line' AS what, count(*) AS n FROM events
        UNION ALL SELECT 'damaged file', CAST(4 AS BIGINT)""",
    "source_unopenable": """SELECT 'line' AS what, count(*) AS n FROM events
        UNION ALL SELECT 'unreadable file', CAST(4 AS BIGINT)""",
    "ingest_quiet_errors": """SELECT count(*) + 4 AS lines, CAST(4 AS BIGINT) AS rejected,
        count(*) FILTER (event_type <> 'error') AS filtered,
        count(*) FILTER (event_type = 'error') AS kept,
        count(*) FILTER (event_type = 'error') AS stored, CAST(4 AS BIGINT) AS reported FROM events""",
    "stream_two_checkpoints": """SELECT starts, 'malformed json' AS reason, n FROM
        (SELECT count(*) AS n FROM events) CROSS JOIN (VALUES ('one'), ('two')) v(starts)""",
    "ingest_counts": f"""WITH e AS (SELECT {_REASON} AS reason,
            score >= 5 AND subreddit IN ('error', 'click', 'view') AS passes FROM {_EVENT_ROWS}),
        s AS (SELECT CASE WHEN reason IS NOT NULL AND reason <> 'invalid id' THEN 'rejected'
                WHEN NOT passes THEN 'filtered' WHEN reason IS NOT NULL THEN 'rejected'
                ELSE 'kept' END AS status FROM e)
        SELECT count(*) * 2 AS lines, 2 * count(*) FILTER (status = 'rejected') AS rejected,
            2 * count(*) FILTER (status = 'filtered') AS filtered,
            2 * count(*) FILTER (status = 'kept') AS kept,
            count(*) FILTER (status = 'kept') AS stored FROM s""",
    "ingest_rejects": f"""SELECT 'comment' AS entity, reason, count(*) AS n
        FROM (SELECT {_REASON} AS reason FROM {_EVENT_ROWS}) WHERE reason IS NOT NULL
        GROUP BY reason""",
    "ingest_prefiltered": f"""SELECT decoded_reddit_id, author, subreddit, score
        FROM {_EVENT_ROWS} WHERE (author IN ('8', '46') OR subreddit = 'error') AND score <= 40""",
    "ingest_archives": f"""SELECT 'comment' AS kind, {_KEY} AS decoded_reddit_id, role AS author,
            text FROM conversations
        UNION ALL SELECT 'submission', doc_id + 3000000000,
            CASE WHEN lang <> 'de' THEN source END, text FROM documents
        WHERE lang IN ('fr', 'de')""",
    "table_delete": f"""SELECT decoded_reddit_id, author, score FROM {_EVENT_ROWS}
        WHERE decoded_reddit_id % 3 <> 0""",
    "table_update": f"""SELECT decoded_reddit_id, author,
        CASE WHEN decoded_reddit_id % 5 = 0 THEN -1 ELSE score END AS score FROM {_EVENT_ROWS}""",
    "fts_follows_changes": _TERM_COUNTS.format(
        f"""SELECT unnest({_TOKEN_LIST.format('body')}) AS term, doc_id FROM (
            SELECT {_KEY} AS doc_id, CASE WHEN turn = 1 THEN reverse(text) ELSE text END AS body
            FROM conversations WHERE turn > 0)"""
    ),
    "fts_snippet": r"""WITH pieces AS (
            SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+[^\p{L}\p{N}]*') AS p FROM documents
        ), tokens AS (
            SELECT doc_id, p, list_transform(p, lambda x:
                strip_accents(lower(regexp_extract(x, '^[\p{L}\p{N}]+')))) AS k FROM pieces
        ), hits AS (
            SELECT doc_id, p, k, i, list_contains(k[i:i + 14], 'que')::INT
                + list_contains(k[i:i + 14], 'para')::INT AS covered
            FROM (SELECT *, unnest(range(1, len(k) + 1)) AS i FROM tokens)
            WHERE k[i] IN ('que', 'para')
        ), best AS (
            SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY covered DESC, i) = 1
        )
        SELECT doc_id, CASE WHEN i > 1 THEN '...' ELSE '' END
            || rtrim(array_to_string(list_transform(p[i:i + 14], lambda x:
                CASE WHEN strip_accents(lower(regexp_extract(x, '^[\p{L}\p{N}]+'))) IN ('que', 'para')
                THEN regexp_replace(x, '^([\p{L}\p{N}]+)', '[\1]') ELSE x END), ''), ' ')
            || CASE WHEN i + 14 < len(p) THEN '...' ELSE '' END AS snippet
        FROM best""",
    "stream_ingest": f"""SELECT decoded_reddit_id, author, subreddit, body, created_utc
        FROM {_EVENT_ROWS}""",
    "fts_tokens": f"SELECT doc_id, array_to_string(toks, ' ') AS folded FROM {_DOC_TOKENS}",
    "fts_postings": f"""WITH t AS (SELECT doc_id, {_TOKEN_LIST.format('role')} AS r,
            {_TOKEN_LIST.format('text')} AS b FROM {_TALK})
        SELECT doc_id, 'role' AS field, unnest(r) AS term,
            CAST(generate_subscripts(r, 1) - 1 AS INTEGER) AS pos,
            CAST(len(r) + len(b) AS INTEGER) AS doc_len FROM t
        UNION ALL SELECT doc_id, 'text', unnest(b),
            CAST(generate_subscripts(b, 1) - 1 AS INTEGER),
            CAST(len(r) + len(b) AS INTEGER) FROM t""",
    "fts_term": f"SELECT doc_id, source, lang FROM {_DOC_TOKENS} WHERE {_has('para')}",
    "fts_term_rows": f"SELECT doc_id, source, n_chars FROM {_DOC_TOKENS} WHERE {_has('nicht')}",
    "fts_and": f"SELECT doc_id FROM {_DOC_TOKENS} WHERE {_has('the', 'with', 'for')}",
    "fts_or": f"SELECT doc_id FROM {_DOC_TOKENS} WHERE {_has('para', 'nicht', how='OR')}",
    "fts_not": f"SELECT doc_id FROM {_DOC_TOKENS} WHERE {_has('la')} AND NOT {_has('dans')}",
    "fts_boolean_tree": f"""SELECT doc_id FROM {_DOC_TOKENS} WHERE {_has('de')} AND ({_has('para')}
        OR len(list_filter(toks, lambda t: starts_with(t, 'nich'))) > 0)""",
    "fts_prefix": f"""SELECT doc_id FROM {_DOC_TOKENS}
        WHERE len(list_filter(toks, lambda t: starts_with(t, 'para'))) > 0""",
    "fts_phrase": f"SELECT DISTINCT doc_id FROM ({_phrase_starts(['of', 'the'])})",
    "fts_near": f"""SELECT DISTINCT a.doc_id FROM ({_phrase_starts(['que'])}) a
        JOIN ({_phrase_starts(['de', 'la'])}) b ON a.doc_id = b.doc_id
        WHERE (a.start <= b.start AND b.start - (a.start + 1) <= 3)
           OR (b.start <= a.start AND a.start - (b.start + 2) <= 3)""",
    "fts_column": f"SELECT doc_id FROM {_TALK} WHERE role = 'user'",
    "fts_any_column": f"""SELECT doc_id FROM (SELECT doc_id, role,
        {_TOKEN_LIST.format('text')} AS toks FROM {_TALK})
        WHERE role = 'system' OR {_has('system', 'for', how='OR')}""",
    "fts_bm25_topk": _bm25([["que"], ["para"]], False) + " ORDER BY rank, doc_id LIMIT 20",
    "fts_bm25_all": _bm25([["the"], ["that"]], True),
    "fts_highlight": r"""SELECT doc_id, array_to_string(list_transform(
            regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}]+'),
            lambda x: CASE WHEN strip_accents(lower(x)) IN ('the', 'ete')
                THEN '[' || x || ']' ELSE x END), '') AS marked FROM documents""",
    "fts_changes": f"""SELECT doc_id, count(*) AS n_tokens, count(DISTINCT term) AS n_terms
        FROM ({_CHANGED}) GROUP BY doc_id""",
    "fts_index_build": _TERM_COUNTS.format(f"SELECT term, doc_id FROM {_POSTINGS}"),
    "fts_index_update": _TERM_COUNTS.format(_CHANGED),
    "fts_index_search": _bm25([["de", "la"], ["dans"]], True)
    + " ORDER BY rank, doc_id LIMIT 25",
    "ingest_with_index": f"""SELECT decoded_reddit_id, author, body FROM
        (SELECT {_KEY} AS decoded_reddit_id, role AS author, text AS body,
            {_TOKEN_LIST.format('text')} AS toks FROM conversations)
        WHERE {_has('the')}""",
    **{
        name: f"""SELECT decoded_reddit_id, author, subreddit, body, score, created_utc
            FROM {_EVENT_ROWS}"""
        for name in ("source_split_xz", "source_split_zstd")
    },
    "source_line_ends": f"""SELECT reason, count(*) AS n, min(id) AS least FROM (
            SELECT CASE WHEN k = 2 THEN 'invalid utf-8' END AS reason,
                CASE WHEN k <> 2 THEN decoded_reddit_id END AS id
            FROM (SELECT decoded_reddit_id, CAST(regexp_extract(body, '([0-9]+)', 1) AS BIGINT) % 4 AS k
                FROM {_EVENT_ROWS}))
        GROUP BY reason""",
    "source_directory_check": "SELECT 'line' AS what, count(*) AS n, 2 AS refused FROM events",
    "filter_inverted_warns": f"""SELECT 'score' AS bounds, count(*) AS kept, 2 AS warned
        FROM {_DOCS} WHERE score IS NULL""",
    "key_is_decoded": f"""SELECT {_KEY} AS decoded_reddit_id, {_base36(_KEY)} AS reddit_id, text AS body
        FROM conversations""",
    "table_time_range": f"""SELECT decoded_reddit_id, author, score, created_utc FROM {_EVENT_ROWS}
        WHERE created_utc BETWEEN epoch(TIMESTAMP '2024-01-10 00:00:00')
            AND epoch(TIMESTAMP '2024-01-20 12:30:00') AND score <= 60""",
    "stream_large_file": f"""SELECT decoded_reddit_id, author, subreddit, body, created_utc
        FROM {_EVENT_ROWS}""",
    "fts_phrase_prefix": f"""SELECT DISTINCT a.doc_id FROM {_POSTINGS} a JOIN {_POSTINGS} b
        ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 WHERE a.term = 'de' AND starts_with(b.term, 'l')""",
    "fts_index_prefix": f"""SELECT doc_id FROM {_DOC_TOKENS}
        WHERE len(list_filter(toks, lambda t: starts_with(t, 'para'))) > 0""",
    "fts_index_topk": _bm25([["que"], ["para"]], False) + " ORDER BY rank, doc_id LIMIT 20",
    "fts_index_merge": _TERM_COUNTS.format(f"SELECT term, doc_id FROM {_POSTINGS}"),
    "fts_submissions": f"""SELECT doc_id + 3000000000 AS decoded_reddit_id,
            'about ' || source || ' ' || lang AS title
        FROM (SELECT *, {_TOKEN_LIST.format("'about ' || source || ' ' || lang")} AS words FROM {_DOC_TOKENS})
        WHERE list_contains(words, 'src1') OR {_has('nicht')}""",
}
