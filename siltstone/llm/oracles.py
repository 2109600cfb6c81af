"""SQL for DuckDB that gives the rows of the queries it can express."""

ORACLES: dict[str, str] = {}

ORACLES["op2_chat_parts"] = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), safe AS (
    SELECT *,
        replace(replace(replace(replace(role, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>'), '<|', '<\|') AS r,
        replace(replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>'), '<|', '<\|') AS t
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(4 + length(replace(r, ': ', ':\ ')) + 2 + length(t) + 8) AS BIGINT) AS formatted_chars,
    CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS attachment_tokens
FROM safe GROUP BY conv_id
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op6_extendible_dedup"] = f"""
WITH rows AS (SELECT doc_id, {_LOWERED} AS t FROM documents),
groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
    sha256(t) AS text_sha256
FROM rows JOIN groups USING (t)
"""

ORACLES["op10_temperature_mixing"] = r"""
WITH RECURSIVE rows AS (
    SELECT doc_id AS i, source, coalesce('=' || source, '') AS s,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n
    FROM documents
), sources AS (SELECT s, CAST(sum(n) AS BIGINT) AS tokens FROM rows GROUP BY s),
whole AS (
    SELECT sum(tokens)::BIGINT AS total,
        list(tokens ORDER BY tokens) FILTER (tokens > 0) AS each FROM sources
), shares AS (SELECT total, list_transform(each, lambda t: t / total) AS p FROM whole),
by_entropy AS (
    SELECT 0 AS k, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
    UNION ALL
    SELECT k + 1, CASE WHEN up THEN mid ELSE lo END, CASE WHEN up THEN hi ELSE mid END FROM (
        SELECT k, lo, hi, (lo + hi) / 2 AS mid,
            ln(list_sum(list_transform(p, lambda x: x ** ((lo + hi) / 2))))
            - (lo + hi) / 2 * list_sum(list_transform(p, lambda x: x ** ((lo + hi) / 2) * ln(x)))
            / list_sum(list_transform(p, lambda x: x ** ((lo + hi) / 2))) > 0.95 * ln(len(p)) AS up
        FROM by_entropy, shares WHERE k < 60)
), by_epochs AS (
    SELECT 0 AS k, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
    UNION ALL
    SELECT k + 1, CASE WHEN up THEN mid ELSE lo END, CASE WHEN up THEN hi ELSE mid END FROM (
        SELECT k, lo, hi, (lo + hi) / 2 AS mid,
            list_max(list_transform(p, lambda x: x ** ((lo + hi) / 2 - 1)))
            / list_sum(list_transform(p, lambda x: x ** ((lo + hi) / 2))) > 4.0 AS up
        FROM by_epochs, shares WHERE k < 60)
), exponent AS (
    SELECT greatest((SELECT hi FROM by_entropy WHERE k = 60), (SELECT hi FROM by_epochs WHERE k = 60)) AS a
), weighed AS (
    SELECT s, tokens, total, CASE WHEN tokens > 0 THEN
        (tokens / total) ** a / list_sum(list_transform(p, lambda x: x ** a)) ELSE 0 END AS weight
    FROM sources, shares, exponent
), plan AS (
    SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS epochs FROM (
        SELECT *, floor(weight * total)::BIGINT AS budget FROM weighed)
), copies AS (
    SELECT *, md5(coalesce(i::VARCHAR, 'null') || ':' || epoch) AS h FROM (
        SELECT r.*, p.tokens, p.total, p.budget, p.epochs, p.budget - p.epochs * p.tokens AS rest,
            unnest(range(p.epochs + CASE WHEN p.budget > p.epochs * p.tokens THEN 1 ELSE 0 END)) AS epoch
        FROM rows r JOIN plan p USING (s))
), placed AS (
    SELECT *, sum(n) OVER (PARTITION BY s, epoch ORDER BY h) AS upto FROM copies
), chosen AS (
    SELECT *, least(
        floor(CASE WHEN tokens > 0 THEN (epoch * tokens + upto - n)::DOUBLE / budget
            ELSE ('0x' || h[1:3])::BIGINT::DOUBLE / 4096 END
            * greatest(1, ceil(total / 1e6)))::BIGINT,
        greatest(1, ceil(total / 1e6))::BIGINT - 1) AS block
    FROM placed WHERE epoch < epochs OR upto <= rest
)
SELECT i AS doc_id, source, n AS tokens, epoch, block,
    row_number() OVER (PARTITION BY block ORDER BY h, source, n) - 1 AS position
FROM chosen
"""

ORACLES["op8_cover_tree_search"] = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), scored AS (
    SELECT q.vec_id AS query_id, r.vec_id, list_dot_product(q.v, r.v)::BIGINT AS score
    FROM vectors q JOIN vectors r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# crc32 bit by bit; then, from the last turn to the first, the cheapest edits from each
# state of the grammar (start, after s, after u, after a), as (cost, audit) pairs.
ORACLES["op11_structure_repair"] = r"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
    FROM conversations
), faults AS (
    SELECT *, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ord(k[i])::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
            lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)), 4294967295) % 20 AS fault
    FROM keyed
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM faults
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place,
        rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
    FROM damaged
), judged AS (
    SELECT *, CASE WHEN bare = '' THEN 'b'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'd'
        WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) AS pair
    FROM placed
), whole AS (
    SELECT i.conv_id, count(place) AS n,
        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
        count(*) FILTER (fault = 't') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
        list({'role': role, 'text': text, 'kind': CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END,
              'fault': fault} ORDER BY place) AS turns
    FROM (SELECT DISTINCT conv_id FROM conversations) AS i
    LEFT JOIN judged ON i.conv_id IS NOT DISTINCT FROM judged.conv_id
    GROUP BY i.conv_id
), ways AS (
    SELECT conv_id, n AS i, turns,
        [{'c': 0, 'a': ''}, {'c': 6, 'a': 'II'}, {'c': 3, 'a': 'I'}, {'c': 0, 'a': ''}] AS f
    FROM whole
    UNION ALL
    SELECT conv_id, i - 1, turns, list_transform([1, 2, 3, 4], lambda s: list_min([
        g[s],
        {'c': g[[3, 3, 4, 3][s]].c + 3, 'a': 'I' || g[[3, 3, 4, 3][s]].a},
        {'c': g[[4, 4, 3, 4][s]].c + 6, 'a': 'II' || g[[4, 4, 3, 4][s]].a},
        {'c': g[[3, 3, 4, 3][s]].c + 9, 'a': 'III' || g[[3, 3, 4, 3][s]].a}]))
    FROM (
        SELECT conv_id, i, turns, list_transform([1, 2, 3, 4], lambda s: list_min([
            {'c': f[s].c + 4, 'a': 'D' || f[s].a},
            {'c': f[[3, 3, 4, 3][s]].c + CASE WHEN x.fault IN ('b', 'd') THEN 1000000 WHEN x.fault = 't' THEN 3 ELSE 0 END
                + CASE WHEN x.kind = [1, 1, 2, 1][s] THEN 0 ELSE 3 END,
             'a': CASE WHEN x.kind = [1, 1, 2, 1][s] THEN 'K' ELSE 'R' END || f[[3, 3, 4, 3][s]].a},
            {'c': f[2].c + CASE WHEN s > 1 OR x.kind > 0 OR x.fault IN ('b', 'd') THEN 1000000 WHEN x.fault = 't' THEN 3 ELSE 0 END,
             'a': 'K' || f[2].a}])) AS g
        FROM (SELECT *, turns[i] AS x FROM ways WHERE i > 0)
    )
), edits AS (SELECT conv_id, f[1].c AS cost, f[1].a AS audit FROM ways WHERE i = 0),
lines AS (
    SELECT whole.conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, turns,
        left(replace(audit, 'D', ''), 1) = 'K' AND turns[length(audit) - length(ltrim(audit, 'D')) + 1].kind = 0 AS sys
    FROM whole JOIN edits ON whole.conv_id IS NOT DISTINCT FROM edits.conv_id
)
SELECT conv_id, gaps, blank, duplicate, truncated, illegal, CAST(cost AS BIGINT) AS cost, audit,
    sha256(array_to_string(list_transform(
        list_filter(range(1, length(audit) + 1), lambda p: audit[p] <> 'D'),
        lambda p: CASE WHEN audit[p] = 'K' THEN turns[length(replace(audit[1:p], 'I', ''))].role
            WHEN (length(replace(audit[1:p], 'D', '')) - CASE WHEN sys THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
            || ':' || CASE WHEN audit[p] = 'I' THEN '' ELSE turns[length(replace(audit[1:p], 'I', ''))].text END
    ), chr(10))) AS repaired_sha256
FROM lines
"""
