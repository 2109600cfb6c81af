"""Searches over postings: terms, phrases, prefixes, proximity, booleans, ranking.

All take a postings DataFrame, stored or made on the fly: a row per term, field and
document (``entries_of``, ``TextIndex.entries``), or one per occurrence
(``postings_of``). Stored postings are pruned to the buckets of the searched terms.
Query terms must be folded tokens (see ``query_tokens``); one that ends in ``*``
stands for all terms that it begins, also within phrases.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.term_dictionary import is_prefix, matches
from siltstone.operators.text_index import TextIndex, block_bounds, term_bucket

# Fixed values of the ranking function.
K1 = 1.2
B = 0.75
IDF_FLOOR = 1e-6
# Blocks that a pruned ranking reads first, and how many it names in a scan's filter.
FIRST_BLOCKS = 16
LISTED_BLOCKS = 2000


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _grouped(postings: DataFrame) -> bool:
    """Whether postings have a row per term, field and document."""
    return "positions" in postings.columns


def _of_terms(postings: DataFrame, terms: list[str], field: str | None) -> DataFrame:
    """Postings of some terms, optionally in one field."""
    terms = sorted(set(terms))
    exact = [t for t in terms if not is_prefix(t)]
    conditions = [matches(F.col("term"), t) for t in terms if is_prefix(t)]
    if exact:
        conditions.append(F.col("term").isin(exact))
    out = postings.where(_any(conditions))
    if "term_bucket" in postings.columns and len(exact) == len(terms):
        homes = [term_bucket(F.lit(t), F.col("buckets")) for t in terms]
        out = out.where(F.col("term_bucket").isin(homes))
    return out if field is None else out.where(F.col("field") == field)


def term_docs(postings: DataFrame, term: str, field: str | None = None) -> DataFrame:
    """Documents holding the term in any field, or in one field."""
    return any_term_docs(postings, [term], field)


def prefix_docs(postings: DataFrame, prefix: str, field: str | None = None) -> DataFrame:
    """Documents holding a term that starts with ``prefix``."""
    return any_term_docs(postings, [f"{prefix}*"], field)


def phrase_hits(
    postings: DataFrame, phrases: list[list[str]], field: str | None = None
) -> DataFrame:
    """Occurrences of each phrase: doc_id, doc_len, field, phrase (its number), start.

    One scan serves all phrases. The position arrays of a document meet in one task;
    token number k of a phrase, moved back by k, leaves the starts that all its tokens
    have in common. The result is partitioned by document, but for single tokens, whose
    positions are hits as they are.
    """
    tokens = sorted({t for phrase in phrases for t in phrase})
    found = _of_terms(postings, tokens, field)
    if all(len(p) == 1 for p in phrases):
        numbers = [
            F.when(matches(F.col("term"), p[0]), F.lit(n)) for n, p in enumerate(phrases)
        ]
        start = F.explode("positions") if _grouped(postings) else F.col("pos")
        return (
            found.select("doc_id", "doc_len", "field", start.alias("start"), F.array(*numbers).alias("_n"))
            .select("doc_id", "doc_len", "field", F.explode(F.array_compact("_n")).alias("phrase"), "start")
            .select("doc_id", "doc_len", "field", "phrase", "start")
        )
    values = F.col("positions") if _grouped(postings) else F.col("pos")

    def places(number: int, token: str) -> Column:
        kept = F.collect_list(F.when(matches(F.col("term"), token), values))
        return (F.flatten(kept) if _grouped(postings) else kept).alias(f"_p{number}")

    per_field = (
        found.repartition("doc_id")
        .groupBy("doc_id", "field")
        .agg(F.first("doc_len").alias("doc_len"), *[places(n, t) for n, t in enumerate(tokens)])
    )

    def starts(phrase: list[str]) -> Column:
        moved = [
            F.expr(f"transform(_p{tokens.index(t)}, x -> x - {k})") for k, t in enumerate(phrase)
        ]
        return reduce(F.array_intersect, moved)

    each = [
        F.struct(F.lit(n).alias("phrase"), starts(p).alias("starts")) for n, p in enumerate(phrases)
    ]
    return (
        per_field.select("doc_id", "doc_len", "field", F.inline(F.array(*each)))
        .select("doc_id", "doc_len", "field", "phrase", F.explode("starts").alias("start"))
    )


def phrase_docs(postings: DataFrame, phrase: list[str], field: str | None = None) -> DataFrame:
    return phrase_hits(postings, [phrase], field).select("doc_id").distinct()


def near_docs(
    postings: DataFrame, phrases: list[list[str]], distance: int = 10, field: str | None = None
) -> DataFrame:
    """Documents with all phrases close together in one field, in any order.

    Close means that at most ``distance`` tokens lie between the end of any of
    the phrases and the start of the last one.
    """
    hits = phrase_hits(postings, phrases, field)
    # Window by document and field, over what lies together by document already.
    place = Window.partitionBy("doc_id", "field").orderBy("start")
    present = [
        F.max(F.when(F.col("phrase") == i, F.lit(True))).over(
            place.rangeBetween(-(distance + len(p)), 0)
        )
        for i, p in enumerate(phrases)
    ]
    together = reduce(lambda a, b: a & b, [F.coalesce(p, F.lit(False)) for p in present])
    return hits.select("doc_id", together.alias("close")).where("close").select("doc_id").distinct()


def all_terms_docs(postings: DataFrame, terms: list[str], field: str | None = None) -> DataFrame:
    """Documents holding every term, in one scan and one shuffle."""
    wanted = sorted(set(terms))
    marks = [F.max(F.when(matches(F.col("term"), t), 1).otherwise(0)).alias(f"_{i}")
             for i, t in enumerate(wanted)]
    every = reduce(lambda a, b: a & b, [F.col(f"_{i}") == 1 for i in range(len(wanted))])
    return _of_terms(postings, wanted, field).groupBy("doc_id").agg(*marks).where(every).select("doc_id")


def any_term_docs(postings: DataFrame, terms: list[str], field: str | None = None) -> DataFrame:
    found = _of_terms(postings, terms, field)
    if _grouped(postings) and len(set(terms)) == 1 and not is_prefix(terms[0]):
        # A row per document as it is, or of several fields the first.
        return found.where("first" if field is None else F.lit(True)).select("doc_id")
    return found.select("doc_id").distinct()


def all_of(*results: DataFrame) -> DataFrame:
    """Documents in every result (each holds a document once)."""
    merged = reduce(DataFrame.unionByName, results)
    counted = merged.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") == len(results)).select("doc_id")


def any_of(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results).distinct()


def but_not(result: DataFrame, excluded: DataFrame) -> DataFrame:
    return result.join(excluded, "doc_id", "left_anti")


def rows_of(table: DataFrame, result: DataFrame, key: str) -> DataFrame:
    """Content rows of the found documents."""
    return table.join(result.withColumnRenamed("doc_id", key), key, "left_semi").select(
        *table.columns
    )


def _frequencies(
    postings: DataFrame, phrases: list[list[str]], field: str | None, weights: dict[str, float] | None
) -> DataFrame:
    """doc_id, doc_len, and per phrase ``tf_i``, its weighted frequency (null for none)."""
    weight: Column = F.lit(1.0)
    if weights:
        pairs = [F.lit(x) for item in weights.items() for x in item]
        weight = F.coalesce(F.create_map(*pairs)[F.col("field")].cast("double"), F.lit(1.0))
    if _grouped(postings) and all(len(p) == 1 for p in phrases):
        hits = _of_terms(postings, [p[0] for p in phrases], field)
        tfs = [F.when(matches(F.col("term"), p[0]), weight * F.col("tf")) for p in phrases]
    else:
        hits = phrase_hits(postings, phrases, field)
        tfs = [F.when(F.col("phrase") == i, weight) for i in range(len(phrases))]
    return hits.groupBy("doc_id").agg(
        F.first("doc_len").alias("doc_len"), *[F.sum(tf).alias(f"tf_{i}") for i, tf in enumerate(tfs)]
    )


def _part(tf: Column, doc_len: Column, mean: Column | float) -> Column:
    """What a phrase of this frequency adds to a rank, but for its weight in the corpus.

    Larger for larger frequencies and for shorter documents.
    """
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * doc_len / mean))


def _idf(n: Column | float, df: Column) -> Column:
    return F.greatest(F.log((n - df + 0.5) / (df + 0.5)), F.lit(IDF_FLOOR))


def ranked(
    postings: DataFrame,
    docs: DataFrame,
    phrases: list[list[str]],
    *,
    require_all: bool = True,
    weights: dict[str, float] | None = None,
    field: str | None = None,
) -> DataFrame:
    """BM25 rank of matching documents: doc_id, rank (smaller is better).

    Each posting carries its document's length, so ranking joins nothing; the
    corpus size and the document counts per phrase are one-row subqueries.
    """
    numbers = range(len(phrases))
    per_doc = _frequencies(postings, phrases, field, weights)
    corpus = docs.agg(
        F.struct(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.avg("doc_len").alias("mean"),
        )
    ).scalar()
    # Reading doc_len here too gives both uses of per_doc the same shuffle, which
    # Spark then runs once.
    sized = F.col("doc_len").isNotNull()
    found = per_doc.agg(
        F.array(*[
            F.count(F.when(sized, F.col(f"tf_{i}"))).cast("double") for i in numbers
        ])
    ).scalar()
    scored = per_doc.select("*", corpus.alias("_corpus"), found.alias("_found"))
    total: Column = F.lit(0.0)
    for i in numbers:
        tf, df = F.coalesce(F.col(f"tf_{i}"), F.lit(0.0)), F.get("_found", F.lit(i))
        total = total + _idf(F.col("_corpus.n"), df) * _part(tf, F.col("doc_len"), F.col("_corpus.mean"))
    if require_all:
        for i in numbers:
            scored = scored.where(F.col(f"tf_{i}").isNotNull())
    return scored.select("doc_id", (-total).alias("rank"))


def top_k(ranks: DataFrame, k: int) -> DataFrame:
    """Best ``k`` documents, ties by id."""
    return ranks.orderBy("rank", "doc_id").limit(k)

def best_of_index(
    index: TextIndex,
    tokens: list[str],
    k: int,
    *,
    require_all: bool = True,
    weights: dict[str, float] | None = None,
    field: str | None = None,
    digits: int | None = None,
) -> DataFrame:
    """The ``k`` best documents for some terms, as ``top_k`` of ``ranked`` gives them, from
    few of their postings: doc_id, rank (rounded to ``digits`` if given).

    The bounds of a block of documents limit the rank that any of them can have. The
    blocks of the best bounds are read first; their k-th rank then rules out each block
    whose bound is worse, and the others are read. Blocks whose bound equals the k-th rank
    are read too, so ties come out as in the full ranking.
    """
    if weights and min(weights.values()) < 0:
        raise ValueError("a weight below zero has no upper bound")
    if any(is_prefix(t) for t in tokens):
        raise ValueError("a prefix has no bounds: use ranked")
    terms = sorted(set(tokens))
    n, length = index.corpus()
    postings = _of_terms(index.entries(terms), terms, field)
    if not n or not terms:
        return _scored(postings.where("false"), terms, {}, 1.0, 1.0, weights, require_all, digits)
    mean = length / n
    df = _document_counts(index, postings, terms, field)
    idf = {t: _idf(F.lit(float(n)), F.lit(float(df[t]))) for t in terms}
    blocks = _bounded_blocks(index, postings, terms, field, weights, idf, mean, require_all)
    slack = 1e-9 if digits is None else 0.51 * 10.0**-digits
    spark = index.spark
    first = blocks.orderBy(F.desc("bound"), "batch", "block").limit(FIRST_BLOCKS).collect()
    chosen = {(r["batch"], r["block"]) for r in first}

    def scored(rows: DataFrame) -> DataFrame:
        return top_k(_scored(rows, terms, idf, float(n), mean, weights, require_all, digits), k)

    if len(first) < FIRST_BLOCKS:
        return scored(_in_blocks(postings, chosen))
    worst = [r["rank"] for r in scored(_in_blocks(postings, chosen)).collect()]
    least = -worst[-1] - slack if len(worst) == k else float("-inf")
    more = blocks.where(F.col("bound") >= least)
    listed = more.select("batch", "block").limit(LISTED_BLOCKS + 1).collect()
    if len(listed) <= LISTED_BLOCKS:
        return scored(_in_blocks(postings, chosen | {tuple(r) for r in listed}))
    some = spark.createDataFrame(sorted(chosen), "batch int, block bigint")
    wanted = more.select("batch", "block").unionByName(some).distinct()
    return scored(postings.join(wanted, ["batch", "block"], "left_semi"))


def _in_blocks(postings: DataFrame, blocks: set[tuple[int, int]]) -> DataFrame:
    """Postings of some blocks; the condition reaches the files' page index."""
    by_batch: dict[int, list[int]] = {}
    for batch, block in sorted(blocks):
        by_batch.setdefault(batch, []).append(block)
    conditions = [
        (F.col("batch") == batch) & F.col("block").isin(numbers) for batch, numbers in by_batch.items()
    ]
    return postings.where(_any(conditions) if conditions else F.lit(False))


def _document_counts(
    index: TextIndex, postings: DataFrame, terms: list[str], field: str | None
) -> dict[str, int]:
    """Documents that hold each term: from the dictionary, or where some were removed by
    counting postings."""
    counts = dict.fromkeys(terms, 0)
    if index._has_removed():
        rows = postings.where("first" if field is None else F.lit(True)).groupBy("term").count()
        return counts | {r["term"]: r["count"] for r in rows.collect()}
    # A row per term and batch.
    for row in index.lookup(terms).collect():
        n = row["docs"] if field is None else row["field_docs"][index.fields.index(field)]
        counts[row["term"]] += n
    return counts


def _bounded_blocks(
    index: TextIndex, postings: DataFrame, terms: list[str], field: str | None,
    weights: dict[str, float] | None, idf: dict[str, Column], mean: float, require_all: bool,
) -> DataFrame:
    """batch, block, bound: no document of the block ranks better than ``-bound``.

    Rare terms have no stored bounds; theirs are taken from their postings.
    """
    stored = index.bounds(terms)
    if field is not None:
        stored = stored.where(F.col("field") == field)
    frequent = stored.select("batch", "term").distinct()
    rare = (
        postings.join(F.broadcast(frequent), ["batch", "term"], "left_anti")
        .groupBy("batch", "block", "term", "field")
        .agg(*block_bounds())
    )
    columns = ["batch", "block", "term", "field", "most", "densest"]
    every = stored.select(*columns).unionByName(rare.select(*columns))
    weight: Column = F.lit(1.0)
    if weights:
        pairs = [F.lit(x) for item in weights.items() for x in item]
        weight = F.coalesce(F.create_map(*pairs)[F.col("field")].cast("double"), F.lit(1.0))
    sums = [
        F.sum(F.when(F.col("term") == t, weight * F.col(c))).alias(f"{c}_{i}")
        for i, t in enumerate(terms) for c in ("most", "densest")
    ]
    parts = every.groupBy("batch", "block").agg(*sums)
    total: Column = F.lit(0.0)
    for i, t in enumerate(terms):
        # ``_part`` divided through by the frequency, which leaves the share of the document.
        most, densest = F.col(f"most_{i}"), F.col(f"densest_{i}")
        part = (K1 + 1) / (1 + K1 * ((1 - B) / most + B / (densest * mean)))
        total = total + F.coalesce(idf[t] * part, F.lit(0.0))
        if require_all:
            parts = parts.where(F.col(f"most_{i}").isNotNull())
    return parts.select("batch", "block", total.alias("bound"))


def _scored(
    postings: DataFrame, terms: list[str], idf: dict[str, Column], n: float, mean: float,
    weights: dict[str, float] | None, require_all: bool, digits: int | None,
) -> DataFrame:
    per_doc = _frequencies(postings, [[t] for t in terms], None, weights) if terms else None
    if per_doc is None:
        return postings.select("doc_id", F.lit(0.0).alias("rank"))
    total: Column = F.lit(0.0)
    for i, t in enumerate(terms):
        tf = F.coalesce(F.col(f"tf_{i}"), F.lit(0.0))
        total = total + idf.get(t, F.lit(0.0)) * _part(tf, F.col("doc_len"), mean)
        if require_all:
            per_doc = per_doc.where(F.col(f"tf_{i}").isNotNull())
    rank = -total if digits is None else F.round(-total, digits)
    return per_doc.select("doc_id", rank.alias("rank"))


def snippets(
    rows: DataFrame,
    key: str,
    field: str,
    phrases: list[list[str]],
    *,
    tokens_shown: int = 15,
    before: str = "[",
    after: str = "]",
    ellipsis: str = "...",
) -> DataFrame:
    """A short excerpt per matching row: doc_id, snippet.

    The excerpt is the run of ``tokens_shown`` tokens starting at an occurrence
    that covers the most different phrases, the earliest such run on ties.
    """
    from siltstone.functions import text as t
    from siltstone.operators.text_index import postings_of

    hits = phrase_hits(postings_of(rows, key, (field,)), phrases)
    ahead = (
        Window.partitionBy("doc_id").orderBy("start").rangeBetween(0, tokens_shown - 1)
    )
    covered = sum(
        (F.coalesce(F.max(F.when(F.col("phrase") == i, 1)).over(ahead), F.lit(0))
         for i in range(len(phrases))),
        F.lit(0),
    )
    best = (
        hits.select("doc_id", "start", covered.alias("covered"))
        .groupBy("doc_id")
        .agg(F.min_by("start", F.struct(-F.col("covered"), F.col("start"))).alias("start"))
    )
    # Each piece is one token with the separators that follow it.
    inside = rf"(?:{t.TOKEN_CLASS}|[{t.MARKS}])"
    piece = F.lit(rf"(?s){inside}+(?:(?!{inside}).)*")
    pieces = F.regexp_extract_all(F.col(field), piece, F.lit(0))
    shown = F.slice("_pieces", F.col("start") + 1, tokens_shown)
    more = F.col("start") + tokens_shown < F.size("_pieces")
    return (
        rows.select(F.col(key).alias("doc_id"), pieces.alias("_pieces"))
        .join(best, "doc_id")
        .select(
            "doc_id",
            F.concat(
                F.when(F.col("start") > 0, F.lit(ellipsis)).otherwise(F.lit("")),
                t.highlight(F.rtrim(F.array_join(shown, "")), phrases, before, after),
                F.when(more, F.lit(ellipsis)).otherwise(F.lit("")),
            ).alias("snippet"),
        )
    )
