"""Temperature mixing of sources, in DataFrame functions only.

The token share of each source is raised to an exponent between 0 (all sources
alike) and 1 (as they are) and normalised. Bisection finds the exponent that meets a
target entropy, and the least one that keeps a limit of repetitions. A source's
budget is filled with whole permutations of its rows, then with the start of one
more; cutting all sources into the same number of blocks mixes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import plain_names, shared_dir, stored

#: Hex digits of the permutation hash that make a cell; sums over cells are what
#: orders a source, so that no source is ever sorted in one task.
CELL_DIGITS = 3
ROUNDS = 60
#: Up to so many sources (of a few numbers each) are broadcast; more are joined by
#: source and salt, so that no source's rows meet in one task either way.
BROADCAST_SOURCES = 100_000
SALTS = 64
#: A word, for the default count of tokens.
WORD = r"[^\x20\x09-\x0D]+"


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def narrow_rows(
    docs: DataFrame, id_column: str = "doc_id", source: str = "source", tokens: Column | None = None
) -> DataFrame:
    """``i, source, s, n``: the id, the source, a key of it that is never null, tokens."""
    return docs.select(
        F.col(id_column).alias("i"), F.col(source).alias("source"), source_key(F.col(source)).alias("s"),
        (tokens if tokens is not None else count_words(F.col("text"))).alias("n"),
    )


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _sum(array: Column, f) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, x: a + f(x))


def _entropy(shares: Column, exponent: Column) -> Column:
    z = _sum(shares, lambda x: F.pow(x, exponent))
    e = _sum(shares, lambda x: F.pow(x, exponent) * F.ln(x))
    return F.ln(z) - exponent * e / z


def _most_repeated(shares: Column, exponent: Column, budget: Column) -> Column:
    """The largest number of epochs: weight by share, times budget by all tokens."""
    z = _sum(shares, lambda x: F.pow(x, exponent))
    return F.array_max(F.transform(shares, lambda x: F.pow(x, exponent - 1))) / z * budget


def _bisect(go_up) -> Column:
    """The exponent in [0, 1] above which ``go_up`` is false; 1 if it never is."""
    state = F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")),
        lambda s, _: F.struct(
            F.when(go_up((s["lo"] + s["hi"]) / 2), (s["lo"] + s["hi"]) / 2).otherwise(s["lo"]).alias("lo"),
            F.when(go_up((s["lo"] + s["hi"]) / 2), s["hi"]).otherwise((s["lo"] + s["hi"]) / 2).alias("hi"),
        ),
    )
    return state["hi"]


def plan(
    rows: DataFrame, entropy_share: float | None = 0.95, most_epochs: float | None = 4.0,
    budget_share: float = 1.0,
) -> DataFrame:
    """``s, tokens, weight, budget, epochs, rest, total_budget`` of each source.

    The target entropy is ``entropy_share`` of that of equal weights; one below that
    of the sources as they are leaves them so. ``most_epochs`` then raises the
    exponent, to 1 at most, until no source is repeated more often. The budget is
    ``budget_share`` of all tokens. A source without tokens has weight 0 and goes
    once; no rows give no sources. One row holds the token count of every source, so
    their number is what must fit into a task, not their rows.
    """
    sources = rows.groupBy("s").agg(F.sum("n").alias("tokens"))
    whole = sources.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"),
        F.array_sort(F.collect_list(F.when(F.col("tokens") > 0, F.col("tokens")))).alias("each"),
    ).select("total", F.transform("each", lambda t: t / F.col("total")).alias("shares"))
    shares = F.col("shares")
    up_to = F.lit(0.0)
    if entropy_share is not None:
        target = F.ln(F.size(shares).cast("double")) * entropy_share
        up_to = F.greatest(up_to, _bisect(lambda x: _entropy(shares, x) > target))
    if most_epochs is not None:
        up_to = F.greatest(
            up_to,
            _bisect(lambda x: _most_repeated(shares, x, F.lit(budget_share)) > F.lit(float(most_epochs))),
        )
    if entropy_share is None and most_epochs is None:
        up_to = F.lit(1.0)
    fixed = whole.select("total", up_to.alias("exponent"), shares).select(
        "total", "exponent", _sum(shares, lambda x: F.pow(x, F.col("exponent"))).alias("z"),
        F.floor(F.col("total") * F.lit(budget_share)).alias("total_budget"),
    )
    weight = F.when(
        F.col("tokens") > 0, F.pow(F.col("tokens") / F.col("total"), F.col("exponent")) / F.col("z")
    ).otherwise(0.0)
    # ``fixed`` is one row.
    return (
        sources.join(F.broadcast(fixed))
        .withColumn("weight", weight)
        .withColumn("budget", F.floor(F.col("weight") * F.col("total_budget")))
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(1))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
        .select("s", "tokens", "weight", "budget", "epochs", "rest", "total_budget")
    )


def _with_sources(rows: DataFrame, key: str, sources: DataFrame) -> DataFrame:
    """Rows with the columns of their source, whose key is ``s`` in ``sources``."""
    if sources.count() <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(sources), F.col(key) == F.col("s"))
    salted = sources.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    on = (F.col(key) == F.col("s")) & (F.col("__salted") == F.col("__salt"))
    return rows.withColumn("__salted", salt).join(salted, on).drop("__salted", "__salt")


def permutation_hash(i: Column, epoch: Column) -> Column:
    """Where a row stands in its source's permutation of an epoch; a null id has a place too."""
    return F.md5(F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("null")), epoch.cast("string")))


def _placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Every row in every epoch of its source that its budget reaches, with ``upto``:

    the tokens of the epoch up to and with this row and those of equal hash.
    """
    copies = (
        _with_sources(rows.withColumnRenamed("s", "key"), "key", sources).drop("key")
        .where("tokens = 0 OR epochs > 0 OR rest > 0")
        .withColumn("epoch", F.explode(F.expr("sequence(0L, epochs - IF(rest > 0, 0L, 1L))")))
        .withColumn("h", permutation_hash(F.col("i"), F.col("epoch")))
        .withColumn("cell", F.substring("h", 1, CELL_DIGITS))
    )
    before = Window.partitionBy("s", "epoch").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        copies.groupBy("s", "epoch", "cell").agg(F.sum("n").alias("m"))
        .select("s", "epoch", "cell", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("s", "epoch", "cell").orderBy("h")
    return copies.join(bases, ["s", "epoch", "cell"]).withColumn(
        "upto", F.col("base") + F.sum("n").over(within)
    )


def _reached() -> Column:
    return (F.col("epoch") < F.col("epochs")) | (F.col("upto") <= F.col("rest"))


def schedule(rows: DataFrame, sources: DataFrame, block_tokens: int = 1_000_000) -> DataFrame:
    """``i, source, n, epoch, block, position`` of each copy that the budgets pay for.

    Of the last epoch a source goes as far as its budget reaches; rows of equal id
    go together. Each source is spread evenly over all blocks, and rows lie in a
    block in the order of their hash, repeated rows next to each other.
    """
    total = F.col("total_budget")
    blocks = F.greatest(F.lit(1.0), F.ceil(total / F.lit(float(block_tokens))).cast("double"))
    passed = (F.col("epoch") * F.col("tokens") + F.col("upto") - F.col("n")).cast("double")
    part = F.when(F.col("tokens") > 0, passed / F.col("budget")).otherwise(
        F.conv("cell", 16, 10).cast("double") / 16**CELL_DIGITS
    )
    chosen = _placed(rows, sources).where(_reached()).withColumn(
        "block", F.least(F.floor(part * blocks), blocks.cast("bigint") - 1)
    )
    order = Window.partitionBy("block").orderBy("h", "source", "n")
    return chosen.select(
        "i", "source", "n", "epoch", "block",
        (F.row_number().over(order) - 1).cast("bigint").alias("position"),
    )


def mix(
    docs: DataFrame, id_column: str = "doc_id", source: str = "source", tokens: Column | None = None,
    folder: str | None = None, **settings,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it.

    Only ids, sources and token counts are shuffled: a source's last epoch ends at a
    hash, which decides for every row where it lies.
    """
    folder = folder or shared_dir(docs.sparkSession)
    rows = stored(narrow_rows(docs, id_column, source, tokens), f"{folder}/rows")
    sources = stored(plan(rows, **settings), f"{folder}/sources")
    last = (
        _placed(rows, sources).where("epoch = epochs AND upto <= rest")
        .groupBy("s").agg(F.max("h").alias("__until"))
    )
    ends = sources.join(last, "s", "left").select("s", F.col("epochs").alias("__epochs"), "__until")
    plain, (id_name, source_name) = plain_names(docs, id_column, source)
    more = permutation_hash(F.col(id_name), F.col("__epochs")) <= F.col("__until")
    times = F.col("__epochs") + F.coalesce(more, F.lit(False)).cast("bigint")
    return (
        _with_sources(plain.withColumn("__key", source_key(F.col(source_name))), "__key", ends)
        .withColumn("__copy", F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
        .select(*plain.columns).toDF(*docs.columns)
    )
