"""The record filter: score and time bounds, and author/community membership.

A record passes when it is inside every given bound and, if any names are
given, its author or its community is one of them. A NULL score passes the score
bounds; a NULL author or community never matches a name.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the accepted datetime argument format, read as UTC.
DATETIME_FORMAT = "%Y-%m-%d-%H:%M:%S"
_DATETIME_PATTERN = "yyyy-M-d-H:m:sXXX"
# Both forms take a year of four digits, and one or two digits for what follows.
_DATETIME_SHAPE = r"[0-9]{4}(-[0-9]{1,2}){3}(:[0-9]{1,2}){2}"

# Above this many names the set is joined instead of written into the plan.
INLINE_NAMES = 1000
# Above this many names lines are parsed without looking for names first, which only
# costs time.
SOUGHT_NAMES = 50
# A name list is broadcast only up to this many bytes; beyond it the join shuffles.
BROADCAST_BYTES = 64 * 1024 * 1024


def parse_datetime(text: str) -> int:
    """Datetime argument to epoch seconds; ValueError when it does not fit the format."""
    try:
        if not re.fullmatch(_DATETIME_SHAPE, text, re.ASCII):
            raise ValueError("wrong shape")
        parsed = datetime.strptime(text, DATETIME_FORMAT)
    except ValueError as e:
        raise ValueError(
            f"{text!r} is not a time in the form {DATETIME_FORMAT}, as in 2019-01-31-08:00:00"
        ) from e
    return int(parsed.replace(tzinfo=timezone.utc).timestamp())


def parse_datetime_column(text: Column) -> Column:
    """Column form of :func:`parse_datetime`; NULL when malformed. Always UTC."""
    shaped = F.when(text.rlike(rf"\A{_DATETIME_SHAPE}\z"), F.concat(text, F.lit("+00:00")))
    return F.unix_seconds(F.try_to_timestamp(shaped, F.lit(_DATETIME_PATTERN)))


def _parse_score(value: int | str | None) -> int | None:
    if value is None or isinstance(value, int):
        return value
    if not re.fullmatch(r"[+-]?[0-9]+", value):
        raise ValueError(f"expected an integer score, got {value!r}")
    return int(value)


def _epoch(value: int | str | None) -> int | None:
    return parse_datetime(value) if isinstance(value, str) else value


def _names(values: str | Iterable[str]) -> frozenset[str]:
    return frozenset([values]) if isinstance(values, str) else frozenset(values)


@dataclass(frozen=True)
class FilterSpec:
    """Bounds are inclusive. Datetimes are given as text or as epoch seconds."""

    users: frozenset[str] = frozenset()
    subreddits: frozenset[str] = frozenset()
    min_score: int | str | None = None
    max_score: int | str | None = None
    min_datetime: int | str | None = None
    max_datetime: int | str | None = None

    def __post_init__(self):
        fix = object.__setattr__
        fix(self, "users", _names(self.users))
        fix(self, "subreddits", _names(self.subreddits))
        fix(self, "min_score", _parse_score(self.min_score))
        fix(self, "max_score", _parse_score(self.max_score))
        fix(self, "min_datetime", _epoch(self.min_datetime))
        fix(self, "max_datetime", _epoch(self.max_datetime))
        for what, low, high in (
            ("score", self.min_score, self.max_score),
            ("datetime", self.min_datetime, self.max_datetime),
        ):
            if low is not None and high is not None and high < low:
                outcome = "only records without a score" if what == "score" else "no record"
                warnings.warn(f"max {what} is below min {what}: {outcome} will pass", stacklevel=3)

    @property
    def names(self) -> frozenset[str]:
        return self.users | self.subreddits


def bounds(
    spec: FilterSpec, score: str | Column = "score", created: str | Column = "created_utc"
) -> Column:
    """Score and time bounds as one predicate."""
    score = F.col(score) if isinstance(score, str) else score
    created = F.col(created) if isinstance(created, str) else created
    test = F.lit(True)
    if spec.min_score is not None:
        test = test & (score.isNull() | (score >= spec.min_score))
    if spec.max_score is not None:
        test = test & (score.isNull() | (score <= spec.max_score))
    if spec.min_datetime is not None:
        test = test & (created >= spec.min_datetime)
    if spec.max_datetime is not None:
        test = test & (created <= spec.max_datetime)
    return test


def _is_listed(column: Column, names: frozenset[str]) -> Column:
    return F.coalesce(column.isin(sorted(names)), F.lit(False))


def membership(
    spec: FilterSpec, author: str | Column = "author", subreddit: str | Column = "subreddit"
) -> Column:
    """Author or community membership as one predicate; true when no names are given."""
    author = F.col(author) if isinstance(author, str) else author
    subreddit = F.col(subreddit) if isinstance(subreddit, str) else subreddit
    arms = []
    if spec.users:
        arms.append(_is_listed(author, spec.users))
    if spec.subreddits:
        arms.append(_is_listed(subreddit, spec.subreddits))
    if not arms:
        return F.lit(True)
    return arms[0] if len(arms) == 1 else arms[0] | arms[1]


def predicate(
    spec: FilterSpec,
    author: str | Column = "author",
    subreddit: str | Column = "subreddit",
    score: str | Column = "score",
    created: str | Column = "created_utc",
) -> Column:
    """The whole filter as one predicate over any table with these four columns."""
    return bounds(spec, score, created) & membership(spec, author, subreddit)


def _broadcast_if_small(names: DataFrame, column: str) -> DataFrame:
    size = names.agg(F.sum(F.octet_length(column) + 32).alias("n")).first()["n"] or 0
    return F.broadcast(names) if size <= BROADCAST_BYTES else names


def mark_listed(
    df: DataFrame,
    users: DataFrame | None,
    subreddits: DataFrame | None,
    mark: str,
    author: str = "author",
    subreddit: str = "subreddit",
) -> DataFrame:
    """Add ``mark``: whether the row's author or community is in the given lists.

    The lists are one-column DataFrames; None means no list was given. A list
    whose measured size is small is broadcast. A larger one is joined by
    shuffle, where AQE splits the partitions of frequent names.
    """
    found = []
    out = df
    for names, column in ((users, author), (subreddits, subreddit)):
        if names is None:
            continue
        hit, key = f"_listed_{column}", f"_name_{column}"
        listed = names.toDF(key).where(F.col(key).isNotNull()).distinct()
        listed = _broadcast_if_small(listed, key).withColumn(hit, F.lit(True))
        out = out.join(listed, F.col(column) == F.col(key), "left").drop(key)
        found.append(hit)
    listed_mark = F.coalesce(*[F.col(h) for h in found], F.lit(False)) if found else F.lit(True)
    return out.withColumn(mark, listed_mark).drop(*found)


def keep_listed(
    df: DataFrame,
    users: DataFrame | None,
    subreddits: DataFrame | None,
    author: str = "author",
    subreddit: str = "subreddit",
) -> DataFrame:
    """Membership test against name lists of any size held in DataFrames."""
    marked = mark_listed(df, users, subreddits, "_keep", author, subreddit)
    return marked.where("_keep").select(*df.columns)


def apply_filter(
    df: DataFrame,
    spec: FilterSpec,
    author: str = "author",
    subreddit: str = "subreddit",
    score: str = "score",
    created: str = "created_utc",
) -> DataFrame:
    """Keep the rows that pass; long name lists go through a join."""
    if len(spec.names) <= INLINE_NAMES:
        return df.where(predicate(spec, author, subreddit, score, created))
    spark = df.sparkSession
    return keep_listed(
        df.where(bounds(spec, score, created)),
        name_frame(spark, spec.users),
        name_frame(spark, spec.subreddits),
        author,
        subreddit,
    )


def name_frame(spark: SparkSession, names: frozenset[str]) -> DataFrame | None:
    if not names:
        return None
    return spark.createDataFrame([(n,) for n in sorted(names)], "name string")


def may_match_line(spec: FilterSpec, line: Column) -> Column:
    """Cheap test on the raw JSON line that never drops a line the filter would keep.

    A name can only appear verbatim or with ``\\u`` escapes (ASCII names: only
    ``\\u00XX``), so a line with neither cannot match. Names holding characters
    JSON must or may escape in another way turn the test off.
    """
    if not spec.names or len(spec.names) > SOUGHT_NAMES:
        return F.lit(True)
    if any(c in '"\\/' or ord(c) < 32 for n in spec.names for c in n):
        return F.lit(True)
    escape = "\\u00" if all(n.isascii() for n in spec.names) else "\\u"
    test = F.contains(line, F.lit(escape))
    for name in sorted(spec.names):
        test = test | F.contains(line, F.lit(name))
    return test
