"""Declared record rules and table schemas.

Nothing here is inferred from data: each entity states every JSON key it looks
at, the rule the key must satisfy, and where the value is stored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# How a key may be absent or null.
REQUIRED = "required"  # missing or null rejects the record
NULLABLE = "nullable"  # missing rejects, null is stored as NULL
OPTIONAL = "optional"  # missing and null are stored as NULL
DEFAULT_FALSE = "default_false"  # missing is false, null rejects

# Accepted enum spellings and the text stored for each.
SUBREDDIT_TYPES = {
    "public": "public",
    "restricted": "restricted",
    "user": "user",
    "archived": "archived",
    "gold_restricted": "gold_restricted",
    "gold_only": "gold_only",
    "private": "private",
    "employees_only": "employees_only",
}
DISTINGUISHED = {"admin": "admin", "moderator": "moderator", "special": "special"}
SUGGESTED_SORTS = {
    "confidence": "confidence",
    "controversial": "controversial",
    "live": "live",
    "new": "new",
    "old": "old",
    "qa": "qa",
    "random": "random",
    "top": "top",
}
POST_HINTS = {
    "gallery": "gallery",
    "hosted:video": "hosted_video",
    "image": "image",
    "link": "link",
    "rich:video": "rich_video",
    "self": "slf",
    "video": "video",
}
REMOVED_BY = {
    "author": "author",
    "automod_filtered": "automod_filtered",
    "content_takedown": "content_takedown",
    "deleted": "deleted",
    "moderator": "moderator",
    "reddit": "reddit",
    "anti_evil_ops": "anti_evil_ops",
    "community_ops": "community_ops",
    "copyright_takedown": "copyright_takedown",
}


@dataclass(frozen=True)
class Rule:
    """One JSON key: its kind, whether it may be absent, and its stored name.

    ``stored`` is None for keys that are only type-checked. Kinds are ``string``,
    ``bool``, ``int8``, ``int32``, ``uint32``, ``int64``, ``time``, ``loose_time``,
    ``score``, ``ref``, ``uuid``, ``enum`` and ``any``.
    """

    key: str
    kind: str
    presence: str = OPTIONAL
    stored: str | None = None
    values: dict[str, str] | None = None


@dataclass(frozen=True)
class Entity:
    name: str
    rules: tuple[Rule, ...]
    schema: T.StructType
    text_fields: tuple[str, ...]

    @property
    def key(self) -> str:
        return "decoded_reddit_id"

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _rules(kind: str, presence: str, *keys: str, stored: bool = True) -> list[Rule]:
    return [Rule(k, kind, presence, k if stored else None) for k in keys]


def _table(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in columns])


_S, _B, _I, _L = T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType()

COMMENT = Entity(
    name="comment",
    rules=(
        *_rules("string", REQUIRED, "author", "body", "subreddit"),
        Rule("id", "string", REQUIRED, "reddit_id"),
        Rule("subreddit_id", "ref", REQUIRED, "decoded_subreddit_id"),
        Rule("link_id", "ref", REQUIRED),
        Rule("parent_id", "ref", OPTIONAL, "parent_id"),
        Rule("subreddit_type", "enum", OPTIONAL, "subreddit_type", SUBREDDIT_TYPES),
        Rule("distinguished", "enum", OPTIONAL, "distinguished", DISTINGUISHED),
        Rule("score", "score", NULLABLE, "score"),
        Rule("created_utc", "time", REQUIRED, "created_utc"),
        Rule("edited", "loose_time", NULLABLE, "edited_utc"),
        Rule("retrieved_on", "int64", OPTIONAL, "retrieved_on"),
        *_rules("int32", OPTIONAL, "ups", "downs"),
        Rule("permalink", "string", OPTIONAL, "permalink"),
        Rule("author_premium", "bool", OPTIONAL, "author_premium"),
        *_rules(
            "bool", DEFAULT_FALSE,
            "stickied", "parent_is_post", "is_submitter", "archived", "locked", "collapsed",
        ),
        *_rules("string", OPTIONAL, "author_flair_text", "author_flair_css_class", stored=False),
        Rule("author_flair_template_id", "uuid"),
        Rule("controversiality", "int32"),
    ),
    schema=_table(
        ("decoded_reddit_id", _L, False),
        ("reddit_id", _S, False),
        ("permalink", _S, True),
        ("author", _S, True),
        ("author_premium", _B, True),
        ("subreddit", _S, False),
        ("subreddit_type", _S, True),
        ("decoded_subreddit_id", _L, False),
        ("body", _S, True),
        ("score", _L, True),
        ("ups", _I, True),
        ("downs", _I, True),
        ("created_utc", _L, False),
        ("retrieved_on", _L, True),
        ("edited_utc", _L, True),
        ("parent_type", _I, True),
        ("parent_id", _S, True),
        ("decoded_parent_id", _L, True),
        ("stickied", _B, False),
        ("parent_is_post", _B, False),
        ("is_submitter", _B, False),
        ("archived", _B, False),
        ("locked", _B, False),
        ("collapsed", _B, False),
        ("distinguished", _S, True),
    ),
    text_fields=("body",),
)

SUBMISSION = Entity(
    name="submission",
    rules=(
        *_rules("string", REQUIRED, "permalink", "title", "selftext"),
        Rule("id", "string", REQUIRED, "reddit_id"),
        Rule("num_comments", "int32", REQUIRED, "num_comments"),
        *_rules("bool", REQUIRED, "over_18", "is_self"),
        Rule("created_utc", "time", REQUIRED, "created_utc"),
        Rule("edited_utc", "loose_time", OPTIONAL, "edited_utc"),
        Rule("score", "int64", OPTIONAL, "score"),
        *_rules(
            "string", OPTIONAL,
            "author", "url", "domain", "author_flair_text", "subreddit", "link_flair_text",
        ),
        *_rules(
            "bool", OPTIONAL,
            "author_premium", "spoiler", "pinned", "is_original_content", "quarantine",
        ),
        *_rules(
            "bool", DEFAULT_FALSE,
            "stickied", "is_created_from_ads_ui", "is_gallery", "is_video",
            "is_reddit_media_domain", "contest_mode",
        ),
        *_rules("uuid", OPTIONAL, "author_flair_template_id", "link_flair_template_id"),
        Rule("subreddit_id", "ref", OPTIONAL, "decoded_subreddit_id"),
        Rule("crosspost_parent", "ref", OPTIONAL, "decoded_crosspost_parent_id"),
        Rule("num_crossposts", "uint32", OPTIONAL, "num_crossposts"),
        *_rules("int32", OPTIONAL, "ups", "downs"),
        *_rules("int64", OPTIONAL, "retrieved_on", "subreddit_subscribers"),
        Rule("suggested_sort", "enum", OPTIONAL, "suggested_sort", SUGGESTED_SORTS),
        Rule("post_hint", "enum", OPTIONAL, "post_hint", POST_HINTS),
        Rule("removed_by_category", "enum", OPTIONAL, "removed_by_category", REMOVED_BY),
        Rule("subreddit_type", "enum", OPTIONAL, "subreddit_type", SUBREDDIT_TYPES),
        *_rules("any", OPTIONAL, "gallery_data", "media_metadata", stored=False),
        *_rules("string", OPTIONAL, "url_overridden_by_dest", "whitelist_status", stored=False),
        Rule("wls", "int8"),
    ),
    schema=_table(
        ("decoded_reddit_id", _L, False),
        ("reddit_id", _S, False),
        ("author", _S, True),
        ("author_premium", _B, True),
        ("title", _S, False),
        ("author_flair_text", _S, True),
        ("author_flair_template_id", T.BinaryType(), True),
        ("link_flair_template_id", T.BinaryType(), True),
        ("link_flair_text", _S, True),
        ("subreddit", _S, True),
        ("decoded_subreddit_id", _L, True),
        ("subreddit_subscribers", _L, True),
        ("subreddit_type", _S, True),
        ("suggested_sort", _S, True),
        ("decoded_crosspost_parent_id", _L, True),
        ("post_hint", _S, True),
        ("removed_by_category", _S, True),
        ("selftext", _S, True),
        ("permalink", _S, True),
        ("domain", _S, True),
        ("url", _S, True),
        ("score", _L, True),
        ("ups", _I, True),
        ("downs", _I, True),
        ("created_utc", _L, False),
        ("edited_utc", _L, True),
        ("retrieved_on", _L, True),
        ("is_self", _B, False),
        ("over_18", _B, False),
        ("spoiler", _B, True),
        ("pinned", _B, True),
        ("stickied", _B, False),
        ("is_created_from_ads_ui", _B, False),
        ("is_gallery", _B, False),
        ("is_video", _B, False),
        ("is_original_content", _B, True),
        ("is_reddit_media_domain", _B, False),
        ("quarantine", _B, True),
        ("num_comments", _I, False),
        ("contest_mode", _B, False),
        ("num_crossposts", _L, True),
    ),
    text_fields=("title", "selftext"),
)

ENTITIES = {e.name: e for e in (COMMENT, SUBMISSION)}
