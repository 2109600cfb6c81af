import json
import uuid

import pytest

from records import COMMENT, DROP, SUBMISSION, comment, frame, submission
from siltstone.operators import normalize
from siltstone.schema import COMMENT as COMMENTS
from siltstone.schema import SUBMISSION as SUBMISSIONS


def run(spark, lines, entity):
    rows = normalize.normalize(frame(spark, lines), entity)
    return [r.asDict() for r in sorted(rows.collect(), key=lambda r: r["file_path"])]


def outcomes(spark, entity, make, cases):
    """For (changes, reason or {column: value}) check each line's outcome."""
    rows = run(spark, [make(**changes) for changes, _ in cases], entity)
    for (changes, expected), row in zip(cases, rows):
        if isinstance(expected, str):
            assert row["reason"] == expected, changes
        else:
            assert row["reason"] is None, (changes, row["reason"])
            assert {k: row[k] for k in expected} == expected, changes


BIG = 2**63


def test_comment_rules(spark):
    flair = str(uuid.uuid4())
    cases = [
        ({}, dict(decoded_reddit_id=48559250926, reddit_id="mb2x9ta", author="ann", score=2,
                  decoded_subreddit_id=5858204, parent_type=3, parent_id="1zq8m4k",
                  decoded_parent_id=4337170436, edited_utc=None, stickied=False, locked=False,
                  created_utc=1706745600, ups=None, permalink=None, author_premium=None)),
        ({"author": DROP}, "missing author"),
        ({"author": None}, "invalid author"),
        ({"author": 5}, "invalid author"),
        ({"body": ["x"]}, "invalid body"),
        # Times
        ({"created_utc": "1251763200"}, dict(created_utc=1251763200)),
        ({"created_utc": 1706745600.5}, dict(created_utc=1706745601)),
        ({"created_utc": -1.5}, dict(created_utc=-2)),
        ({"created_utc": 1706745600.0}, dict(created_utc=1706745600)),
        ({"created_utc": " 5"}, "invalid created_utc"),
        ({"created_utc": "5\n"}, "invalid created_utc"),
        ({"created_utc": "1.5"}, "invalid created_utc"),
        ({"created_utc": True}, "invalid created_utc"),
        ({"created_utc": None}, "invalid created_utc"),
        ({"created_utc": BIG}, "invalid created_utc"),
        ({"created_utc": 1e30}, "invalid created_utc"),
        ({"created_utc": BIG - 1}, dict(created_utc=BIG - 1)),
        ({"edited": 1e9}, dict(edited_utc=10**9)),
        ({"edited": "77"}, dict(edited_utc=77)),
        ({"edited": True}, dict(edited_utc=None)),
        ({"edited": None}, dict(edited_utc=None)),
        ({"edited": DROP}, "missing edited"),
        ({"edited": {}}, "invalid edited"),
        # Scores
        ({"score": "-7"}, dict(score=-7)),
        ({"score": None}, dict(score=None)),
        ({"score": 2.0}, "invalid score"),
        ({"score": True}, "invalid score"),
        ({"score": DROP}, "missing score"),
        # Integers
        ({"ups": 2**31 - 1, "downs": -(2**31)}, dict(ups=2**31 - 1, downs=-(2**31))),
        ({"ups": 2**31}, "invalid ups"),
        ({"ups": 1.0}, "invalid ups"),
        ({"downs": "1"}, "invalid downs"),
        ({"retrieved_on": "1"}, "invalid retrieved_on"),
        ({"retrieved_on": None}, dict(retrieved_on=None)),
        ({"controversiality": "0"}, "invalid controversiality"),
        # Booleans
        ({"stickied": True}, dict(stickied=True)),
        ({"stickied": None}, "invalid stickied"),
        ({"locked": 0}, "invalid locked"),
        ({"author_premium": None}, dict(author_premium=None)),
        ({"author_premium": 1}, "invalid author_premium"),
        ({"parent_is_post": True}, dict(parent_is_post=True)),
        # References
        ({"parent_id": 47292772463},
         dict(parent_type=None, parent_id="lq4w8rz", decoded_parent_id=47292772463)),
        ({"parent_id": DROP}, dict(parent_type=None, parent_id=None, decoded_parent_id=None)),
        ({"parent_id": None}, dict(decoded_parent_id=None)),
        ({"parent_id": "t1_KOD"}, dict(parent_type=1, parent_id="KOD", decoded_parent_id=26797)),
        ({"parent_id": "tx_kod"}, "invalid parent_id"),
        ({"parent_id": "kod"}, "invalid parent_id"),
        ({"parent_id": "t3_"}, "invalid parent_id"),
        ({"parent_id": "t3_a_b"}, "invalid parent_id"),
        ({"parent_id": 1.5}, "invalid parent_id"),
        ({"subreddit_id": None}, "invalid subreddit_id"),
        ({"link_id": DROP}, "missing link_id"),
        ({"link_id": "t3_zzzzzzzzzzzzz"}, "invalid link_id"),
        # Enums and ignored keys
        ({"subreddit_type": "gold_only", "distinguished": "special"},
         dict(subreddit_type="gold_only", distinguished="special")),
        ({"subreddit_type": "Public"}, "invalid subreddit_type"),
        ({"distinguished": "x"}, "invalid distinguished"),
        ({"author_flair_template_id": flair}, {}),
        ({"author_flair_template_id": ""}, {}),
        ({"author_flair_template_id": None}, {}),
        ({"author_flair_template_id": "xyz"}, "invalid author_flair_template_id"),
        ({"author_flair_text": 1}, "invalid author_flair_text"),
        ({"all_awardings": [{"a": 1}], "_meta": {"x": None}}, {}),
        # Ids are decoded here and judged later
        ({"id": "invalid!@#"}, dict(decoded_reddit_id=None)),
        ({"id": "0MB2X9TA"}, dict(decoded_reddit_id=48559250926, reddit_id="0MB2X9TA")),
        ({"id": 5}, "invalid id"),
    ]
    outcomes(spark, COMMENTS, comment, cases)


def test_submission_rules(spark):
    flair = uuid.uuid4()
    cases = [
        ({}, dict(decoded_reddit_id=4337170436, title="A title", score=None, author=None,
                  num_comments=3, over_18=False, is_self=True, contest_mode=False, spoiler=None)),
        ({"edited": 5, "edited_utc": 9.6}, dict(edited_utc=10)),
        ({"edited_utc": False}, dict(edited_utc=None)),
        ({"score": "5"}, "invalid score"),
        ({"score": 5}, dict(score=5)),
        ({"stickied": None}, "invalid stickied"),
        ({"over_18": DROP}, "missing over_18"),
        ({"is_self": None}, "invalid is_self"),
        ({"num_comments": 2**31}, "invalid num_comments"),
        ({"num_crossposts": -1}, "invalid num_crossposts"),
        ({"num_crossposts": 2**32 - 1}, dict(num_crossposts=2**32 - 1)),
        ({"wls": 127}, {}),
        ({"wls": 128}, "invalid wls"),
        ({"link_flair_template_id": str(flair)}, dict(link_flair_template_id=flair.bytes)),
        ({"link_flair_template_id": flair.hex.upper()}, dict(link_flair_template_id=flair.bytes)),
        ({"link_flair_template_id": ""}, dict(link_flair_template_id=None)),
        ({"link_flair_template_id": "12-34"}, "invalid link_flair_template_id"),
        ({"crosspost_parent": "t3_d47"}, dict(decoded_crosspost_parent_id=16999)),
        ({"subreddit_id": "t5_3hk7w"}, dict(decoded_subreddit_id=5858204)),
        ({"gallery_data": {"a": [1]}, "media_metadata": 5}, {}),
        ({"selftext": DROP}, "missing selftext"),
        ({"url": 1}, "invalid url"),
    ]
    same = {
        "suggested_sort": "confidence controversial live new old qa random top",
        "removed_by_category": "author automod_filtered content_takedown deleted moderator reddit "
        "anti_evil_ops community_ops copyright_takedown",
        "subreddit_type": "public restricted user archived gold_restricted gold_only private employees_only",
        "post_hint": "gallery image link video",
    }
    changed = {"hosted:video": "hosted_video", "rich:video": "rich_video", "self": "slf"}
    cases += [({"post_hint": spelled}, {"post_hint": stored}) for spelled, stored in changed.items()]
    cases += [({"post_hint": stored}, "invalid post_hint") for stored in changed.values()]
    for key, words in same.items():
        cases += [({key: word}, {key: word}) for word in words.split()]
        cases += [({key: None}, {key: None}), ({key: "nope"}, f"invalid {key}")]
    outcomes(spark, SUBMISSIONS, submission, cases)


def test_lines_that_are_not_exactly_one_object(spark):
    good = comment()
    kept = ["﻿" + good, "\x00" + good, f"[{good}],", good + "\r", f"  {good} ", good]
    bad = ["", "   ", "null", "[1]", "{", "}", good + good, f"{good},{good}", good + " x}",
           good + "} {}", good + "] {}", good[:-1], "{}x" + good, good + "/*c*/{}",
           good.replace('"', "'"), good.replace("2,", "NaN,"), good.replace("some", "so\nme")]
    rows = run(spark, kept + bad, COMMENTS)
    assert [r["reason"] for r in rows[: len(kept)]] == [None] * len(kept)
    assert [r["reason"] for r in rows[len(kept):]] == ["malformed json"] * len(bad)


def test_braces_inside_values_and_forged_sentinels(spark):
    nested = comment(body='}{ "~": 1 }', extra={"a": [{}, {}]})
    forged = comment() + ',{"~":1}] {'
    rows = run(spark, [nested, forged], COMMENTS)
    assert [r["reason"] for r in rows] == [None, "malformed json"]
    assert rows[0]["body"] == '}{ "~": 1 }'


def test_repeated_keys(spark):
    good = comment()
    known = good[:-1] + ', "score": 3}'
    unknown = good[:-1] + ', "zz": 3, "zz": 4}'
    nested = good[:-1] + ', "q": {"score": 1, "score": 2}}'
    rows = run(spark, [known, unknown, nested], COMMENTS)
    assert [r["reason"] for r in rows] == ["repeated key", None, None]


def test_invalid_utf8_is_kept_as_base64(spark):
    lines = spark.createDataFrame(
        [("f", bytearray(b'{"author": "\xff"}'), None)],
        "file_path string, value binary, error string",
    ).selectExpr("file_path", "cast(value as string) value", "error")
    rejected = normalize.rejects(normalize.normalize(lines, COMMENTS)).collect()
    assert [(r["line"], r["reason"]) for r in rejected] == [("eyJhdXRob3IiOiAi/yJ9", "invalid utf-8")]


def test_table_shapes():
    assert len(COMMENTS.columns) == 25
    assert len(SUBMISSIONS.columns) == 41
    for entity, base in ((COMMENTS, COMMENT), (SUBMISSIONS, SUBMISSION)):
        stored = {r.stored for r in entity.rules if r.stored}
        derived = {"decoded_reddit_id", "parent_type", "decoded_parent_id"}
        assert stored | derived >= set(entity.columns)
        assert set(base) <= {r.key for r in entity.rules}


def test_schema_is_stable(spark):
    rows = normalize.normalize(frame(spark, [comment()]), COMMENTS)
    stored = rows.select(*COMMENTS.columns).schema
    assert [(f.name, f.dataType) for f in stored] == [
        (f.name, f.dataType) for f in COMMENTS.schema
    ]
    rows = normalize.normalize(frame(spark, [submission()]), SUBMISSIONS)
    stored = rows.select(*SUBMISSIONS.columns).schema
    assert [(f.name, f.dataType) for f in stored] == [
        (f.name, f.dataType) for f in SUBMISSIONS.schema
    ]


@pytest.mark.parametrize("text", ['"a\\ud800b"'])
def test_lone_surrogates_do_not_fail_the_job(spark, text):
    value = json.dumps(COMMENT).replace('"some text"', text)
    assert len(run(spark, [value], COMMENTS)) == 1
