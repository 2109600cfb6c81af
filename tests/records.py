"""Record builders shared by the tests."""

import json

COMMENT = {
    "author": "ann",
    "body": "some text",
    "subreddit": "birds",
    "subreddit_id": "t5_3hk7w",
    "id": "mb2x9ta",
    "link_id": "t3_1zq8m4k",
    "parent_id": "t3_1zq8m4k",
    "score": 2,
    "created_utc": 1706745600,
    "edited": False,
}
SUBMISSION = {
    "permalink": "/r/birds/1/",
    "title": "A title",
    "selftext": "",
    "id": "1zq8m4k",
    "num_comments": 3,
    "over_18": False,
    "is_self": True,
    "created_utc": 1706745600,
}
DROP = object()


def line(base, **changes):
    record = {**base, **changes}
    return json.dumps({k: v for k, v in record.items() if v is not DROP})


def comment(**changes):
    return line(COMMENT, **changes)


def submission(**changes):
    return line(SUBMISSION, **changes)


def frame(spark, lines):
    rows = [(f"file{i:03d}", value, None) for i, value in enumerate(lines)]
    return spark.createDataFrame(rows, "file_path string, value string, error string")
