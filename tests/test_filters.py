import pytest

from siltstone.operators import filters
from siltstone.operators.filters import FilterSpec
from pyspark.sql import functions as F

ROWS = [
    (1, "ann", "birds", 10, 100),
    (2, "bob", "birds", 1, 10),
    (3, "ann", "fish", None, 5),
    (4, None, None, 5, 50),
    (5, "Ann", "Birds", 7, 70),
]
SCHEMA = "id int, author string, subreddit string, score bigint, created_utc bigint"


def passing(spark, spec):
    rows = filters.apply_filter(spark.createDataFrame(ROWS, SCHEMA), spec)
    return sorted(r["id"] for r in rows.collect())


@pytest.mark.parametrize(
    "spec, ids",
    [
        (dict(), [1, 2, 3, 4, 5]),
        (dict(min_score=5), [1, 3, 4, 5]),
        (dict(max_score="10", min_score="+10"), [1, 3]),
        (dict(min_datetime=10, max_datetime=70), [2, 4, 5]),
        (dict(users="ann"), [1, 3]),
        (dict(users=["ann", "bob"], subreddits=["fish"]), [1, 2, 3]),
        (dict(subreddits={"birds"}), [1, 2]),
        (dict(subreddits={"nothing"}), []),
        (dict(users={"bob"}, subreddits={"fish"}, min_score=2), [3]),
    ],
)
def test_bounds_and_membership(spark, spec, ids):
    assert passing(spark, FilterSpec(**spec)) == ids


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_mean_the_same_in_both_forms_and_in_every_zone(spark, zone):
    texts = ["2019-01-31-08:00:00", "2019-1-3-8:0:5", "2019-13-01-00:00:00", "19-01-01-00:00:00", "2019-01-31 08:00:00",
             "2019-01-31-08:00:00 ", "2019-01-31-08:00:00+01", "2019-03-10-02:30:00", "", "2019-02-29-00:00:00", "2019-01-31-24:00:00"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [r[0] for r in df.select(filters.parse_datetime_column(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)

    def plain(t):
        try:
            return filters.parse_datetime(t)
        except ValueError:
            return None

    assert got == [plain(t) for t in texts]
    assert got[:2] == [1548921600, 1546502405] and got[2:7] == [None] * 5 and got[7] == 1552185000


def test_long_lists_join_with_the_same_result(spark):
    many = {f"nobody{i}" for i in range(1500)}
    assert passing(spark, FilterSpec(users=many | {"ann"}, subreddits={"Birds"})) == [1, 3, 5]
    assert passing(spark, FilterSpec(users=many)) == []


def test_list_frames_beyond_the_broadcast_size_still_match(spark, monkeypatch):
    monkeypatch.setattr(filters, "BROADCAST_BYTES", 0)
    rows = spark.createDataFrame(ROWS, SCHEMA)
    users = spark.createDataFrame([("ann",), ("ann",), (None,)], "name string")
    groups = spark.createDataFrame([("birds",)], "name string")
    kept = filters.keep_listed(rows, users, groups)
    assert kept.columns == rows.columns
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 3]
    assert filters.keep_listed(rows, users.where("false"), None).count() == 0


def test_inverted_bounds_warn(spark):
    with pytest.warns(UserWarning, match="score"):
        spec = FilterSpec(min_score=5, max_score=1)
    assert passing(spark, spec) == [3]
    with pytest.warns(UserWarning, match="datetime"):
        spec = FilterSpec(min_datetime=5, max_datetime=1)
    assert passing(spark, spec) == []


def test_arguments():
    assert filters.parse_datetime("2015-09-05-23:56:04") == 1441497364
    for bad in ("2015-09-05", "2015-09-05 23:56:04", "2015-13-05-00:00:00", "", "x"):
        with pytest.raises(ValueError):
            FilterSpec(min_datetime=bad)
    with pytest.raises(ValueError):
        FilterSpec(min_score="1.5")


def test_datetime_column(spark):
    texts = ["2015-09-05-23:56:04", "2015-09-05", "2015-13-05-00:00:00"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(filters.parse_datetime_column(F.col("t"))).collect()]
    assert got == [1441497364, None, None]


def test_line_test_never_drops_a_match(spark):
    spec = FilterSpec(users={"ann"}, subreddits={"birds"})
    lines = ['{"author":"ann"}', '{"author":"\\u0061nn"}', '{"author":"bob"}', '{"a":"\\u2019"}']
    rows = spark.createDataFrame([(x,) for x in lines], "value string")
    kept = [r[0] for r in rows.where(filters.may_match_line(spec, F.col("value"))).collect()]
    assert kept == lines[:2]
    odd = FilterSpec(users={'a"b'})
    assert rows.where(filters.may_match_line(odd, F.col("value"))).count() == 4
    accented = FilterSpec(users={"é"})
    assert rows.where(filters.may_match_line(accented, F.col("value"))).count() == 2
