"""Every registered query against its SQL equivalent on the smallest test tables."""

import os

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return check.connect(SF)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, SF)
    columns, want = check.expected(db, name)
    got = check.bag(df.columns, df.collect())
    if want is None:
        # The training-data operators that SQL cannot express have tests of their own.
        assert got and (name == "pipeline" or name.startswith("op"))
    else:
        assert sorted(df.columns) == sorted(columns)
        assert got == want
