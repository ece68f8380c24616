"""Every registered query with SQL must equal it on the smallest tables; the others must give rows."""

from pathlib import Path

import pytest
from oracle_check import compare, connect, spark_entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables here")
SLOW = {"leaderboard_regression", "leaderboard_classification"}  # minutes each; their parts are covered by test_models


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER) is None


@pytest.mark.parametrize("name", sorted(set(spark_entry.queries()) - set(spark_entry.oracle_sql()) - SLOW))
def test_query_without_sql_gives_rows(spark, name):
    assert spark_entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.count() > 0 and df.columns == spark_entry.entry(spark).columns


def test_every_oracle_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
