"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, connect

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name) == ""


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["provider", "questions", "passed", "accuracy"]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
