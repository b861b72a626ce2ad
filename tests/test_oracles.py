"""Every registered query that SQL can express next to its SQL, on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER) is None


def test_entry_gives_rows(spark):
    assert not entry.entry(spark).isEmpty()
