"""Every query against its SQL on the smallest test tables."""

from pathlib import Path

import pytest
from against_sql import difference

import __spark_entry__ as entry
from workload.oracle import SQL
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert difference(spark, FOLDER, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 6000
    assert df.columns == entry.entry(spark).columns
