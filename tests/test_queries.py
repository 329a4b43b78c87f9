"""Every registered query against its check SQL, on the smallest tables."""

import pytest
from compare import compare, open_tables

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
CHECKS = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return open_tables(SF)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, con, name):
    assert compare(spark, con, entry_points.queries()[name], CHECKS[name], SF) == []


def test_entry(spark):
    row = entry_points.entry(spark).first()
    assert row.episodes_total > 200
