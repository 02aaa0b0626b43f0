"""Every registered query against its SQL, on the smallest test tables."""

import pytest
from oracle import connect, differences, entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF)


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLE)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, database, name):
    got = entry.queries()[name](spark, SF).toArrow()
    expected = database.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert differences(got, expected) is None


def test_flagship(spark):
    assert entry.entry(spark).columns == ["name", "categoryOptionCombos_id"]
