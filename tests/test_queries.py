"""Every registered query over the small test tables, against its SQL twin in DuckDB where it has one."""

import pytest

import __spark_entry__ as entry
from cardsentry.plans import catalog
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, sf_dir, name):
    ok, message, _ = compare(spark, con, name, sf_dir)
    assert ok, message


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["trans_num", "is_fraud", "amt"]
    assert len(df.columns) == 2 + 26
    assert df.count() == 1000


def test_every_sql_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
