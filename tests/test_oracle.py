"""Every registered query against its DuckDB equivalent on the smallest test tables."""

import pytest

import oracle
import __spark_entry__ as entry_module
from modelspend.registry import QUERIES as OWN

SF_DIR = entry_module.SMALL
QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    with oracle.connect(SF_DIR) as con:
        yield con


def test_every_own_query_has_an_oracle():
    assert set(OWN) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_oracle(spark, duck, name):
    names, rows = oracle.spark_rows(QUERIES[name](spark, SF_DIR))
    expected_names, expected = oracle.duck_rows(duck, SQL[name])
    assert names == expected_names
    assert len(rows) > 0
    assert rows == expected


def test_entry_is_the_summary(spark):
    df = entry_module.entry(spark)
    assert df.count() == 1
    assert "total_reused_cost_savings" in df.columns
