"""Every registered query against its SQL on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry
from helpers import SMALL

SQL = entry.oracle_sql()
QUERIES = entry.queries()
SLOW = {"gbt_score", "train_report"}  # exercised in test_learning


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(name, spark, con):
    df = QUERIES[name](spark, SMALL)
    if name in SQL:
        assert oracle.compare(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 8
