import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from boardpulse.checks.oracle import ORACLE_SQL
from boardpulse.checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(ORACLE_SQL) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF_DIR), db, ORACLE_SQL[name]) == []


def test_entry(spark):
    result = entry(spark)
    assert result.count() > 0 and "doc_id" in result.columns
