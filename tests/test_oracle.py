"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from tests.compare import TESTDATA, compare, connect

FOLDER = f"{TESTDATA}/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    message, _, _ = compare(spark, connect(FOLDER), name, QUERIES[name], SQL.get(name), FOLDER)
    assert not message or message.startswith("rows only") or message == "no rows at all", message


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
