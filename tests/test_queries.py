"""Registered queries against their SQL text; the corpus operators have tests of their own."""

import pytest

from check import compare, engine
from conftest import SMALL
from __spark_entry__ import CORPUS_QUERIES, entry, oracle_sql, queries


@pytest.mark.parametrize("name", sorted(set(queries()) - set(CORPUS_QUERIES)))
def test_query_equals_sql(spark, name):
    got = queries()[name](spark, SMALL).toPandas()
    sql = oracle_sql().get(name)
    assert len(got) > 0 or sql
    if sql:
        assert compare(got, engine(SMALL).execute(sql).df()) == ""


def test_entry(spark):
    assert set(entry(spark).columns) >= {"app", "uri", "total"}


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())
