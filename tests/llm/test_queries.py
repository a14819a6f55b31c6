"""Registered queries of the subpackage: SQL where there is some, and plausible rows elsewhere."""

import pytest

from dictaspark.llm import queries
from tests.helpers import connection, same

QUERIES, SQL = queries.queries(), queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, sf, name):
    same(QUERIES[name](spark, sf), connection(sf), SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    rows = QUERIES[name](spark, sf)
    assert rows.count() >= (name != "p9_found") and len(set(rows.columns)) == len(rows.columns)
