"""Every query of the catalogue runs; those with SQL agree with it."""

import pytest

from dictaspark.plans import catalogue
from tests.helpers import connection, same

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, sf, name):
    same(QUERIES[name](spark, sf), connection(sf), SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    rows = QUERIES[name](spark, sf)
    assert rows.count() > 0 and len(set(rows.columns)) == len(rows.columns)


def test_entry(spark, sf):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
