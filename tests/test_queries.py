"""Every registered query: beside its SQL where there is one, else for rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import difference

ORACLES = oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert difference(spark, queries()[name], ORACLES[name], sf_dir) == ""


@pytest.mark.parametrize("name", sorted(set(queries()) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    rows = queries()[name](spark, sf_dir).collect()
    assert rows and all(value is not None for value in rows[0])


def test_entry(spark):
    assert entry(spark).count() > 0
