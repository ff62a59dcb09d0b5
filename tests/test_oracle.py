"""Every registered query against its SQL on the smallest test tables."""

import pytest
from compare import difference

from __spark_entry__ import entry, oracle_sql, queries
from revtide.catalog import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert difference(spark, con, name, sf_dir) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(queries()) >= set(QUERIES)
    assert set(oracle_sql()) >= set(ORACLE)


def test_entry(spark):
    found = entry(spark)
    assert found.columns == ["series_id", "date", "vintage_date", "value", "release_id"]
    assert found.count() > 0
