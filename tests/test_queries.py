"""Every registered query of the ingestion library against its SQL."""

import pytest

from gridloom.plans.queries import QUERIES, SQL

from .oracle import assert_same


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf, name):
    assert_same(QUERIES[name](spark, sf), SQL[name], sf)


def test_all_have_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_needs_no_corpus_operators(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert entry.entry(spark).count() == 1
