"""Every registered query against its SQL, values identical."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, connect

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", list(QUERIES))
def test_matches_sql(spark, con, sf_dir, key):
    assert compare(spark, con, sf_dir, key, QUERIES, ORACLES) in ("", "EMPTY")


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_names_are_plain():
    assert all(k == k.lower() and " " not in k for k in QUERIES)
    assert set(ORACLES) <= set(QUERIES)
