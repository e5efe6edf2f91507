"""Every registered query against its check SQL."""

import re

import pytest
from compare import connect, difference
from conftest import SF_DIR

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_only_optional_queries_lack_sql():
    """Queries of the library itself all have check SQL; optional ones without it have tests of their own."""
    own = {name for name in QUERIES if not re.match(r"op\d+_", name) and name != "pipeline"}
    assert own <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "Branche" and df.count() > 0
