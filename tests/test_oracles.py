"""Every registered query against its DuckDB oracle on the small fixture (sf0.001)."""
import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck
from conftest import SF_SMALL

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert ok, f"{name}: {msg}"


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
