"""Every registered query against its DuckDB oracle (the driver's gate, at sf0.001)."""

import pytest

from regiflow.plans import catalog
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

QUERIES = catalog.queries()
ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert "error" not in r, r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 1


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
