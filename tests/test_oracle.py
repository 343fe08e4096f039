"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

from tests.conftest import SF_ORACLE
from tests.oracle_check import compare, duck
from tidemark.catalog import QUERIES
from tidemark.oracle import ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    assert name in QUERIES, f"oracle without query: {name}"
    df = QUERIES[name](spark, SF_ORACLE)
    n, problems = compare(df, con, ORACLE[name])
    assert not problems, f"{name}: {problems}"
