"""Every registered key against its DuckDB oracle on the smallest driver data."""

import pytest

from ledgerlens.plans.registry import oracle_sql, queries
from ledgerlens.plans.verify import compare, duck

from .conftest import SF_SMALL

KEYS = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_an_oracle():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF_SMALL)
    ok, msg = compare(df, con, oracle_sql()[key])
    assert ok, msg
