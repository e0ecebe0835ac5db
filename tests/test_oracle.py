"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from occuflow.plans import queries as registry
from conftest import SF_SMALL
from oracle import compare, duck

ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(ORACLES)
    assert set(registry.queries()) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    ok, msg = compare(df, ORACLES[name], SF_SMALL, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["H3", "species", "year", "record_count", "dataset_keys"]
    assert df.count() > 0
