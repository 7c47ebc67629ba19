"""Every catalog query against its DuckDB oracle on the smallest scale factor."""

import pytest

import __spark_entry__ as entry
from lloydflow.plans import catalog
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

# The library's own operators; those of optional subpackages have their own tests.
QUERIES = catalog.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["ok"], r["problems"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and df.columns == ["iteration", "rank", "new_x", "new_y", "old_x", "old_y", "n_points"]
