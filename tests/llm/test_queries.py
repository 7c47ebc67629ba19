"""The registered queries over whole small tables: against SQL where SQL can express them."""

import pytest

import __spark_entry__ as entry
from lloydflow import llm
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_one_query_per_operator_and_the_pipeline():
    names = entry.queries()
    assert [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(llm.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, llm.queries()[name], llm.oracle_sql()[name], SF_SMALL)
    assert r["ok"], r["problems"]
