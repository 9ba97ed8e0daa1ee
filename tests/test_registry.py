"""Every registered query against its DuckDB oracle on the smoke data."""

import pytest

import __spark_entry__ as E
from tickwise.plans.oracle import ORACLE
from tickwise.plans.registry import QUERIES

from .conftest import SMOKE_SF
from .oracle_check import compare


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "drawdown_pct" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    result = compare(spark, SMOKE_SF, [name], verbose=False)[name]
    assert result.startswith("OK"), result
