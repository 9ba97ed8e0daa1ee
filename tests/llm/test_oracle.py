"""The queries that SQL can express, against DuckDB."""

import pytest

from tests.conftest import SMOKE_SF
from tests.oracle_check import compare
from tickwise.llm.oracle import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    result = compare(spark, SMOKE_SF, [name], verbose=False)[name]
    assert result.startswith("OK"), result
