"""Corpus queries that SQL can express against their DuckDB statements."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import compare  # noqa: E402
from episodica.llm import queries  # noqa: E402


@pytest.mark.skipif(not compare.DATA.exists(), reason="test tables are missing")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare.rows_of_query(queries.QUERIES[name](spark, str(compare.DATA))) == compare.rows_of_sql(queries.ORACLES[name])
