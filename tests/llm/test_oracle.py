"""The queries of this package that have SQL against DuckDB, over the whole small tables."""

import pytest

from hackney.llm.registry import ORACLE_SQL, QUERIES
from tests.conftest import SF_ORACLE, SF_SMALL
from tools.oracle_check import compare, duck_connection


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, key, sf_dir):
    df = QUERIES[key](spark, sf_dir)
    columns = sorted(df.columns)  # in any order
    res = compare(df.select(columns), duck_connection(sf_dir), f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[key]})")
    assert res["ok"], res
