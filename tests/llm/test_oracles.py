"""Registered queries against their SQL (DuckDB) at sf0.001."""

import duckdb
import pytest

from llm_plain import SF
from settleframe.llm.catalog import ORACLE_SQL, QUERIES
from tools.oracle_check import _rows


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, key):
    df, con = QUERIES[key](spark, SF), duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(ORACLE_SQL[key])
    names = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(names, res.fetchall())
