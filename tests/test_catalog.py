"""Every registered query against its SQL statement (DuckDB) at sf0.001:
same column names, same multiset of rows."""

import os
import re

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from settleframe import catalog
from settleframe.catalog import QUERIES
from tools.oracle_check import TABLES, _rows

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, duck, key):
    df = queries()[key](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[key])
    d_names = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_names)
    assert _rows(df.columns, s_rows) == _rows(d_names, d_rows)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "DailyNotional" in df.columns


def test_test_table_scans_are_pruned(spark):
    """Column pruning reaches the scan, and no shuffle stands between it and the query."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        queries()["silver_currency"](spark, SF).explain("formatted")
    schema = [line for line in out.getvalue().splitlines() if line.startswith("ReadSchema")]
    assert schema == ["ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>"]
    assert "Exchange" not in out.getvalue()


def test_each_query_of_a_run_makes_its_own(spark):
    """Two queries share no files, so each one's time and traffic are its own work."""
    first, second = (queries()["run_gold_summary"](spark, SF) for _ in range(2))
    assert first.inputFiles() and not set(first.inputFiles()) & set(second.inputFiles())


def test_landings_are_compressed_in_small_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "LANDING_FILE_ROWS", 1000)
    plain = str(tmp_path / "plain")
    lines = catalog._dirty_lines(catalog.testbed.trades(spark, SF, with_ingestion_time=False))
    lines.write.text(plain)
    cfg = catalog._landing_config(spark, SF)
    files = [p.removeprefix("file:") for p in spark.read.text(cfg.trades.source_path).inputFiles()]
    assert all(p.endswith(".gz") for p in files) and len(files) >= lines.count() / 1000
    size = lambda paths: sum(os.path.getsize(p) for p in paths)
    assert 4 * size(re.sub("^/+", "/", p) for p in files) < size(p.path for p in os.scandir(plain) if p.name.endswith(".txt"))
    assert sorted(spark.read.text(cfg.trades.source_path).collect()) == sorted(spark.read.text(plain).collect())
