"""The correctness gate: every registered query against its DuckDB oracle."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.oracle_check import TABLES, digest

NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and df.columns == ["sales_rep_id", "sales_rep_first_name", "sales_rep_last_name", "total_profit"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    res = con.sql(sql)
    assert sorted(df.columns) == sorted(res.columns)
    assert digest(df.columns, rows)[0] == digest(res.columns, res.fetchall())[0]
