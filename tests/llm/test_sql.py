"""Queries with SQL give the rows DuckDB gives on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.verify import TABLES, compare


@pytest.mark.parametrize("name", sorted(entry.LLM_ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{entry.ENTRY_FOLDER}/{table}.parquet'")
    verdict = compare(entry.queries()[name](spark, entry.ENTRY_FOLDER), con.sql(entry.LLM_ORACLES[name]))
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.LLM_QUERIES)
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names - {"pipeline"}} == set(range(1, 14))
