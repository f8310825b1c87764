"""Every registered query with SQL gives the rows and types DuckDB gives on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.verify import TABLES, compare

FOLDER = entry.ENTRY_FOLDER


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    untested = set(entry.queries()) - set(entry.oracle_sql()) - set(entry.LLM_QUERIES)
    assert untested == {"train_growth_huber", "feature_importance", "permutation_importance"}


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry.LLM_ORACLES)))
def test_query(spark, duck, name):
    verdict = compare(entry.queries()[name](spark, FOLDER), duck.sql(entry.oracle_sql()[name]))
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "tract_geoid"
