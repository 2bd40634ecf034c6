"""Every registered query against its SQL in DuckDB, on the driver's smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_file

from heliograph.plans import catalog, oracle

QUERIES = catalog.QUERIES
SQL = oracle.SQL

# The model's predictions have no SQL twin.
ROWS_ONLY = {"optimal_tilt": 1000, "candidate_scores": 13_000}


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'")
    return connection


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "item"):
        value = value.item()
    return value + 0.0 if isinstance(value, float) else value


def _table(frame):
    names = sorted(frame.columns)
    return names, sorted((tuple(_plain(v) for v in r) for r in frame[names].itertuples(index=False)), key=repr)


def test_every_query_is_checked():
    assert set(QUERIES) == set(SQL) | set(ROWS_ONLY)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, database, name):
    assert _table(QUERIES[name](spark, sf_dir).toPandas()) == _table(database.execute(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_model_queries_answer_every_row(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() == ROWS_ONLY[name]


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(entry_file.queries()) and set(SQL) <= set(entry_file.oracle_sql())


def test_entry(spark, sf_dir):
    assert entry_file.entry(spark).count() > 0
