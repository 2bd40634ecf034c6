"""Every query of the subpackage that has SQL, against DuckDB, and the row counts of the others."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_file
from heliograph.llm import queries

TABLES = ["documents", "pages", "benchmark"]


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{source}'")
    return connection


def _rows(frame):
    names = sorted(frame.columns)
    clean = frame[names].astype(object).where(frame[names].notna(), None)
    return names, sorted((tuple(r) for r in clean.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_dir, database, name):
    assert _rows(queries.QUERIES[name](spark, sf_dir).toPandas()) == _rows(database.execute(queries.SQL[name]).df())


def test_every_operator_is_registered():
    offered = entry_file.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in offered)] == []
    assert "pipeline" in offered


@pytest.mark.parametrize("name", ["op1_url_filters", "op3_secret_scans", "op6_simhash_near_dedup", "op9_token_counts"])
def test_one_row_for_each(spark, sf_dir, database, name):
    source = "pages" if name.startswith("op1_") else "documents"
    want = database.execute(f"SELECT count(*) FROM {source}").fetchone()[0]
    assert queries.QUERIES[name](spark, sf_dir).count() == want
