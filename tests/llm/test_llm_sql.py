"""Queries with SQL against another engine."""

import duckdb
import pytest

from reviewmill.llm.queries import oracle_sql, queries

SQL = oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf_dir, rows, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = connection.sql(SQL[name])
    frame = queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    assert columns == sorted(expected.columns)
    assert rows(frame, *columns) == sorted(expected.project(", ".join(columns)).fetchall(), key=repr)
