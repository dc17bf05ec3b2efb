"""Batch tables: listing, reading, limited export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.schemas import COLLECTIONS, record_schema


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the tables in the session's catalog, temporary views included."""
    return sorted(t.name for t in spark.catalog.listTables(database))


def read_records(
    spark: SparkSession, root: str, record_type: str, file_format: str = "parquet"
) -> DataFrame:
    """One record type stored as files under ``root/<collection>``.

    JSON is read with the record schema, so nothing is inferred and a record
    that does not fit keeps the fields that do.
    """
    path = f"{root.rstrip('/')}/{COLLECTIONS[record_type]}"
    schema = record_schema(record_type)
    frame = spark.read.format(file_format).schema(schema).load(path)
    return frame.select(*schema.names)


def limited_export(
    df: DataFrame, key: str | list[str], limit: int | None
) -> DataFrame:
    """The first ``limit`` records by key; all records when ``limit`` is None."""
    keys = [key] if isinstance(key, str) else list(key)
    if limit is None:
        return df
    return df.orderBy(*[F.asc_nulls_last(k) for k in keys]).limit(limit)
