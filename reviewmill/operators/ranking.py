"""First row per key, top k, and the rest beyond the top k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``; null counts as one key value.

    Spark keeps only the first row per key on the map side before the shuffle,
    so a key that holds a large part of the rows is cut down in place.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows in ``order``: a top k in each task, then one merge of k rows."""
    return df.orderBy(*order).limit(k)


def highest(column: str) -> Column:
    return F.desc_nulls_last(column)


def lowest(column: str) -> Column:
    return F.asc_nulls_last(column)


def with_rest(df: DataFrame, top: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``top`` plus one row ``name`` that holds the sum of all other rows of ``df``.

    The rest is the total less the top, so no row needs a global rank.
    """
    rest = df.agg(F.coalesce(F.sum(value), F.lit(0)).alias(value))
    rows = top.select(key, value, F.lit(False).alias("_rest")).unionByName(
        rest.select(F.lit(name).alias(key), value, F.lit(True).alias("_rest"))
    )
    # The window holds the top rows and the total, no more.
    shown = F.sum(F.when(~F.col("_rest"), F.col(value)).otherwise(0)).over(
        Window.partitionBy()
    )
    return rows.select(
        key,
        F.when(F.col("_rest"), F.col(value) - shown).otherwise(F.col(value)).alias(value),
    )
