"""Business names: the id-to-name lookup and the joins against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def business_names(businesses: DataFrame, order: Column | None = None) -> DataFrame:
    """(business_id, name), one row per id.

    Where an id repeats, the last record in ``order`` gives the name. Without
    an order the greatest name is taken, so that the choice is stable.
    """
    kept = businesses.where(F.col("business_id").isNotNull())
    if order is None:
        name = F.max("name")
    else:
        name = F.max_by("name", F.struct(order, F.col("name")))
    return kept.groupBy("business_id").agg(name.alias("name"))


def attach_names(df: DataFrame, names: DataFrame, how: str = "left") -> DataFrame:
    """Join the names on business_id.

    There is no broadcast hint: Spark broadcasts the lookup when its size is
    under spark.sql.autoBroadcastJoinThreshold. Beyond that both sides come
    from aggregations on business_id and join where they are.
    """
    return df.join(names, "business_id", how)
