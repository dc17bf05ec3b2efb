"""Connected components of a graph held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.session import materialize


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """Every neighbour with the smallest id around its ``u``."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _to_smallest(both).filter("v > u")
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    found = _to_smallest(edges)
    moved = found.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(found.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(id, component_id) of every linked id; component_id is the smallest id reachable.

    Alternates large and small stars until the edges stay as they are, which
    takes a number of rounds that grows with the logarithm of the ids. Ids
    move as rows, and each round is written to the shared folder. Pairs of an
    id with itself, repeated pairs and pairs with a null count for nothing; no
    links give no rows.
    """
    edges = links.select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    ).filter(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("u") > F.col("v")))
    edges = materialize(edges.distinct(), "edges")
    mark = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == mark:
            break
        mark = tuple(state)
        edges = materialize(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(roots)
