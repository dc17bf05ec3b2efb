"""Rating predictions: id indexes, ALS, scoring."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.operators.runs import Factors, fit_by_runs
from reviewmill.schemas import result_schema
from reviewmill.session import materialize

# monotonically_increasing_id() holds the partition above bit 33.
_PARTITION_SHIFT = 33

DEFAULT_SEED = 42
# Parts that ALS cuts users and businesses into. Start values follow the parts, so
# the number is a setting of its own and never follows the data: raise it with the
# cluster, and keep it for as long as predictions have to be comparable.
DEFAULT_BLOCKS = 8
# Ratings up to which Spark's ALS fits; it is quicker there and writes little. Both ways give
# the same factors, but for rounding.
SMALL_RATINGS = 1_000_000
# Blocks of businesses that are scored together, and the ratings of one of them beyond which
# they are cut by users. Results depend on neither.
SCORE_BLOCKS, CELL_ROWS = 8, 4_000_000
# Partitions a cell: enough that few cells share one.
_CELL_PARTITIONS = 8
# Ratings that are scored at once.
_CHUNK = 1 << 17


def dense_indexes(df: DataFrame, keys: list[str], folder: str | None = None) -> DataFrame:
    """(kind, id, index): the ids of each key column, numbered from 0 by falling
    frequency, ties by id.

    The ids of all columns are counted in one pass, sorted across the cluster
    and numbered inside each partition. Only the partition sizes, one row per
    partition and column, meet in one place; no id passes through the driver.
    """
    pairs = [F.struct(F.lit(key).alias("kind"), F.col(key).alias("id")) for key in keys]
    ordered = (
        df.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.*")
        .where(F.col("id").isNotNull())
        .groupBy("kind", "id")
        .count()
        .orderBy("kind", F.desc("count"), "id")
        .select("kind", "id", F.monotonically_increasing_id().alias("_slot"))
    )
    # The slots depend on the sort's sampled bounds: fix them before two reads.
    slots = materialize(ordered, "slots", folder).select(
        "kind",
        "id",
        F.shiftright("_slot", _PARTITION_SHIFT).alias("_part"),
        F.col("_slot").bitwiseAND((1 << _PARTITION_SHIFT) - 1).alias("_position"),
    )
    earlier = (
        Window.partitionBy("kind")
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        slots.groupBy("kind", "_part")
        .agg(F.count("*").alias("_size"), F.min("_position").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    )
    # One row per sort partition and column: bounded by the session's settings.
    numbered = slots.join(F.broadcast(offsets), ["kind", "_part"]).select(
        "kind",
        "id",
        (F.col("_before") + F.col("_position") - F.col("_first")).cast("int").alias("index"),
    )
    # Written out, so that Spark picks the joins against it by its true size.
    return materialize(numbered, "index", folder)


def index_of(indexes: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name): the numbers of one key column."""
    return indexes.where(F.col("kind") == key).select(
        F.col("id").alias(key), F.col("index").alias(name)
    )


def usable_ratings(ratings: DataFrame) -> DataFrame:
    """Ratings with both ids and stars; the others can neither train nor be scored."""
    return ratings.select("user_id", "business_id", "stars").dropna()


def index_ratings(ratings: DataFrame, indexes: DataFrame) -> DataFrame:
    """(user_index, business_index, stars). Small indexes are broadcast, large ones joined by shuffle."""
    users = index_of(indexes, "user_id", "user_index")
    businesses = index_of(indexes, "business_id", "business_index")
    # Each join drops the text it has looked up.
    numbered = ratings.join(users, "user_id").select("user_index", "business_id", "stars")
    return numbered.join(businesses, "business_id").select("user_index", "business_index", "stars")


def fit_ratings(
    indexed: DataFrame,
    seed: int = DEFAULT_SEED,
    blocks: int = DEFAULT_BLOCKS,
    folder: str | None = None,
    **params,
) -> ALSModel | Factors:
    """Explicit, non-negative ALS over indexes that count from 0 without gaps.

    Spark's ALS writes each id's factors once for every block in every half-step, so many
    ratings are fitted by ``fit_by_runs``.
    """
    als = ALS(
        userCol="user_index",
        itemCol="business_index",
        ratingCol="stars",
        nonnegative=True,
        coldStartStrategy="drop",
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        **params,
    )
    # Parameters that the runs know nothing of are for Spark's ALS alone.
    plain = als.getNonnegative() and not als.getImplicitPrefs() and als.getMaxIter() > 0
    if plain and indexed.count() > SMALL_RATINGS:
        return fit_by_runs(indexed, als, folder)
    return als.fit(indexed)


def _named_factors(factors: DataFrame, indexes: DataFrame, key: str, name: str) -> DataFrame:
    numbered = factors.select(F.col("id").alias(name), "features")
    return numbered.join(index_of(indexes, key, name), name)


def score(model: ALSModel | Factors, indexed: DataFrame, indexes: DataFrame, stars: bool = False) -> DataFrame:
    """(user_id, business_id, prediction) of each row, and its stars if asked for.

    Ratings move as numbers. A user's factors go once to each block of businesses that the
    user rates, with the list of these; the names go with the factors. Blocks that would
    hold more than CELL_ROWS ratings are cut by users, so what a task holds of an even table
    does not grow with it; a business with a large share of all ratings is cut as often.
    """
    parts = -(-max(indexed.count(), 1) // (SCORE_BLOCKS * CELL_ROWS))
    partitions = _CELL_PARTITIONS * SCORE_BLOCKS * parts
    block = F.pmod("business_index", F.lit(SCORE_BLOCKS)) * parts
    users = _named_factors(model.userFactors, indexes, "user_id", "user_index")
    businesses = _named_factors(model.itemFactors, indexes, "business_id", "business_index")
    lists = ["business_index", "stars"] if stars else ["business_index"]
    rated = (
        indexed.select("user_index", (block + F.pmod("user_index", F.lit(parts))).alias("cell"), *lists)
        .repartition("user_index")
        .groupBy("user_index", "cell")
        .agg(*[F.collect_list(c).alias(c) for c in lists])
        .join(users, "user_index")
        .select("cell", "user_id", "features", *lists)
    )
    part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    known = businesses.withColumn("part", part).select(
        (block + F.col("part")).alias("cell"), "business_index", "business_id", "features"
    )
    rank = model.rank
    columns = ["user_id", "business_id", "prediction", *lists[1:]]

    def run(ratings: pa.Table, found: pa.Table) -> pa.Table:
        lengths = pc.list_value_length(ratings.column("business_index")).to_numpy()
        asked = pc.list_flatten(ratings.column("business_index"))
        u = np.repeat(np.arange(ratings.num_rows), lengths)
        # Every business that is rated has factors, so each is found.
        v = pc.index_in(asked, value_set=found.column("business_index").combine_chunks()).to_numpy()
        left = pc.list_flatten(ratings.column("features")).to_numpy().reshape(-1, rank)
        right = pc.list_flatten(found.column("features")).to_numpy().reshape(-1, rank)
        predicted = np.zeros(len(u), np.float32)
        for first in range(0, len(u), _CHUNK):
            rows = slice(first, first + _CHUNK)
            a, b = left[u[rows]], right[v[rows]]
            for i in range(rank):
                predicted[rows] += a[:, i] * b[:, i]
        names = [ratings.column("user_id").take(pa.array(u)), found.column("business_id").take(pa.array(v))]
        given = [pc.list_flatten(ratings.column(c)) for c in lists[1:]]
        scored = pa.table([*names, pa.array(predicted), *given], columns)
        return scored.filter(pa.array(~np.isnan(predicted)))

    kinds = {"user_id": users, "business_id": businesses}
    schema = ", ".join(f"{c} {f.schema[c].dataType.simpleString()}" for c, f in kinds.items())
    schema += ", prediction float" + ", stars double" * stars
    cells = [f.repartition(partitions, "cell").groupBy("cell") for f in (rated, known)]
    return cells[0].cogroup(cells[1]).applyInArrow(run, schema)


def fit_score(
    ratings: DataFrame,
    to_score: DataFrame | None = None,
    seed: int = DEFAULT_SEED,
    blocks: int = DEFAULT_BLOCKS,
    folder: str | None = None,
    stars: bool = False,
    **params,
) -> DataFrame:
    """Train on ``ratings``; one prediction per row of ``to_score`` (or of ``ratings``).

    Rows to score whose user or business has no rating get no prediction. The
    ratings are read twice, so hand in a stored table rather than a long plan.
    With ``stars`` each prediction has the stars of its row beside it.
    The result reads tables below ``folder``, see ``materialize``.
    """
    usable = usable_ratings(ratings).withColumn("stars", F.col("stars").cast("double"))
    if usable.isEmpty():
        schema = result_schema("predictions")
        return usable.sparkSession.createDataFrame([], schema.add("stars", "double") if stars else schema)
    indexes = dense_indexes(usable, ["user_id", "business_id"], folder)
    indexed = materialize(index_ratings(usable, indexes), "indexed-ratings", folder)
    model = fit_ratings(indexed, seed, blocks, folder, **params)
    if to_score is None:
        return score(model, indexed, indexes, stars)
    wanted = usable_ratings(to_score).withColumn("stars", F.col("stars").cast("double"))
    return score(model, materialize(index_ratings(wanted, indexes), "wanted", folder), indexes, stars)
