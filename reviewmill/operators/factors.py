"""Factors by sums that add up: ALS half-steps and fold-in of new users.

A user's factors against fixed business factors solve a small non-negative least
squares problem, of which the ratings enter by sums only: one number for each pair of
factors and one for each factor. Sums of new ratings are added to old ones without reading
these again. The sums of a key are as large as seven ratings, so ``spread_sums`` adds up before
it moves only what is at least as many: a key with a third of all ratings costs a batch of rows one.

``fit_factors`` deals the ratings once into blocks of users and of businesses, kept as runs (see
``runs``): a half-step writes the factors once, and a block's task holds the factors that it needs but
no ratings. Only ids with a large share of all ratings go by ``factor_sums``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.recommend import dense_indexes, index_of
from reviewmill.operators.runs import Apart, fit_runs
from reviewmill.session import materialize, table_path
from reviewmill.sources.storage import delete_folder

RANK, ITERATIONS, REGULARISATION = 10, 10, 0.1
# Sweeps over the factors of a problem; each sets one factor to its best value.
_SWEEPS = 60
# An id with more than this part of all ratings is no block's. Results do not depend on it.
_FREQUENT = 96


def _pairs(rank: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(rank) for j in range(i, rank)]


def _summed(v: np.ndarray, stars: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Products and targets of each run of rows, in the order of ``_pairs``."""
    rank = v.shape[1]
    columns = [np.add.reduceat(v[:, i] * v[:, j], starts) for i, j in _pairs(rank)]
    columns += [np.add.reduceat(stars * v[:, i], starts) for i in range(rank)]
    return np.stack(columns, axis=1)


def _runs(codes: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])


def _lists(values: np.ndarray) -> pa.Array:
    places = np.arange(0, values.size + 1, max(1, values.shape[1]), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(values.ravel()))


def _combined(ratings: DataFrame, key: str, rank: int) -> DataFrame:
    """Rows (key, n, stars, features, sums): ratings as they are, or the sums of several."""
    worth = len(_pairs(rank)) // rank + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, features = batch.column(key), batch.column("features")
            codes = names.dictionary_encode("encode").indices.to_numpy()
            many = np.bincount(codes, minlength=1)[codes] >= worth
            single = batch.filter(pa.array(~many))
            none = pa.nulls(single.num_rows, pa.list_(pa.float64()))
            rows = [single.column(key), pa.array(np.ones(single.num_rows, np.int64))]
            yield pa.RecordBatch.from_arrays([*rows, single.column("stars"), single.column("features"), none], fields)
            if many.any():
                at = np.flatnonzero(many)
                at = at[np.argsort(codes[at], kind="stable")]
                v = features.take(pa.array(at)).flatten().to_numpy().reshape(len(at), rank)
                starts = _runs(codes[at])
                sums = _lists(_summed(v, batch.column("stars").to_numpy()[at], starts))
                rows = [names.take(pa.array(at[starts])), pa.array(np.diff(np.r_[starts, len(at)]))]
                none = [pa.nulls(len(starts), pa.float64()), pa.nulls(len(starts), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*rows, *none, sums], fields)

    fields = [key, "n", "stars", "features", "sums"]
    kind = ratings.schema[key].dataType.simpleString()
    # Factors beyond the rank count for nothing.
    slim = ratings.select(key, F.col("stars").cast("double"), F.slice("features", 1, rank).alias("features"))
    return slim.mapInArrow(run, f"`{key}` {kind}, n long, stars double, features array<double>, sums array<double>")


def factor_sums(ratings: DataFrame, key: str, rank: int = RANK) -> DataFrame:
    """The sums of each ``key`` over its rows of ``stars`` and ``features`` (of the other side).

    Every task adds up all it has before it moves them: for keys with many rows in each task.
    """
    v = [F.col("features")[i] for i in range(rank)]
    products = [F.sum(v[i] * v[j]).alias(f"p{i}_{j}") for i, j in _pairs(rank)]
    targets = [F.sum(F.col("stars") * v[i]).alias(f"t{i}") for i in range(rank)]
    return ratings.groupBy(key).agg(F.count("*").alias("ratings"), *products, *targets)


def spread_sums(ratings: DataFrame, key: str, rank: int = RANK) -> DataFrame:
    """The sums of each ``key`` over its rows of ``stars`` and ``features`` (of the other side).

    The same as ``factor_sums``, for keys of which a task has a few rows only: these move as
    they are, and what a batch of rows holds more often moves as its sums.
    """
    v, sums = F.col("features"), F.col("sums")
    products = [
        F.sum(F.coalesce(v[i] * v[j], sums[k])).alias(f"p{i}_{j}") for k, (i, j) in enumerate(_pairs(rank))
    ]
    first = len(products)
    targets = [F.sum(F.coalesce(F.col("stars") * v[i], sums[first + i])).alias(f"t{i}") for i in range(rank)]
    moved = _combined(ratings, key, rank).repartition(key)
    return moved.groupBy(key).agg(F.sum("n").alias("ratings"), *products, *targets)


def _solve(products: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Non-negative x with the least x'Px - 2t'x, for many P and t at once."""
    x = np.zeros_like(targets)
    for _ in range(_SWEEPS):
        before = x.copy()
        for i in range(targets.shape[1]):
            slope = targets[:, i] - np.einsum("nj,nj->n", products[:, i, :], x)
            x[:, i] = np.maximum(0.0, x[:, i] + slope / products[:, i, i])
        if np.abs(x - before).max(initial=0.0) < 1e-9:
            break
    return x


def _penalised(products: np.ndarray, targets: np.ndarray, counts: np.ndarray, regularisation: float) -> np.ndarray:
    each = np.arange(targets.shape[1])
    products[:, each, each] += np.maximum(regularisation * counts, 1e-12)[:, None]
    return _solve(products, targets) if len(targets) else targets


def solve_factors(sums: DataFrame, key: str, rank: int = RANK, regularisation: float = REGULARISATION) -> DataFrame:
    """(key, features) from the sums; the penalty grows with the ratings, as ALS has it."""
    names = [f"p{i}_{j}" for i, j in _pairs(rank)], [f"t{i}" for i in range(rank)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            products = np.zeros((count, rank, rank))
            for name, (i, j) in zip(names[0], _pairs(rank)):
                products[:, i, j] = products[:, j, i] = batch.column(name).to_numpy()
            targets = np.stack([batch.column(name).to_numpy() for name in names[1]], axis=1)
            solved = _penalised(products, targets, batch.column("ratings").to_numpy(), regularisation)
            yield pa.RecordBatch.from_arrays([batch.column(key), _lists(solved)], [key, "features"])

    kind = sums.schema[key].dataType.simpleString()
    return sums.mapInArrow(run, f"`{key}` {kind}, features array<double>")


def fold_in(
    ratings: DataFrame,
    factors: DataFrame,
    key: str = "user_id",
    other: str = "business_id",
    rank: int = RANK,
    regularisation: float = REGULARISATION,
) -> DataFrame:
    """(key, features) of the users in ``ratings`` against fixed ``factors`` of businesses.

    No model is fitted again: new users get what a half-step of ALS would give them.
    Ratings of businesses without factors count for nothing; a user with none
    else gets no row. Swap ``key`` and ``other`` for new businesses.
    """
    known = ratings.select(key, other, "stars").dropna().join(factors.select(other, "features"), other)
    return solve_factors(spread_sums(known, key, rank), key, rank, regularisation)


def _start(key: str, rank: int, seed: int) -> Column:
    """Start values in [0, 1) that depend on the id alone, not on partitions."""
    each = [F.pmod(F.xxhash64(F.lit(seed), F.lit(i), key), F.lit(1 << 20)) / (1 << 20) for i in range(rank)]
    return F.array(*each).alias("features")


def _frequent(rated: DataFrame, key: str) -> list:
    """Ids with so large a share of all ratings that a block should not hold them.

    The counts are estimates: they decide the way, not the result.
    """
    found = rated.agg(F.call_function("approx_top_k", F.col(key), F.lit(2 * _FREQUENT)), F.count("*")).first()
    return [x["item"] for x in found[0] or [] if x["count"] > found[1] / _FREQUENT]


def fit_factors(
    ratings: DataFrame,
    rank: int = RANK,
    iterations: int = ITERATIONS,
    regularisation: float = REGULARISATION,
    seed: int = 42,
    folder: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Factors of users and of businesses by explicit, non-negative ALS over summed half-steps.

    Results depend neither on the partitioning nor on a number of blocks, but for the order of
    additions. Between the half-steps stars and factors are 32-bit floats, as those of Spark's ALS are.
    """
    spark = ratings.sparkSession
    work = table_path(spark, "fit", folder)
    rated = materialize(ratings.select("user_id", "business_id", F.col("stars").cast("double")).dropna(), "rated", work)
    sides = {"user_id": "business_id", "business_id": "user_id"}
    names, indexed = {}, rated
    for key in sides:
        names[key] = index_of(dense_indexes(rated, [key], work), key, "id")
        # Each join drops the text it has looked up.
        indexed = indexed.join(names[key], key).drop(key).withColumnRenamed("id", key)
    indexed = materialize(indexed, "indexed-ratings", work)
    sizes = indexed.agg(*[F.coalesce(F.max(key) + 1, F.lit(0)).alias(key) for key in sides]).first().asDict()

    def apart(key: str, ids: list[int]) -> Apart:
        rows = indexed.where(F.col(key).isin(ids))

        def solved(known: DataFrame) -> DataFrame:
            features = F.col("features").cast("array<double>").alias("features")
            rated = rows.join(known.select(F.col("id").alias(sides[key]), features), sides[key])
            return solve_factors(factor_sums(rated, key, rank), key, rank, regularisation).withColumnRenamed(key, "id")

        return ids, solved

    frequent = {key: _frequent(indexed, key) for key in sides}
    large = {key: apart(key, ids) for key, ids in frequent.items() if ids}
    start = names["business_id"].select("id", _start("business_id", rank, seed))
    found = fit_runs(indexed, start, sides, sizes, iterations, rank, regularisation, work, large)
    features = F.col("features").cast("array<double>").alias("features")
    users, businesses = [
        materialize(names[key].join(found[key], "id").select(key, features), "factors", folder) for key in sides
    ]
    delete_folder(spark, work)
    return users, businesses


def predict(pairs: DataFrame, users: DataFrame, businesses: DataFrame) -> DataFrame:
    """(user_id, business_id, prediction) of the pairs whose two sides have factors."""
    joined = pairs.select("user_id", "business_id").join(
        users.select("user_id", F.col("features").alias("u")), "user_id"
    )
    joined = joined.join(businesses.select("business_id", F.col("features").alias("v")), "business_id")
    products = F.zip_with("u", "v", lambda a, b: a * b)
    total = F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
    return joined.select("user_id", "business_id", total.cast("float").alias("prediction"))
