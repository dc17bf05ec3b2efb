"""ALS over runs of ratings: factors are written once a half-step, not once for each block.

The ratings of each side are dealt once into blocks of ids, sorted by id and kept as a table of
runs: rows that hold the ratings of some thousand ids as packed numbers. A half-step is one task a
block. It reads the factors of the other side, keeps those that its block rates, and passes the
block's runs by them, so it holds factors but no ratings. The new factors are written once, and every
block of the next half-step reads them.

``fit_by_runs`` has start values, penalty and order of the half-steps of Spark's ALS, so the factors
are those of ALS too, but for rounding. Task functions are nested and use no other function of the package, so
executors need not have it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.session import bound_batches, table_path
from reviewmill.sources.storage import delete_folder

# Blocks that the ids of a side are dealt into; at most 16. Results do not depend on it.
RUN_BLOCKS = 12
# Ratings that are held to make runs of them.
_HELD = 1 << 19
# Ratings whose sums are made at once.
_CHUNK = 1 << 15
# Rows of a table that Spark reads at once, and bytes that it collects before it writes them: a row
# holds some thousand ids, so the defaults of 4096 rows and 128 MB would be a whole file for each task.
_READ_ROWS, _WRITTEN_BYTES = 16, 8 << 20
# Rounds in which all factors of a wrong sign change sides; then one a round, which always ends.
_JOINT_ROUNDS = 12

_RUN = "block int, ids binary, counts binary, others binary, stars binary, whole boolean"
_FACTORS = "ids binary, features binary, blocks binary"


class Factors(NamedTuple):
    """What ``score`` needs of a model."""

    rank: int
    userFactors: DataFrame
    itemFactors: DataFrame


def _deal(indexed: DataFrame, key: str, other: str, path: str) -> None:
    """Writes the ratings of each block of ``key`` as runs to ``path``.

    Runs hold all ratings of their ids. Only an id with more than is held at once comes in
    several runs, which are not ``whole``.
    """
    rows = indexed.select(key, other, F.col("stars").cast("float").alias("stars"))
    rows = rows.repartition(key).sortWithinPartitions(key)

    def packed(ids: np.ndarray, others: np.ndarray, stars: np.ndarray, whole: bool) -> Iterator[pa.RecordBatch]:
        blocks = ids % RUN_BLOCKS
        order = np.argsort(blocks, kind="stable")
        ids, others, stars, blocks = ids[order], others[order], stars[order], blocks[order]
        for rows in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(blocks)) + 1) if len(ids) else []:
            part = ids[rows]
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            counts = np.diff(np.append(starts, len(part))).astype(np.int32)
            values = [part[starts], counts, others[rows], stars[rows]]
            row = [[int(blocks[rows[0]])], *[[v.tobytes()] for v in values], [whole]]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, fields)], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, split = [], 0, None

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            """Packs what is held, but for its last id, which may go on."""
            nonlocal held, count, split
            ids, others, stars = (np.concatenate(v) for v in zip(*held))
            end = len(ids) if last else int(np.searchsorted(ids, ids[-1]))
            # What an id has more of, after some of it was packed.
            first = 0 if split is None else int(np.searchsorted(ids, split, "right"))
            if end == 0:
                split, first, end = ids[-1], len(ids), len(ids)
            yield from packed(ids[:first], others[:first], stars[:first], False)
            yield from packed(ids[first:end], others[first:end], stars[first:end], True)
            held, count = [(ids[end:], others[end:], stars[end:])], len(ids) - end

        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy() for i in range(3)))
            count += batch.num_rows
            if count >= _HELD:
                yield from cut(False)
        if count:
            yield from cut(True)

    binary = pa.binary()
    fields = pa.schema(
        [("block", pa.int32()), ("ids", binary), ("counts", binary), ("others", binary), ("stars", binary), ("whole", pa.bool_())]
    )
    rows.mapInArrow(run, _RUN).write.partitionBy("block").parquet(path)


def _start(indexed: DataFrame, als: ALS, sizes: dict[str, int]) -> DataFrame:
    """The factors of users that Spark's ALS starts from.

    They follow the ids and blocks, not the ratings, so each id is given once.
    """
    every = indexed.sparkSession.range(max(sizes.values()))
    names = [(F.col("id") % size).cast("int").alias(key) for key, size in sizes.items()]
    return als.copy({als.maxIter: 0}).fit(every.select(*names, F.lit(1.0).alias("stars"))).userFactors


def _packed(factors: DataFrame) -> DataFrame:
    """(id, features) as rows of packed numbers, for every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            features = batch.column("features").flatten().to_numpy().astype(np.float32)
            row = [ids.astype(np.int32), features, np.full(len(ids), -1, np.int16)]
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in row], ["ids", "features", "blocks"])

    return factors.select("id", "features").mapInArrow(run, _FACTORS)


def _solver(rank: int, penalty: float):
    """(sums_of, solved): the sums that a problem is made of, and its non-negative solution."""

    def sums_of(counts: np.ndarray, stars: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Products and targets of runs of ``counts`` rows."""
        starts = np.cumsum(counts) - counts
        products, targets = np.zeros((len(counts), rank, rank)), np.zeros((len(counts), rank))
        for i in range(rank):
            targets[:, i] = np.add.reduceat(v[:, i] * stars, starts)
            for j in range(i, rank):
                products[:, i, j] = products[:, j, i] = np.add.reduceat(v[:, i] * v[:, j], starts)
        return products, targets

    def solved(counts: np.ndarray, products: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """x >= 0 with the least x'Px - 2t'x: factors are free or zero until no sign is wrong."""
        each = np.arange(rank)
        products[:, each, each] += np.maximum(penalty * counts, 1e-12)[:, None]
        x = np.linalg.solve(products, targets[:, :, None])[:, :, 0]
        free = np.ones(x.shape, bool)
        todo = np.flatnonzero((x < 0).any(axis=1))
        rounds = 0
        while todo.size:
            p, t, f = products[todo], targets[todo], free[todo]
            slope = np.einsum("nij,nj->ni", p, x[todo]) - t
            least = 1e-12 * np.abs(t).max(axis=1, keepdims=True)
            wrong = np.where(f, x[todo] < -1e-12, slope < -least)
            more = wrong.any(axis=1)
            todo, p, t, f, wrong = todo[more], p[more], t[more], f[more], wrong[more]
            if rounds >= _JOINT_ROUNDS:
                wrong = each == (rank - 1 - wrong[:, ::-1].argmax(axis=1))[:, None]
            f ^= wrong
            free[todo] = f
            p = p * (f[:, :, None] & f[:, None, :])
            p[:, each, each] += ~f
            x[todo] = np.linalg.solve(p, (t * f)[:, :, None])[:, :, 0]
            rounds += 1
        return np.maximum(x, 0.0)

    return sums_of, solved


def _half_step(runs: DataFrame, factors: DataFrame, size: int, rank: int, penalty: float) -> DataFrame:
    """The factors of all ids in ``runs`` against ``factors`` of the ``size`` ids of the other side."""
    sums_of, solved = _solver(rank, penalty)

    def found(ids: np.ndarray, features: np.ndarray, blocks: np.ndarray) -> pa.RecordBatch:
        row = [ids, features.astype(np.float32), blocks]
        return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in row], ["ids", "features", "blocks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Filled as far as the block rates; memory beyond is never touched.
        table, place = np.empty((size, rank), np.float32), np.zeros(size, np.int32)
        read = kept = 0
        early, parts = [], {}

        def solve(ids, counts, others, stars, whole) -> Iterator[pa.RecordBatch]:
            starts = np.cumsum(counts) - counts
            ends = starts + counts
            features, blocks = np.zeros((len(ids), rank)), np.zeros(len(ids), np.uint16)
            first = 0
            while first < len(ids):
                last = max(first + 1, int(np.searchsorted(ends, starts[first] + _CHUNK, "right")))
                rows, own = slice(starts[first], ends[last - 1]), counts[first:last].astype(np.int64)
                v = table[place[others[rows]]].astype(np.float64, order="F")
                sums = sums_of(own, stars[rows].astype(np.float64), v)
                bits = np.left_shift(1, others[rows] % RUN_BLOCKS).astype(np.uint16)
                blocks[first:last] = np.bitwise_or.reduceat(bits, starts[first:last] - starts[first])
                if not whole:
                    before = parts.get(ids[0], (0, 0.0, 0.0, np.uint16(0)))
                    parts[ids[0]] = tuple(a + b for a, b in zip(before, (own, *sums))) + (before[3] | blocks,)
                    return
                features[first:last] = solved(own, *sums)
                first = last
            yield found(ids, features, blocks)

        for batch in batches:
            block, whole = batch.column("block").to_numpy(), batch.column("whole").to_pylist()

            def numbers(name: str, i: int, kind: type) -> np.ndarray:
                return np.frombuffer(batch.column(name)[i].as_buffer(), kind)

            for i in range(batch.num_rows):
                ids = numbers("ids", i, np.int32)
                if whole[i] is None:
                    keep = np.flatnonzero(numbers("blocks", i, np.uint16) >> block[i] & 1)
                    place[ids[keep]] = np.arange(kept, kept + len(keep))
                    table[kept : kept + len(keep)] = numbers("features", i, np.float32).reshape(-1, rank)[keep]
                    read, kept = read + len(ids), kept + len(keep)
                    continue
                ratings = [numbers(n, i, k) for n, k in (("counts", np.int32), ("others", np.int32), ("stars", np.float32))]
                # Factors come first, as a rule; a run that does not find them all there waits.
                early.append((ids, *ratings, whole[i]))
                while early and read == size:
                    yield from solve(*early.pop())
        if read != size:
            raise RuntimeError(f"{read} of {size} factors found")
        for ratings in early:
            yield from solve(*ratings)
        for i, (*sums, blocks) in parts.items():
            yield found(np.array([i], np.int32), solved(*sums), blocks)

    def block(b: int) -> DataFrame:
        known = factors.select(F.lit(b).alias("block"), "ids", "features", "blocks")
        return known.unionByName(runs.where(F.col("block") == b), allowMissingColumns=True).coalesce(1)

    every = reduce(DataFrame.unionByName, [block(b) for b in range(RUN_BLOCKS)])
    return every.mapInArrow(run, _FACTORS)


def _block_session(spark: SparkSession) -> SparkSession:
    """A session in which a union of one-partition frames keeps a partition of each, and a
    task has a few rows at once beside the factors that its worker holds."""
    session = spark.newSession()
    session.conf.set("spark.sql.unionOutputPartitioning", "false")
    session.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(_READ_ROWS))
    bound_batches(session)
    return session


def _write(packed: DataFrame, path: str) -> None:
    packed.write.mode("append").option("parquet.block.size", _WRITTEN_BYTES).parquet(path)


def _unpacked(factors: DataFrame, rank: int) -> DataFrame:
    """(id, features), as Spark's model has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[i].as_buffer(), np.int32)
                values = np.frombuffer(batch.column("features")[i].as_buffer(), np.float32)
                places = np.arange(0, len(values) + 1, rank, dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(places), pa.array(values))
                yield pa.RecordBatch.from_arrays([pa.array(ids), lists], ["id", "features"])

    return factors.select("ids", "features").mapInArrow(run, "id int, features array<float>")


# Ids of a side that are in no block, and what makes (id, features) of them from those of the other side.
Apart = tuple[list[int], Callable[[DataFrame], DataFrame]]


def fit_runs(
    indexed: DataFrame,
    start: DataFrame,
    sides: dict[str, str],
    sizes: dict[str, int],
    iterations: int,
    rank: int,
    penalty: float,
    folder: str | None = None,
    apart: dict[str, Apart] | None = None,
) -> dict[str, DataFrame]:
    """(id, features) of each side of ``indexed``, whose indexes count from 0 without gaps.

    ``sides`` has the side of each half-step and its other side, in order; ``start`` is (id, features)
    of the last one. Ids that are ``apart`` are solved in another way, on the same factors.
    """
    spark = indexed.sparkSession
    own, apart = _block_session(spark), apart or {}
    dealt, runs = table_path(spark, "runs", folder), {}
    for key, other in sides.items():
        ids = apart[key][0] if key in apart else []
        _deal(indexed.where(~F.col(key).isin(ids)) if ids else indexed, key, other, f"{dealt}/{key}")
        runs[key] = own.read.schema(_RUN).parquet(f"{dealt}/{key}")
    paths = {list(sides)[-1]: table_path(spark, "factors", folder)}
    _write(_packed(start), *paths.values())
    for _ in range(iterations):
        for key, other in sides.items():
            path = table_path(spark, "factors", folder)
            known = own.read.schema(_FACTORS).parquet(paths[other])
            _write(_half_step(runs[key], known, sizes[other], rank, penalty), path)
            if key in apart:
                known = _unpacked(spark.read.schema(_FACTORS).parquet(paths[other]), rank)
                _write(_packed(apart[key][1](known)), path)
            # Only the newest factors of a side are read again.
            if key in paths:
                delete_folder(spark, paths[key])
            paths[key] = path
    delete_folder(spark, dealt)
    return {key: _unpacked(spark.read.schema(_FACTORS).parquet(path), rank) for key, path in paths.items()}


def fit_by_runs(indexed: DataFrame, als: ALS, folder: str | None = None) -> Factors:
    """The factors that ``als`` would fit to ``indexed``, whose indexes count from 0 without gaps."""
    sides = {"business_index": "user_index", "user_index": "business_index"}
    sizes = indexed.agg(*[(F.max(key) + 1).alias(key) for key in sides]).first().asDict()
    rank, start = als.getRank(), _start(indexed, als, {key: sizes[key] for key in reversed(sides)})
    found = fit_runs(indexed, start, sides, sizes, als.getMaxIter(), rank, als.getRegParam(), folder)
    return Factors(rank, found["user_index"], found["business_index"])
