"""Near-duplicate vectors by collision counting on one-dimensional projections.

Vectors are sorted on many random one-dimensional projections. The projections
come in layouts of GROUP each. A layout cuts every one of its projections into
windows with a random start, and vectors in the same window of all of them meet
in a task. There each vector is a query: its collisions with every other
are counted over PROJECTIONS windows centred on the query, and pairs that reach
a count calibrated for recall are verified by cosine in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.graph import components
from reviewmill.session import materialize

# Layouts, projections of each, and projections that are counted in a task.
LAYOUTS, GROUP, PROJECTIONS = 16, 6, 24
# Width of a layout's windows and half the width of a query's, in distances of a
# pair right at the threshold. With these a layout joins such a pair with
# probability 0.358, one of the layouts with 0.999; closer pairs surely.
WINDOW, REACH = 5.06, 2.0
# A pair at the threshold falls short of the calibrated count with this probability.
MISSED = 1e-4
# Rows of one cell that a task compares, and rows a task gets in all.
BLOCK, TASK_ROWS = 2048, 16384
# Queries of a cell that are counted and verified at a time.
SLAB = 256


def calibrated_count() -> int:
    """The largest count that a pair at the threshold reaches, but for MISSED."""
    hit = math.erf(REACH / math.sqrt(2))
    below = 0.0
    for count in range(PROJECTIONS + 1):
        below += math.comb(PROJECTIONS, count) * hit**count * (1 - hit) ** (PROJECTIONS - count)
        if below > MISSED:
            return count
    return PROJECTIONS


def _directions(dim: int, seed: int, count: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


def _emit(threshold: float, seed: int):
    """Vectors with the code of their cell in every layout."""
    distance = math.sqrt(2 - 2 * threshold)

    def run(batches):
        for rows in batches:
            for _, part in rows.groupby("dim", sort=False):
                units = np.stack(part["unit"].to_list())
                dim = units.shape[1]
                along = units @ _directions(dim, seed, LAYOUTS * GROUP)
                starts = np.random.default_rng(seed + 1).random(LAYOUTS * GROUP)
                windows = np.floor(along / (WINDOW * distance) + starts).astype(np.int64)
                mult = np.random.default_rng(seed + 2).integers(1, 1 << 62, GROUP) * 2 + 1
                codes = (windows.reshape(-1, LAYOUTS, GROUP) * mult).sum(axis=2)
                yield pd.DataFrame(
                    {
                        "key": part["key"].to_numpy(),
                        "first_id": part["first_id"].to_numpy(),
                        "copies": part["copies"].to_numpy(),
                        "codes": list(codes),
                        "unit": part["unit"].to_numpy(),
                    }
                )

    return run


def _meet(threshold: float, seed: int):
    least, distance = calibrated_count(), math.sqrt(2 - 2 * threshold)

    def cell_pairs(units, codes, layout, own, crossing):
        """Verified pairs of one cell that no earlier layout has joined, slab by slab."""
        along = units @ _directions(units.shape[1], seed + 3, PROJECTIONS)
        ranges = []
        for values in along.T:
            order = np.argsort(values)
            ranked = values[order]
            first = np.searchsorted(ranked, values - REACH * distance, "left")
            stop = np.searchsorted(ranked, values + REACH * distance, "right")
            place = np.empty(len(values), np.int64)
            place[order] = np.arange(len(values))
            ranges.append((place, first, stop))
        for start in range(0, len(units), SLAB):
            rows = slice(start, start + SLAB)
            counts = np.zeros((len(units[rows]), len(units) - start), np.int8)
            for place, first, stop in ranges:
                after = place[None, start:]
                counts += (after >= first[rows, None]) & (after < stop[rows, None])
            good = np.triu(counts >= least, 1)
            if crossing:
                good &= own[rows, None] != own[None, start:]
            for earlier in range(layout):
                good &= codes[rows, earlier][:, None] != codes[None, start:, earlier]
            if good.any():
                good &= units[rows] @ units[start:].T >= threshold
                i, j = np.nonzero(good)
                yield i + start, j + start

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for key, part in rows.groupby(["layout", "cell", "dim", "x", "y"], sort=False):
            if len(part) < 2:
                continue
            ids, weights = part["first_id"].to_numpy(), part["copies"].to_numpy()
            pairs = cell_pairs(
                np.stack(part["unit"].to_list()),
                np.stack(part["codes"].to_list()),
                key[0],
                part["own"].to_numpy(),
                key[3] != key[4],
            )
            links = np.zeros(len(ids))
            root = np.arange(len(ids))
            for i, j in pairs:
                links += np.bincount(i, weights[j], len(ids)) + np.bincount(j, weights[i], len(ids))
                # The smallest place reachable within this cell; most pairs are joined already.
                while len(i):
                    for a, b in zip(i[:BLOCK], j[:BLOCK]):
                        while root[a] != a:
                            a = root[a]
                        while root[b] != b:
                            b = root[b]
                        root[max(a, b)] = min(a, b)
                    while (root != root[root]).any():
                        root = root[root]
                    i, j = i[BLOCK:], j[BLOCK:]
                    apart = root[i] != root[j]
                    i, j = i[apart], j[apart]
            if not links.any():
                continue
            linked = np.flatnonzero(links)
            out.append(
                pd.DataFrame(
                    {
                        "key": part["key"].to_numpy()[linked],
                        "first_id": ids[linked],
                        "links": links[linked].astype(np.int64),
                        "joined": ids[root[linked]],
                    }
                )
            )
        if out:
            return pd.concat(out)
        return pd.DataFrame({"key": [], "first_id": [], "links": [], "joined": []})

    return run


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    seed: int = 7,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows found with cosine >= ``threshold``, all of
    them verified in double precision; ``component_id`` is the smallest id
    reachable by links, itself included.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing; nor do vectors of different lengths. Identical vectors are
    one node with a count, so copies never meet in a task, yet count as links. Rows that
    repeat an id count as rows; if their vectors differ, the id ties the components
    of these together where it is the smallest id with such a vector. Rows without an id
    link with nothing. No rows give no rows; other columns are ignored.

    A cell beyond BLOCK rows is dealt to pairs of blocks over several tasks. Each
    pair is counted in the first layout that joins it, so a task returns one row
    per linked vector, not the pairs.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.array_max(F.transform("v", F.abs))
    usable = F.col("vec_id").isNotNull() & sound & (largest > 0)
    rows = rows.withColumn("key", F.when(usable, F.unhex(F.sha2(F.to_json("v"), 256))))
    # Scaled first, so that squares neither overflow nor vanish.
    usable = rows.filter("key IS NOT NULL").withColumn("v", F.transform("v", lambda x: x / largest))
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    classes = usable.groupBy("key").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("v").alias("v")
    )
    classes = classes.withColumn("size", size).select(
        "key",
        "first_id",
        "copies",
        F.size("v").alias("dim"),
        F.transform("v", lambda x: x / F.col("size")).alias("unit"),
    )
    classes = materialize(classes, "vectors")

    coded = classes.mapInPandas(
        _emit(threshold, seed),
        "key binary, first_id long, copies long, codes array<long>, unit array<double>",
    )
    coded = materialize(coded, "vector-codes")
    cells = coded.select("key", F.size("unit").alias("dim"), F.posexplode("codes").alias("layout", "cell"))
    keys = ["layout", "cell", "dim"]
    sizes = cells.groupBy(*keys).count().filter("count > 1")
    sizes = sizes.select(*keys, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    dealt = (
        cells.join(sizes, keys)
        .withColumn("own", F.pmod(F.xxhash64("key", "layout"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*keys, "key", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    )
    dealt = materialize(dealt, "vector-cells")
    tasks = max(1, dealt.count() // TASK_ROWS)
    full = dealt.join(coded, "key")
    full = full.withColumn("task", F.pmod(F.xxhash64(*keys, "x", "y"), F.lit(tasks)))
    found = full.groupBy("task").applyInPandas(
        _meet(threshold, seed), "key binary, first_id long, links long, joined long"
    )
    found = materialize(found, "vector-links")
    labels = components(found.select("first_id", "joined"), "first_id", "joined")
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))

    labelled = (
        classes.select("key", "first_id", "copies")
        .join(counts, "key", "left")
        .join(labels.toDF("first_id", "component"), "first_id", "left")
    )
    component = F.coalesce("component", "first_id", "vec_id")
    return (
        rows.select("vec_id", "key")
        .join(labelled, "key", "left")
        .select(
            "vec_id",
            F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )
