import tracemalloc

import duckdb
import numpy as np
import pandas as pd
import pytest

from reviewmill.llm import near_vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(pairs, threshold=0.95):
    """n_links and component of each row by all cosines in double precision."""
    out, units = [], []
    for vec_id, v in pairs:
        good = vec_id is not None and v and all(x is not None and np.isfinite(x) for x in v)
        a = np.array(v, np.float32).astype(float) if good else None
        units.append(a / np.linalg.norm(a) if good and np.linalg.norm(a) else None)
    home = list(range(len(pairs)))
    links = [0] * len(pairs)

    def root(x):
        while home[x] != x:
            x = home[x]
        return x

    order = sorted(range(len(pairs)), key=lambda i: (pairs[i][0] is None, pairs[i][0]))
    rank = {i: n for n, i in enumerate(order)}
    for i, x in enumerate(units):
        for j in range(i):
            y = units[j]
            if x is not None and y is not None and len(x) == len(y) and x @ y >= threshold - 1e-12:
                links[i] += 1
                links[j] += 1
                a, b = sorted((root(i), root(j)), key=rank.get)
                home[b] = a
    for i, (vec_id, _) in enumerate(pairs):
        first = pairs[root(i)][0]
        out.append((vec_id, links[i], first, vec_id == first))
    return sorted(out, key=repr)


def groups(rng, count, size, noise, dim=32):
    out = []
    for _ in range(count):
        centre = rng.standard_normal(dim)
        out += [(centre + noise * rng.standard_normal(dim)).tolist() for _ in range(size)]
    return out


@pytest.mark.parametrize("block", [2048, 7])
def test_same_as_all_pairs(spark, rows, monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK", block)
    rng = np.random.default_rng(3)
    vectors = groups(rng, 12, 8, 0.1) + groups(rng, 60, 1, 0.1) + groups(rng, 1, 40, 0.05)
    pairs = [(i * 3, v) for i, v in enumerate(vectors)] + [(1000 + i, vectors[0]) for i in range(5)]
    frame = spark.createDataFrame([(*p, 0) for p in pairs], SCHEMA).repartition(3)
    assert rows(V.near_vectors(frame)) == brute(pairs)


def test_recall_on_real_vectors(spark, sf_dir):
    got = V.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    pairs = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf_dir}/embeddings.parquet'").fetchall()
    found, all_links = got.agg({"n_links": "sum"}).first()[0], sum(r[1] for r in brute(pairs))
    assert 0.9 * all_links <= found <= all_links


def test_odd_vectors(spark, rows):
    nan, inf = float("nan"), float("inf")
    pairs = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, inf]), (6, [None, 1.0]), (7, [1.0, 1.0]),
        (8, [2.0, 2.0]), (9, [1.0, 1.0, 1.0]), (10, [1e-30, 1e-30]), (11, [1e30, 1e30]), (12, [-1.0, -1.0]),
        (13, [1.0, 1.0]), (14, [1.0, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 1.0]), (3, [5.0, -1.0]),
    ]
    frame = spark.createDataFrame([(*p, 0) for p in pairs], SCHEMA).withColumnRenamed("label", "key")
    assert rows(V.near_vectors(frame)) == brute(pairs)
    assert V.near_vectors(frame.limit(0)).count() == 0


def test_an_id_with_several_vectors(spark, rows):
    """It ties its vectors' components together; links count rows of each vector."""
    pairs = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.999, 0.01]), (3, [0.01, 0.999]), (4, [-1.0, 0.1])]
    got = V.near_vectors(spark.createDataFrame([(*p, 0) for p in pairs], SCHEMA))
    assert rows(got) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)]


def test_calibration():
    """Pairs right at the threshold reach the count, but for the given share."""
    rng = np.random.default_rng(0)
    distances = rng.standard_normal((20_000, V.PROJECTIONS))
    counts = (np.abs(distances) <= V.REACH).sum(axis=1)
    assert (counts < V.calibrated_count()).mean() <= V.MISSED + 3e-4


def noisy(count, dim=64):
    rng = np.random.default_rng(11)
    found = rng.standard_normal(dim) + 0.1 * rng.standard_normal((count, dim))
    return found / np.linalg.norm(found, axis=1)[:, None]


def test_crossing_blocks_of_near_copies_fit_a_task():
    """Two full blocks whose pairs all collide are verified without a copy per pair."""
    units = noisy(2 * V.BLOCK)
    ids = np.arange(len(units))
    rows = pd.DataFrame({"key": [b"%d" % i for i in ids], "first_id": ids, "copies": 1, "own": ids % 2})
    rows = rows.assign(layout=1, cell=5, dim=64, x=0, y=1, unit=list(units), codes=[[int(i), 0] for i in ids])
    tracemalloc.start()
    got = V._meet(0.95, 7)(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    linked = (units @ units.T >= 0.95) & (ids[:, None] % 2 != ids % 2)
    assert linked.any(axis=1).all() and (got["joined"] == 0).all()
    assert got["links"].tolist() == linked.sum(axis=1).tolist()
    assert peak < 300e6


def test_5000_noisy_copies(spark):
    units = noisy(5000)
    pairs = list(enumerate(units.tolist()))
    frame = spark.createDataFrame(pairs, "vec_id long, embedding array<double>").repartition(3)
    got = V.near_vectors(frame).orderBy("vec_id").toPandas()
    assert got["n_links"].tolist() == ((units @ units.T >= 0.95).sum(axis=1) - 1).tolist()
    assert (got["component_id"] == 0).all()
