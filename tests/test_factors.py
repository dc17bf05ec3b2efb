import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill.operators import factors as A
from reviewmill.operators import recommend as R
from reviewmill.operators import runs as N
from reviewmill.plans.fixtures import read_fixture
from reviewmill.session import BATCH_BYTES

COLUMNS = "user_id string, business_id string, stars double"


def error(ratings, predictions):
    keys = ["user_id", "business_id"]
    each = predictions.groupBy(*keys).agg(F.max("prediction").alias("prediction"))
    joined = ratings.join(each, keys)
    return joined.agg(F.sqrt(F.avg(F.pow(F.col("stars") - F.col("prediction"), 2)))).first()[0]


def low_rank(spark, users, businesses, hot=0, seed=3):
    """Ratings of three true factors; one business may have as many again as all others."""
    rng = np.random.default_rng(seed)
    u, v = rng.random((users, 3)), rng.random((businesses, 3))
    rows = []
    for i in range(users):
        for j in rng.choice(businesses, 12, replace=False):
            rows.append((f"u{i}", f"b{j}", float(1 + 1.3 * u[i] @ v[j])))
    rows += [(f"u{i % users}", "b0", float(1 + 1.3 * u[i % users] @ v[0])) for i in range(hot)]
    return spark.createDataFrame(rows, COLUMNS)


def test_solutions_are_the_best_non_negative_ones():
    rng = np.random.default_rng(0)
    m = rng.normal(size=(40, 12, 4))
    y = rng.normal(size=(40, 12))
    products, targets = np.einsum("nki,nkj->nij", m, m), np.einsum("nki,nk->ni", m, y)
    x = A._solve(products, targets)
    assert (x >= 0).all()
    slope = targets - np.einsum("nij,nj->ni", products, x)
    # No slope where a factor is free, and none that would raise one from zero.
    assert np.abs(slope[x > 1e-9]).max() < 1e-5 and slope[x <= 1e-9].max() < 1e-5


def test_same_error_as_the_library(spark, sf_dir):
    ratings = read_fixture(spark, sf_dir, "rating")
    ours = error(ratings, A.predict(ratings, *A.fit_factors(ratings)))
    theirs = error(ratings, R.fit_score(ratings))
    assert ours == pytest.approx(theirs, rel=0.05)


def test_a_third_of_all_ratings_on_one_business(spark):
    ratings = low_rank(spark, 60, 25, hot=360)
    users, businesses = A.fit_factors(ratings, rank=4, iterations=6, regularisation=0.01)
    assert error(ratings, A.predict(ratings, users, businesses)) < 0.15
    plan = A.factor_sums(
        ratings.join(users, "user_id"), "business_id", 4
    )._jdf.queryExecution().executedPlan().toString()
    # Sums are made in each task before they move.
    assert plan.index("partial_sum") > plan.index("Exchange") and plan.count("HashAggregate") >= 2


def test_folded_in_users_are_as_good_as_fitted_ones(spark):
    ratings = low_rank(spark, 150, 25)
    new = F.pmod(F.xxhash64("user_id"), F.lit(5)) == 0
    _, businesses = A.fit_factors(ratings.where(~new), rank=4, iterations=8, regularisation=0.01)
    folded = A.fold_in(ratings.where(new), businesses, rank=4, regularisation=0.01)
    users, again = A.fit_factors(ratings, rank=4, iterations=8, regularisation=0.01)
    fitted = error(ratings.where(new), A.predict(ratings.where(new), users, again))
    assert error(ratings.where(new), A.predict(ratings.where(new), folded, businesses)) < fitted + 0.02 * 2.0


def test_odd_ratings(spark, rows):
    made = [("a", "x", 2.0), ("a", "y", None), (None, "x", 3.0), ("b", "new", 4.0)]
    ratings = spark.createDataFrame(made, COLUMNS)
    factors = spark.createDataFrame([("x", [1.0, 0.0])], "business_id string, features array<double>")
    assert rows(A.fold_in(ratings, factors, rank=2).select("user_id")) == [("a",)]
    assert A.fold_in(ratings.limit(0), factors, rank=2).count() == 0


def test_blocks_and_frequent_ids_give_what_whole_half_steps_give(spark, monkeypatch):
    ratings = low_rank(spark, 400, 150, hot=1200).repartition(3)
    assert A._frequent(ratings, "business_id") == ["b0"] and A._frequent(ratings, "user_id") == []
    found = A.fit_factors(ratings, rank=3, iterations=2)
    businesses = ratings.select("business_id").distinct().select("business_id", A._start("business_id", 3, 42))
    for _ in range(2):
        known = ratings.join(businesses, "business_id")
        users = A.solve_factors(A.factor_sums(known, "user_id", 3), "user_id", 3).localCheckpoint()
        known = ratings.join(users, "user_id")
        businesses = A.solve_factors(A.factor_sums(known, "business_id", 3), "business_id", 3).localCheckpoint()
    for ours, whole, key in ((found[0], users, "user_id"), (found[1], businesses, "business_id")):
        ours, whole = dict(map(tuple, ours.collect())), dict(map(tuple, whole.collect()))
        assert ours.keys() == whole.keys()
        assert max(np.abs(np.subtract(ours[k], whole[k])).max() for k in whole) < 1e-4


def test_a_half_step_holds_no_ratings(spark, monkeypatch):
    """Blocks of ratings pass by the factors in small batches; frequent ids of both sides are in no block."""
    rows = [(i, j, float(1 + (i * j) % 5)) for i in range(150) for j in range(40)]
    rows += [(i, 99, 3.0) for i in range(150)] + [(999, j, 2.0) for j in range(40) for _ in range(3)]
    ratings = spark.createDataFrame(rows, "user_id long, business_id int, stars double")
    steps, half_step = [], N._half_step

    def watched(*args):
        made = half_step(*args)
        plan = made._jdf.queryExecution().executedPlan().toString()
        batch = made.sparkSession.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
        steps.append(("Exchange" in plan or "CoGroup" in plan, made.rdd.getNumPartitions(), args[2], int(batch)))
        return made

    monkeypatch.setattr(N, "_half_step", watched)
    users, businesses = A.fit_factors(ratings, rank=2, iterations=1)
    assert steps == [(False, N.RUN_BLOCKS, n, BATCH_BYTES) for n in (41, 151)]
    # Ids keep their types, and each gets factors once.
    assert [users.schema["user_id"].dataType.simpleString(), businesses.schema["business_id"].dataType.simpleString()] == ["bigint", "int"]
    assert sorted(r.user_id for r in users.collect()) == [*range(150), 999]
    assert sorted(r.business_id for r in businesses.collect()) == [*range(40), 99]
    assert A.fit_factors(ratings.limit(0), rank=2, iterations=1)[1].count() == 0


def test_sums_move_only_where_they_are_smaller_than_the_ratings(spark):
    rows = [(f"u{i}", float(i % 5), [1.0, 2.0 + i]) for i in range(60)] + [("hot", 2.0, [0.5, float(i)]) for i in range(90)]
    ratings = spark.createDataFrame(rows, "user_id string, stars double, features array<double>").coalesce(1)
    moved = A._combined(ratings, "user_id", 2)
    assert moved.count() == 61 and moved.where("sums IS NOT NULL").count() == 1
    sums = [sorted(map(tuple, f(ratings, "user_id", 2).collect())) for f in (A.spread_sums, A.factor_sums)]
    assert sums[0] == sums[1]
    plan = A.spread_sums(ratings, "user_id", 2)._jdf.queryExecution().executedPlan().toString()
    # Ratings move, then all sums of a key are made in one place.
    assert plan.rindex("partial_sum") < plan.index("Exchange hashpartitioning(user_id") and plan.count("Exchange") == 1
