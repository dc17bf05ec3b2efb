import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from reviewmill.operators import recommend as R
from reviewmill.operators import runs as N
from reviewmill.plans.fixtures import read_fixture

COLUMNS = "user_id string, business_id string, stars double"


@pytest.fixture(scope="module")
def ratings(spark, sf_dir):
    return read_fixture(spark, sf_dir, "rating").persist()


@pytest.fixture(scope="module")
def predictions(ratings):
    return R.fit_score(ratings).persist()


@pytest.mark.parametrize("key", ["user_id", "business_id"])
def test_index_orders_by_frequency_then_id(ratings, rows, key):
    model = StringIndexer(inputCol=key, outputCol="index").fit(ratings)
    expected = [(label, i) for i, label in enumerate(model.labels)]
    both = R.dense_indexes(ratings, ["user_id", "business_id"])
    for indexes in (both, R.dense_indexes(ratings, [key])):
        assert rows(R.index_of(indexes, key, "index")) == sorted(expected, key=repr)


def test_index_is_dense_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 1777).cast("string").alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        twice = df.union(spark.createDataFrame([(None,)], "k string")).selectExpr("k", "k AS l")
        index = R.dense_indexes(twice, ["k", "l"])
        got = sorted(r.i for r in R.index_of(index, "k", "i").collect())
        assert got == sorted(r.i for r in R.index_of(index, "l", "i").collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == list(range(1777))


def test_one_prediction_per_rating(ratings, predictions):
    assert predictions.columns == ["user_id", "business_id", "prediction"]
    assert predictions.count() == ratings.count()
    assert predictions.where("prediction < 0 OR prediction IS NULL OR isnan(prediction)").isEmpty()
    counts = ratings.groupBy("user_id", "business_id").count()
    scored = predictions.groupBy("user_id", "business_id").count()
    assert counts.exceptAll(scored).isEmpty()


def test_fit_beats_the_global_mean(ratings, predictions):
    scores = predictions.groupBy("user_id", "business_id").agg(F.max("prediction").alias("p"))
    mean = ratings.agg(F.avg("stars")).first()[0]
    error = ratings.join(scores, ["user_id", "business_id"]).agg(
        F.sqrt(F.avg((F.col("stars") - F.col("p")) ** 2)).alias("model"),
        F.sqrt(F.avg((F.col("stars") - mean) ** 2)).alias("mean"),
    ).first()
    assert error.model < error["mean"]


def test_same_seed_same_predictions(ratings, predictions):
    again = R.fit_score(ratings).groupBy("user_id", "business_id").agg(F.max("prediction").alias("q"))
    first = predictions.groupBy("user_id", "business_id").agg(F.max("prediction").alias("p"))
    gap = again.join(first, ["user_id", "business_id"]).agg(F.max(F.abs(F.col("p") - F.col("q"))))
    assert gap.first()[0] < 1e-3


def test_incomplete_ratings_are_left_out(spark, rows):
    values = [("u1", "b1", 4.0), ("u1", "b1", 2.0), ("u2", "b2", 5.0)]
    values += [(None, "b1", 1.0), ("u1", None, 1.0), ("u1", "b2", None)]
    got = R.fit_score(spark.createDataFrame(values, COLUMNS), maxIter=1)
    assert rows(got, "user_id", "business_id") == [("u1", "b1"), ("u1", "b1"), ("u2", "b2")]


def test_unknown_users_get_no_prediction(spark, rows):
    known = spark.createDataFrame([("u1", "b1", 4.0), ("u2", "b2", 5.0)], COLUMNS)
    asked = spark.createDataFrame([("u1", "b2", 1.0), ("u9", "b1", 1.0)], COLUMNS)
    got = R.fit_score(known, asked, maxIter=1)
    assert rows(got, "user_id", "business_id") == [("u1", "b2")]


def test_no_ratings(spark):
    assert R.fit_score(spark.createDataFrame([], COLUMNS)).count() == 0


def test_scores_are_those_of_the_model(ratings, monkeypatch):
    """Also where blocks are cut by users; no rating moves with factors of its own."""
    monkeypatch.setattr(R, "CELL_ROWS", 100)
    usable = R.usable_ratings(ratings)
    indexes = R.dense_indexes(usable, ["user_id", "business_id"])
    indexed = R.materialize(R.index_ratings(usable, indexes), "indexed")
    model = R.fit_ratings(indexed, maxIter=2)
    found = R.score(model, indexed, indexes, stars=True)
    names = [R.index_of(indexes, f"{k}_id", f"{k}_index") for k in ("user", "business")]
    columns = ["user_id", "business_id", "prediction", "stars"]
    expected = model.transform(indexed).join(names[0], "user_index").join(names[1], "business_index").select(columns)
    assert found.columns == columns
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_no_rating_moves_with_factors_of_its_own(spark):
    """Factors are sent once a user and block of businesses, not once a rating."""
    made = spark.range(6000).selectExpr(
        "CAST(id % 100 AS STRING) AS user_id", "CAST(id DIV 100 AS STRING) AS business_id", "CAST(id % 5 AS DOUBLE) AS stars"
    )
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in off}
    moved = []

    def walk(node):
        if node.nodeName().startswith("Exchange") and "features" in node.output().toString():
            moved.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    for key, value in off.items():
        spark.conf.set(key, value)
    try:
        scored = R.fit_score(made, maxIter=1)
        assert len(scored.collect()) == 6000
        walk(scored._jdf.queryExecution().executedPlan())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    # To the names, then to the blocks of businesses.
    assert moved and sum(moved) <= 100 + 60 + 100 * R.SCORE_BLOCKS + 60


def skewed(spark):
    """Indexed ratings, of which business 0 has a third and user 0 many."""
    made = spark.range(3000).selectExpr(
        "CAST(IF(id % 10 = 0, 0, id % 97) AS INT) AS user_index",
        "CAST(IF(id % 3 = 0, 0, (id * 7) % 41) AS INT) AS business_index",
        "CAST(1 + (id * id) % 9 * 0.5 AS DOUBLE) AS stars",
    )
    return R.materialize(made.repartition(3), "skewed")


def gap(left, right):
    """The largest difference of two tables of factors, which hold the same ids."""
    keys = [sorted(r.id for r in f.select("id").collect()) for f in (left, right)]
    assert keys[0] == keys[1] == list(range(len(keys[0])))
    both = left.join(right.withColumnRenamed("features", "other"), "id")
    each = F.explode(F.zip_with("features", "other", lambda a, b: F.abs(a - b)))
    return both.select(each.alias("d")).agg(F.max("d")).first()[0]


@pytest.mark.parametrize("held", [1 << 19, 64])
def test_many_ratings_get_the_factors_of_the_library(spark, monkeypatch, held):
    """Also where the ratings of one id come in several runs."""
    indexed = skewed(spark)
    few = R.fit_ratings(indexed, maxIter=5)
    monkeypatch.setattr(R, "SMALL_RATINGS", 100)
    monkeypatch.setattr(N, "_HELD", held)
    many = R.fit_ratings(indexed, maxIter=5)
    assert isinstance(many, N.Factors) and many.rank == few.rank
    assert gap(few.userFactors, many.userFactors) < 1e-4
    assert gap(few.itemFactors, many.itemFactors) < 1e-4


def test_many_ratings_write_factors_once_a_half_step(spark, monkeypatch):
    """No half-step shuffles, each is one task a block, and Spark's ALS gives start values only."""
    steps, fits = [], []
    half_step, fit = N._half_step, R.ALS.fit

    def watched(*args):
        made = half_step(*args)
        plan = made._jdf.queryExecution().executedPlan().toString()
        steps.append(("Exchange" in plan, made.rdd.getNumPartitions(), args[2]))
        return made

    def counted(als, ratings):
        fits.append((als.getMaxIter(), ratings.count()))
        return fit(als, ratings)

    monkeypatch.setattr(R, "SMALL_RATINGS", 100)
    monkeypatch.setattr(N, "_half_step", watched)
    monkeypatch.setattr(R.ALS, "fit", counted)
    R.fit_ratings(skewed(spark), maxIter=2)
    assert fits == [(0, 97)]
    assert steps == [(False, N.RUN_BLOCKS, 97), (False, N.RUN_BLOCKS, 41)] * 2


def test_predictions_of_many_ratings_are_those_of_few(ratings, predictions, monkeypatch):
    monkeypatch.setattr(R, "SMALL_RATINGS", 100)
    again = R.fit_score(ratings).groupBy("user_id", "business_id").agg(F.max("prediction").alias("q"), F.count("*").alias("m"))
    first = predictions.groupBy("user_id", "business_id").agg(F.max("prediction").alias("p"), F.count("*").alias("n"))
    both = again.join(first, ["user_id", "business_id"], "full")
    far = both.where("m IS NULL OR n IS NULL OR m <> n OR abs(p - q) > 1e-3")
    assert far.isEmpty()
