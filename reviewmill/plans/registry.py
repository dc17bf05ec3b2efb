"""Every query by name, over the record tables derived from the test data."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.columns import with_date_parts, with_event_time
from reviewmill.functions.phrases import label_by_phrases
from reviewmill.functions.text import (
    NEGATIVE,
    POSITIVE,
    label_by_join,
    label_sentiment,
    lexicon_table,
    literal_weights,
    polarity,
)
from reviewmill.operators.aggregates import category_ratings, labelled, popularity_aggregation
from reviewmill.operators.factors import fit_factors, fold_in, predict
from reviewmill.operators.names import business_names
from reviewmill.operators.recommend import dense_indexes, fit_score, index_of
from reviewmill.plans import charts
from reviewmill.plans.build import build_tables
from reviewmill.plans.fixtures import (
    LEXICON,
    NEGATORS,
    PHRASES,
    UNICODE_LEXICON,
    large_lexicon,
    read_fixture,
)
from reviewmill.plans.oracle import BUILT, DEDUPED, REFRESHED, STREAMED, oracle_sql
from reviewmill.plans.refresh import CHARTS, refresh
from reviewmill.plans.tables import RESULT_TABLES, result_table
from reviewmill.session import materialize, scratch_path, stream_session
from reviewmill.sources.results import read_result, read_versions, table_path, write_batch
from reviewmill.sources.storage import delete_folder
from reviewmill.sources.tables import limited_export
from reviewmill.sources.topics import (
    encode_records,
    parse_records,
    publish_to_files,
    subscribe_to_files,
    topic_folder,
)
from reviewmill.streaming import queries as streams

Query = Callable[[SparkSession, str], DataFrame]

__all__ = ["queries", "oracle_sql"]

PREFIX = "records"
# Pieces that a topic is published in; each is a micro-batch of its own, of as many
# files as the input has parts.
BATCHES = 3


def _table(name: str) -> Query:
    record_type = RESULT_TABLES[name].record_type
    return lambda spark, sf_dir: result_table(
        name, read_fixture(spark, sf_dir, record_type), LEXICON
    )


def _chart(name: str) -> Query:
    table, build, named = CHARTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = _RESULTS[table](spark, sf_dir)
        if not named:
            return build(result)
        return build(result, business_names(read_fixture(spark, sf_dir, "business")))

    return run


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A join gives the ratings: store them once instead of joining twice.
    return fit_score(materialize(read_fixture(spark, sf_dir, "rating"), "ratings"))


def _category_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_ratings(read_fixture(spark, sf_dir, "business"))


# Result tables as the charts read them; stored tables have no order either.
_RESULTS: dict[str, Query] = {
    **{name: _table(name) for name in RESULT_TABLES},
    "top_rated_categories": _category_ratings,
    "predictions": _predictions,
}


def _category_pie(spark: SparkSession, sf_dir: str) -> DataFrame:
    pie = charts.category_pie(_RESULTS["category_distribution"](spark, sf_dir))
    return pie.withColumn("share", F.round("share", 6))


def _labels(record_type: str, columns: list[str], lexicon=lambda spark: LEXICON) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        records = read_fixture(spark, sf_dir, record_type)
        return label_sentiment(records, lexicon(spark)).select(*columns, "sentiment")

    return run


def _review_labels_negation(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = read_fixture(spark, sf_dir, "review").select("review_id", "text")
    return label_sentiment(reviews, LEXICON, negators=NEGATORS).select("review_id", "sentiment")


def _review_labels_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = read_fixture(spark, sf_dir, "review").select("review_id", "text")
    labelled = label_by_join(reviews, lexicon_table(spark, LEXICON))
    return labelled.select("review_id", "sentiment")


def _review_labels_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = read_fixture(spark, sf_dir, "review").select("review_id", "text")
    lexicon = spark.createDataFrame(PHRASES, "phrase string, weight double, factor double")
    return label_by_phrases(reviews, lexicon).select("review_id", "sentiment")


def _review_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = polarity(F.col("text"), literal_weights(spark, LEXICON))
    return read_fixture(spark, sf_dir, "review").select(
        "review_id", F.round(mean, 6).alias("polarity")
    )


def _review_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = with_date_parts(with_event_time(read_fixture(spark, sf_dir, "review")))
    return reviews.select("review_id", "review_year", "review_month", "review_day")


def _business_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return business_names(read_fixture(spark, sf_dir, "business"))


def _json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(encode_records(read_fixture(spark, sf_dir, "business")), "business")


def _json_roundtrip_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a binary id of the store they come from, as topics carry them."""
    reviews = read_fixture(spark, sf_dir, "review")
    documents = reviews.withColumn("_id", F.unhex(F.md5("review_id")))
    return parse_records(encode_records(documents), "review")


def _limited_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limited_export(read_fixture(spark, sf_dir, "business"), "business_id", 100)


def _business_lookup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids with many names each; the last one by an order column counts."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    named = parts.select(
        (F.col("p_partkey") % 50).cast("string").alias("business_id"),
        F.col("p_name").alias("name"),
        "p_size",
    )
    return business_names(named, F.col("p_size"))


# Measures by which a stale row falls behind the current one of its key.
_STALE = {
    "sentiment_top_positive": ["review_count"],
    "popularity_top": ["count"],
    "users_top": ["review_count"],
    "categories_top": ["average_rating"],
    "cities_top": ["count"],
}


def _dedup(name: str) -> Query:
    """A chart over a table that holds an older row of every key as well."""
    table, build, named = CHARTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        current = _RESULTS[table](spark, sf_dir)
        older = current.withColumns(
            {c: (F.col(c) - 1).cast(current.schema[c].dataType) for c in _STALE[name]}
        )
        stored = current.union(older).union(current)
        if not named:
            return build(stored)
        return build(stored, business_names(read_fixture(spark, sf_dir, "business")))

    return run


def _review_trend_series_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of some hundred businesses, most of them below the trend's threshold."""
    number = F.col("review_id").cast("bigint")
    business = F.when(number % 3 == 0, 100 + number % 400).otherwise(number % 16)
    reviews = read_fixture(spark, sf_dir, "review").withColumn("business_id", business.cast("string"))
    trend = result_table("review_trend_aggregation", reviews, LEXICON)
    names = business_names(read_fixture(spark, sf_dir, "business"))
    return charts.review_trend_series(trend, names)


def _counted(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("user_id", "business_id").agg(F.count("*").alias("predictions"))


def _predictions_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(_predictions(spark, sf_dir))


def _predictions_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many predictions there are, how many are unusable, and whether they beat the mean."""
    ratings = materialize(read_fixture(spark, sf_dir, "rating"), "ratings")
    # Each prediction with the stars of its rating, instead of a join of both.
    scored = materialize(fit_score(ratings, stars=True), "scored")
    mean = ratings.agg(F.avg("stars")).first()[0]
    error = scored.agg(
        (F.avg(F.pow(F.col("stars") - F.col("prediction"), 2))
         < F.avg(F.pow(F.col("stars") - mean, 2))).alias("better_than_mean")
    )
    counts = scored.agg(
        F.count("*").alias("predictions"),
        F.count_if(F.col("prediction") < 0).alias("negative"),
        F.count_if(F.isnan("prediction") | F.col("prediction").isNull()).alias("undefined"),
    )
    # One row each.
    return counts.join(F.broadcast(error))


# Users that are not there when the factors are fitted.
_NEW_USER = "CAST(user_id AS BIGINT) % 5 = 0"
_HALF_STEPS = 3


def _fitted_without_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All ratings, and business factors fitted on those of the other users."""
    ratings = materialize(read_fixture(spark, sf_dir, "rating"), "ratings")
    _, businesses = fit_factors(ratings.where(f"NOT ({_NEW_USER})"), iterations=_HALF_STEPS)
    return ratings, businesses


def _judged_predictions(ratings: DataFrame, users: DataFrame, businesses: DataFrame) -> DataFrame:
    """How many ratings of new users are predicted, and whether better than by their mean."""
    scored = predict(ratings.where(_NEW_USER), users, businesses)
    keys = ["user_id", "business_id"]
    each = scored.groupBy(*keys).agg(F.max("prediction").alias("prediction"), F.count("*").alias("n"))
    stars = ratings.where(_NEW_USER).groupBy(*keys).agg(
        F.sum("stars").alias("sum"), F.sum(F.col("stars") * F.col("stars")).alias("squares"), F.count("*").alias("n")
    )
    joined = stars.join(each.drop("n"), keys)
    p, n = F.col("prediction").cast("double"), F.col("n")
    squared = F.sum(F.col("squares") - 2 * p * F.col("sum") + n * p * p)
    spread = F.sum("squares") - F.sum("sum") * F.sum("sum") / F.sum("n")
    return joined.agg(F.sum("n").alias("predictions"), (squared < spread).alias("better_than_mean"))


def _predictions_fold_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New users against factors that were fitted without them."""
    ratings, businesses = _fitted_without_new(spark, sf_dir)
    users = materialize(fold_in(ratings.where(_NEW_USER), businesses), "users")
    return _judged_predictions(ratings, users, businesses)


def _stream_predictions_fold_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the new users' ratings in several batches of a stream."""
    topics = _Topics(spark, sf_dir, "stream-fold-in")
    ratings, businesses = _fitted_without_new(spark, sf_dir)
    path = f"{topics.base}/factors"
    businesses.write.parquet(path)
    topics.publish("review", ratings.where(_NEW_USER))
    streams.start_user_factors(
        topics.subscribe, topics.base, path, trigger={"availableNow": True}
    ).awaitTermination()
    return _judged_predictions(ratings, topics.result(spark, "user_factors"), businesses)


def _predictions_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top list over predictions by a fixed expression, with ties and unnamed ids."""
    user, business = F.col("user_id").cast("bigint"), F.col("business_id").cast("bigint")
    made = read_fixture(spark, sf_dir, "rating").select(
        "user_id",
        F.when(business % 7 == 0, F.concat(F.lit("x"), "business_id"))
        .otherwise(F.col("business_id"))
        .alias("business_id"),
        ((user * 31 + business * 17) % 23).cast("float").alias("prediction"),
    )
    return charts.predictions_top50(made, business_names(read_fixture(spark, sf_dir, "business")))


def _index(key: str, name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ratings = read_fixture(spark, sf_dir, "rating")
        return index_of(dense_indexes(ratings, [key]), key, name)

    return run


def _built(name: str) -> Query:
    """One result table out of the shared batch build."""
    record_type = RESULT_TABLES[name].record_type

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        records = {record_type: read_fixture(spark, sf_dir, record_type)}
        return build_tables(records, LEXICON)[name]

    return run


class _Topics:
    """Topics in a fresh scratch folder, filled from the record tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, label: str):
        self.spark = stream_session(spark)
        self.sf_dir = sf_dir
        self.base = scratch_path(spark, label)
        # Files of a micro-batch; without a number it takes all that are there.
        self.limit: dict[str, str] = {}

    def read(self, record_type: str) -> DataFrame:
        return read_fixture(self.spark, self.sf_dir, record_type)

    def publish(self, record_type: str, frame: DataFrame | None = None) -> None:
        """All records, in BATCHES micro-batches; no task writes more than its part of the input."""
        frame = self.read(record_type) if frame is None else frame
        files = -(-frame.rdd.getNumPartitions() // BATCHES)
        self.limit = {"maxFilesPerTrigger": str(files)}
        publish_to_files(frame.repartition(files * BATCHES), self.base, PREFIX, record_type)

    def publish_batch(self, record_type: str, frame: DataFrame) -> None:
        """The records of one micro-batch, written where they are read."""
        self.limit = {}
        publish_to_files(frame, self.base, PREFIX, record_type)

    def subscribe(self, record_type: str) -> DataFrame:
        return subscribe_to_files(self.spark, self.base, PREFIX, record_type, **self.limit)

    def result(self, spark: SparkSession, table: str) -> DataFrame:
        return read_result(spark, streams.results_root(self.base), table)


def _stream_table(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        topics = _Topics(spark, sf_dir, f"stream-{name}")
        topics.publish(RESULT_TABLES[name].record_type)
        streams.start_table(
            name, topics.subscribe, topics.base, LEXICON, availableNow=True
        ).awaitTermination()
        return topics.result(spark, name)

    return run


def _stream_dedup_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every review is delivered twice, in two runs on one checkpoint."""
    name = "sentiment_aggregation"
    topics = _Topics(spark, sf_dir, "stream-dedup")
    for _ in range(2):
        topics.publish("review")
        streams.start_deduplicated_table(
            name, "review_id", topics.subscribe, topics.base, LEXICON, availableNow=True
        ).awaitTermination()
    return topics.result(spark, name)


def _stream_business_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All businesses, then every second and every third one under a new name."""
    topics = _Topics(spark, sf_dir, "stream-names")
    businesses = topics.read("business")
    for own in range(BATCHES):
        renamed = businesses.where(F.col("business_id").cast("bigint") % (own + 1) == 0)
        if own:
            renamed = renamed.withColumn("name", F.concat("name", F.lit(f" {own}")))
        topics.publish_batch("business", renamed)
        streams.start_business_names(topics.subscribe, topics.base, availableNow=True).awaitTermination()
    return business_names(topics.result(spark, "business_names"))


def _stream_user_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users come in three parts, each with those of the parts before; numbers stay."""
    topics = _Topics(spark, sf_dir, "stream-index")
    reviews = topics.read("review")
    for own in range(BATCHES):
        known = reviews.where(F.col("user_id").cast("bigint") % BATCHES <= own)
        topics.publish_batch("review", known)
        streams.start_index("user_id", topics.subscribe, topics.base, availableNow=True).awaitTermination()
    return topics.result(spark, "user_index")


def _stream_dedup_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every review is delivered in each of three runs, by a query without a time limit."""
    name = "sentiment_aggregation"
    topics = _Topics(spark, sf_dir, "stream-dedup-long")
    for _ in range(3):
        topics.publish_batch("review", topics.read("review"))
        streams.start_deduplicated_table(
            name, "review_id", topics.subscribe, topics.base, LEXICON, within=None, availableNow=True
        ).awaitTermination()
    return topics.result(spark, name)


def _stream_dedup_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews and lines that are no records, all delivered twice."""
    topics = _Topics(spark, sf_dir, "stream-malformed")
    customers = topics.spark.read.parquet(f"{sf_dir}/customer.parquet")
    junk = customers.select(F.concat(F.lit("junk "), F.col("c_custkey").cast("string")).alias("value"))
    folder = topic_folder(topics.base, PREFIX, "review")
    for _ in range(2):
        topics.publish("review")
        junk.write.mode("append").text(folder)
    records = parse_records(topics.subscribe("review"), "review", identity=streams.IDENTITY)
    counted = popularity_aggregation(streams.drop_redelivered(records, "review_id"))
    streams.start_frame(
        counted, "popularity_aggregation", "complete", topics.base, availableNow=True
    ).awaitTermination()
    return topics.result(spark, "popularity_aggregation")


def _stream_labels_large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = _Topics(spark, sf_dir, "stream-labels")
    topics.publish("review")
    reviews = parse_records(topics.subscribe("review"), "review")
    labelled = label_sentiment(reviews, large_lexicon(topics.spark))
    streams.start_frame(
        labelled.select("review_id", "sentiment"), "labels", "append", topics.base, availableNow=True
    ).awaitTermination()
    return spark.read.parquet(table_path(streams.results_root(topics.base), "labels"))


def _in_event_order(topics: _Topics, start: Callable[..., object]) -> None:
    """Runs a query over the reviews, a part of the event times at a time."""
    reviews = with_event_time(topics.read("review"))
    day = F.datediff(F.to_date("event_time"), F.lit("2018-01-01").cast("date"))
    part = F.floor(F.coalesce(day, F.lit(0)) * BATCHES / 730)
    for number in range(BATCHES):
        topics.publish_batch("review", reviews.where(part == number).drop("event_time"))
        start(topics.subscribe, topics.base, availableNow=True).awaitTermination()


def _stream_review_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All closed days; the newest day stays open."""
    topics = _Topics(spark, sf_dir, "stream-daily")
    _in_event_order(topics, partial(streams.start_daily_reviews, lexicon=LEXICON))
    return topics.result(spark, "daily_reviews")


def _stream_review_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reviews once more, after their days were closed."""
    topics = _Topics(spark, sf_dir, "stream-late")
    start = partial(streams.start_daily_reviews, lexicon=LEXICON)
    _in_event_order(topics, start)
    topics.publish_batch("review", topics.read("review"))
    start(topics.subscribe, topics.base, availableNow=True).awaitTermination()
    late = topics.result(spark, "late_reviews").where("day IS NOT NULL")
    return late.select("review_id", "business_id", "day")


def _stream_daily_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed days, open days and late reviews of a stream out of order: each review once."""
    topics = _Topics(spark, sf_dir, "stream-complete")
    reviews = topics.read("review")
    # Files of very different sizes, event times in no order.
    number = F.pmod(F.xxhash64("review_id"), F.lit(16))
    part = F.when(number == 0, 0).when(number < 4, 1).when(number < 5, 2).when(number < 14, 3).otherwise(4)
    for own in range(5):
        topics.publish_batch("review", reviews.where(part == own))
        streams.start_daily_reviews(
            topics.subscribe, topics.base, LEXICON, availableNow=True
        ).awaitTermination()
    late = topics.result(spark, "late_reviews").groupBy("business_id").agg(
        F.count("review_id").alias("review_count"),
        labelled(POSITIVE).alias("positive_reviews"),
        labelled(NEGATIVE).alias("negative_reviews"),
    )
    days = topics.result(spark, "daily_reviews").unionByName(streams.open_days(spark, topics.base))
    parts = days.select(*late.columns).union(late)
    return parts.groupBy("business_id").agg(*[F.sum(c).alias(c) for c in late.columns[1:]])


def _stream_one_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of both review tables, read at one version between the batches of a stream.

    A row for each batch: whether the totals agree, and the reviews counted so far. Another
    batch of one of the tables is there already, as it is when a reader meets a running query.
    """
    topics = _Topics(spark, sf_dir, "stream-version")
    root = streams.results_root(topics.base)
    reviews = topics.read("review")
    rows = []
    for own in range(BATCHES):
        part = F.pmod(F.col("review_id").cast("bigint"), F.lit(BATCHES)) == own
        topics.publish_batch("review", reviews.where(part))
        streams.start_review_tables(
            topics.subscribe, topics.base, LEXICON, availableNow=True
        ).awaitTermination()
        ahead = topics.result(spark, "sentiment_aggregation").withColumn("review_count", F.lit(-1).cast("bigint"))
        write_batch(ahead, 1000, table_path(root, "sentiment_aggregation"))
        versions = read_versions(spark, root)
        totals = [
            read_result(spark, root, table, versions[table]).agg(
                F.sum("review_count").alias(f"{i}_reviews"), F.sum("positive_reviews").alias(f"{i}_positive")
            )
            for i, table in enumerate(("sentiment_aggregation", "review_trend_aggregation"))
        ]
        delete_folder(spark, f"{table_path(root, 'sentiment_aggregation')}/batch_id=1000")
        rows.append(totals)
    found = None
    for own, (left, right) in enumerate(rows):
        each = left.withColumn("batch", F.lit(own)).join(right.withColumn("batch", F.lit(own)), "batch")
        found = each if found is None else found.unionByName(each)
    agree = (F.col("0_reviews") == F.col("1_reviews")) & (F.col("0_positive") == F.col("1_positive"))
    return found.select("batch", agree.alias("agree"), F.col("0_reviews").alias("review_count"))


def _stream_review_tables(name: str) -> Query:
    """One of the two tables that share a streaming query."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        topics = _Topics(spark, sf_dir, "stream-review-tables")
        topics.publish("review")
        streams.start_review_tables(
            topics.subscribe, topics.base, LEXICON, availableNow=True
        ).awaitTermination()
        return topics.result(spark, name)

    return run


def _stream_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = _Topics(spark, sf_dir, "stream-predictions")
    topics.publish("review")
    streams.start_predictions(
        topics.subscribe, topics.base, trigger={"availableNow": True}
    ).awaitTermination()
    return topics.result(spark, "predictions")


def _stream_predictions_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(_stream_predictions(spark, sf_dir))


def _refresh(chart: str) -> Query:
    """A chart over the table that the streaming queries keep."""
    table = CHARTS[chart][0]
    group = next((g for g in streams.SHARED if table in g), (table,))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        topics = _Topics(spark, sf_dir, f"refresh-{chart}")
        topics.publish(RESULT_TABLES[table].record_type)
        started = streams.start_all(
            topics.subscribe, topics.base, LEXICON, tables=group, predictions=False, availableNow=True
        )
        streams.await_all(topics.spark, started)
        root = streams.results_root(topics.base)
        shown = refresh(spark, root, read_fixture(spark, sf_dir, "business"))[chart]
        return shown.withColumn("share", F.round("share", 6)) if chart == "category_pie" else shown

    return run


def queries() -> dict[str, Query]:
    return {
        **{name: _table(name) for name in RESULT_TABLES},
        "review_labels": _labels("review", ["review_id"]),
        "review_labels_by_join": _review_labels_by_join,
        "review_labels_unicode": _labels("review", ["review_id"], lambda spark: UNICODE_LEXICON),
        "review_labels_negation": _review_labels_negation,
        "review_labels_phrases": _review_labels_phrases,
        "review_labels_large_lexicon": _labels("review", ["review_id"], large_lexicon),
        "review_polarity": _review_polarity,
        "tip_labels": _labels("tip", ["business_id", "compliment_count"]),
        "review_date_parts": _review_date_parts,
        "business_lookup": _business_lookup,
        "business_lookup_last": _business_lookup_last,
        "json_roundtrip": _json_roundtrip,
        "json_roundtrip_ids": _json_roundtrip_ids,
        "limited_export": _limited_export,
        **{name: _chart(name) for name in CHARTS},
        "category_pie": _category_pie,
        "review_trend_series_many": _review_trend_series_many,
        **{f"dedup_{name}": _dedup(name) for name in DEDUPED},
        "user_index": _index("user_id", "user_index"),
        "business_index": _index("business_id", "business_index"),
        "predictions": _predictions,
        "predictions_coverage": _predictions_coverage,
        "predictions_quality": _predictions_quality,
        "predictions_ranked": _predictions_ranked,
        "predictions_fold_in": _predictions_fold_in,
        "stream_predictions_fold_in": _stream_predictions_fold_in,
        **{f"built_{name}": _built(name) for name in BUILT},
        **{f"stream_{name}": _stream_table(name) for name in STREAMED},
        "stream_shared_sentiment": _stream_review_tables("sentiment_aggregation"),
        "stream_shared_trend": _stream_review_tables("review_trend_aggregation"),
        "stream_dedup_reviews": _stream_dedup_reviews,
        "stream_dedup_long": _stream_dedup_long,
        "stream_user_index": _stream_user_index,
        "stream_business_lookup": _stream_business_lookup,
        "stream_dedup_malformed": _stream_dedup_malformed,
        "stream_labels_large_lexicon": _stream_labels_large_lexicon,
        "stream_review_daily": _stream_review_daily,
        "stream_review_late": _stream_review_late,
        "stream_daily_complete": _stream_daily_complete,
        "stream_one_version": _stream_one_version,
        "stream_predictions": _stream_predictions,
        "stream_predictions_coverage": _stream_predictions_coverage,
        **{f"refresh_{name}": _refresh(name) for name in REFRESHED},
    }
