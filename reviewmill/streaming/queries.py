"""The streaming queries that keep the result tables and the predictions.

All files of a deployment live below one base folder on shared storage:
``results/<table>`` and ``checkpoints/<query>``. They belong together: a query
that starts again on its checkpoint goes on with its batch numbers, so give a
fresh checkpoint a fresh base folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewmill.functions.columns import with_event_time, with_ingest_time
from reviewmill.functions.text import label_sentiment
from reviewmill.operators.factors import RANK, REGULARISATION, solve_factors, spread_sums
from reviewmill.operators.recommend import dense_indexes, fit_score, index_of, usable_ratings
from reviewmill.plans.build import (
    categories_from_rollup,
    category_rollup,
    daily_from_rollup,
    daily_rollup,
    review_levels,
    sentiment_from_rollup,
    trend_from_rollup,
)
from reviewmill.plans.tables import (
    RESULT_TABLES,
    WATERMARK,
    Lexicon,
    prepare_records,
    result_table,
)
from reviewmill.schemas import RESULT_KEYS
from reviewmill.session import materialize, scratch_path
from reviewmill.sources.results import (
    commit_version,
    complete_batches,
    merge_spans,
    table_path,
    write_batch,
    write_snapshot,
)
from reviewmill.sources.storage import delete_folder, matching
from reviewmill.sources.topics import parse_records

# record type -> streaming frame with a ``value`` column
Subscribe = Callable[[str], DataFrame]


def results_root(base: str) -> str:
    return f"{base.rstrip('/')}/results"


def _checkpoint(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/checkpoints/{name}"


@contextmanager
def _scratch(spark: SparkSession, label: str):
    """A scratch folder that goes with the batch, whether it succeeds or not."""
    folder = scratch_path(spark, label)
    try:
        yield folder
    finally:
        delete_folder(spark, folder)


def start_frame(frame: DataFrame, name: str, mode: str, base: str, **trigger) -> StreamingQuery:
    """Keep the result table ``name`` from a streaming frame with its columns."""
    return _start(frame, name, mode, base, trigger)


def _start(frame: DataFrame, name: str, mode: str, base: str, trigger: dict) -> StreamingQuery:
    path = table_path(results_root(base), name)
    # A keyed table gets the rows that a batch has changed, not its whole state.
    changes = mode == "complete" and name in RESULT_KEYS
    writer = (
        frame.writeStream.queryName(name)
        .outputMode("update" if changes else mode)
        .option("checkpointLocation", _checkpoint(base, name))
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if mode == "append":
        # Spark's file sink logs each batch, so a replay adds nothing twice.
        return writer.format("parquet").option("path", path).start()

    def write(batch: DataFrame, batch_id: int) -> None:
        if not changes:
            write_snapshot(batch, batch_id, path)
            return
        write_batch(batch, batch_id, path)
        merge_spans(batch.sparkSession, path, name, batch_id)

    return writer.foreachBatch(write).start()


def start_table(
    name: str,
    subscribe: Subscribe,
    base: str,
    lexicon: Lexicon | None = None,
    scorer: Callable[[str], float] | None = None,
    drop_malformed: bool = False,
    **trigger,
) -> StreamingQuery:
    """Keep one result table from its topic. ``trigger`` goes to the writer."""
    table = RESULT_TABLES[name]
    records = parse_records(
        subscribe(table.record_type), table.record_type, drop_malformed
    )
    frame = result_table(name, records, lexicon, scorer)
    return _start(frame, name, table.mode, base, trigger)


def start_predictions(
    subscribe: Subscribe,
    base: str,
    accumulate: bool = False,
    record_type: str = "review",
    **options,
) -> StreamingQuery:
    """Train on each micro-batch of reviews and predict its ratings.

    With ``accumulate`` the ratings of all batches are kept, and each batch is
    predicted by a model trained on them: give the query a trigger as long as
    a training may take. ``trigger`` among the options goes to the writer, the
    rest to ``fit_score``.
    """
    trigger = options.pop("trigger", {})
    predictions = table_path(results_root(base), "predictions")
    history = f"{base.rstrip('/')}/history/ratings"

    def predict(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with _scratch(spark, "predictions") as folder:
            ratings, fresh = batch, None
            if accumulate:
                write_batch(ratings, batch_id, history)
                reader = spark.read.schema(ratings.schema)
                fresh = reader.parquet(f"{history}/batch_id={batch_id}")
                kept = [b for b in complete_batches(spark, history) if b <= batch_id]
                ratings = reader.parquet(*[f"{history}/batch_id={b}" for b in kept])
            else:
                ratings = materialize(ratings, "ratings", folder)
            scored = fit_score(ratings, fresh, folder=folder, **options)
            write_batch(scored, batch_id, predictions)
        merge_spans(spark, predictions, "predictions", batch_id)

    columns = ["user_id", "business_id", "stars"]
    records = parse_records(subscribe(record_type), record_type, columns=columns)
    ratings_only = usable_ratings(records)
    writer = (
        ratings_only.writeStream.queryName("predictions")
        .foreachBatch(predict)
        .option("checkpointLocation", _checkpoint(base, "predictions"))
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_user_factors(
    subscribe: Subscribe,
    base: str,
    factors_path: str,
    rank: int = RANK,
    regularisation: float = REGULARISATION,
    record_type: str = "review",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the factors of all users against the business factors stored at ``factors_path``.

    The state holds the sums of each user's ratings, of all batches so far. A batch adds
    its own and solves for the users it touches, so predictions learn from the whole
    history without keeping it and without fitting again. Ratings of businesses that have no
    factors yet count for nothing; fit those now and then, and start afresh on them.
    """
    path = table_path(results_root(base), "user_factors")
    records = parse_records(subscribe(record_type), record_type, columns=["user_id", "business_id", "stars"])
    ratings = usable_ratings(records)
    factors = ratings.sparkSession.read.parquet(factors_path).select("business_id", "features")
    sums = spread_sums(ratings.join(factors, "business_id"), "user_id", rank)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(solve_factors(batch, "user_id", rank, regularisation), batch_id, path)
        merge_spans(batch.sparkSession, path, "user_factors", batch_id)

    writer = (
        sums.writeStream.queryName("user_factors")
        .outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", _checkpoint(base, "user_factors"))
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_business_names(subscribe: Subscribe, base: str, **trigger) -> StreamingQuery:
    """Keep the last name of each business: that of its newest batch, the greatest of equals.

    The state holds one name a business; a batch emits the names of the businesses it brings.
    ``refresh`` reads this table instead of reducing all business records.
    """
    records = parse_records(subscribe("business"), "business", columns=["business_id", "name"])
    last = F.max_by("name", F.struct("ingest_time", "name")).alias("name")
    named = with_ingest_time(records.dropna()).groupBy("business_id").agg(last)
    return _start(named, "business_names", "complete", base, trigger)


def start_index(
    key: str, subscribe: Subscribe, base: str, record_type: str = "review", **trigger
) -> StreamingQuery:
    """Number the ids of a column as they come, from 0; a number once given stays.

    ``key`` is user_id or business_id; the table is user_index or business_index. The
    state holds the ids seen so far and passes each once, so the table is never read. New
    ids of a batch are numbered in their own order after all earlier ones; one row per
    batch says how many there are, so a replayed batch numbers alike.
    """
    name = key.replace("_id", "_index")
    path = table_path(results_root(base), name)
    marks = f"{base.rstrip('/')}/history/{name}"
    records = parse_records(subscribe(record_type), record_type, columns=[key])
    fresh = records.select(key).dropna().dropDuplicates([key])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [b for b in complete_batches(spark, marks) if b < batch_id]
        given = spark.read.parquet(f"{marks}/batch_id={before[-1]}").first()[0] if before else 0
        with _scratch(spark, name) as folder:
            numbers = index_of(dense_indexes(batch, [key], folder), key, name)
            numbered = numbers.select(key, (F.col(name) + F.lit(given).cast("bigint")).alias(name))
            write_batch(numbered, batch_id, path)
        count = given + spark.read.parquet(f"{path}/batch_id={batch_id}").count()
        merge_spans(spark, path, name, batch_id)
        write_snapshot(spark.createDataFrame([(count,)], "given bigint").coalesce(1), batch_id, marks)

    writer = (
        fresh.writeStream.queryName(name)
        .outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", _checkpoint(base, name))
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_daily_reviews(
    subscribe: Subscribe,
    base: str,
    lexicon: Lexicon | None = None,
    scorer: Callable[[str], float] | None = None,
    delay: str = WATERMARK,
    **trigger,
) -> StreamingQuery:
    """Reviews per business and day, each day written once it is complete, and the late ones.

    A day is closed when the newest event time of all batches so far is ``delay``
    behind its end. Each review goes to one place: into the sums of its day while that
    is open, or else, as it is, into ``late_reviews``; so do reviews without an event
    time, whose day is null. ``open_days`` reads the days that are still open.

    A batch adds its own sums to the open days, in folders by day, and reads those of
    the days it closes; sums of closed days go with a later batch. What it costs follows
    the batch and the days it closes, not the age of the stream. One row
    per batch says which day is the first open one, so a replayed batch decides alike.
    """
    root = results_root(base)
    held, marks = _daily_folders(base)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with _scratch(spark, "daily") as folder:
            slim = batch.select(
                "review_id", "business_id", "event_time", F.to_date("event_time").alias("day"), "stars", "sentiment"
            )
            reviews = materialize(slim, "reviews", folder)
            first_open = _first_open_day(spark, marks, batch_id)
            late = F.col("day").isNull() | F.coalesce(F.col("day") < F.lit(first_open), F.lit(False))
            write_batch(reviews.where(late), batch_id, table_path(root, "late_reviews"))
            sums = daily_rollup(reviews.where(~late))
            sums.write.mode("overwrite").partitionBy("day").parquet(f"{held}/batch_id={batch_id}")

            passed = F.to_date(F.max("event_time") - F.expr(f"INTERVAL '{delay}'"))
            here = reviews.where("day IS NOT NULL").agg(passed.alias("first_open"))
            here = here.select(F.greatest("first_open", F.lit(first_open).cast("date")).alias("first_open"))
            now_open = here.first()[0]
            closing = _days_between(spark, held, first_open, now_open, batch_id)
            closed = daily_from_rollup(_read_sums(spark, closing))
            write_batch(closed, batch_id, table_path(root, "daily_reviews"))
            for path in _days_between(spark, held, None, first_open, batch_id):
                # Closed by an earlier batch, which is not run again.
                delete_folder(spark, path)
        for table in ("daily_reviews", "late_reviews"):
            merge_spans(spark, table_path(root, table), table, batch_id)
        commit_version(spark, root, "daily_reviews", batch_id, ["daily_reviews", "late_reviews"])
        write_snapshot(spark.createDataFrame([(now_open,)], "first_open date").coalesce(1), batch_id, marks)

    records = with_event_time(parse_records(subscribe("review"), "review"))
    writer = (
        label_sentiment(records, lexicon, scorer)
        .writeStream.queryName("daily_reviews")
        .foreachBatch(write)
        .option("checkpointLocation", _checkpoint(base, "daily_reviews"))
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def _daily_folders(base: str) -> tuple[str, str]:
    """Where the sums of open days are, and the first open day after each batch."""
    return f"{base.rstrip('/')}/open_days", f"{base.rstrip('/')}/history/first_open_day"


def _first_open_day(spark: SparkSession, marks: str, batch_id: int) -> date | None:
    """What was open when the batch began; null before any event time."""
    before = [b for b in complete_batches(spark, marks) if b < batch_id]
    return spark.read.parquet(f"{marks}/batch_id={before[-1]}").first()[0] if before else None


def _days_between(
    spark: SparkSession, held: str, first: date | None, end: date | None, batch_id: int
) -> list[str]:
    """Folders of sums by batches up to this one for days from ``first`` to before ``end``."""
    found = []
    for path in matching(spark, f"{held}/batch_id=*/day=*"):
        number, day = (part.split("=")[1] for part in path.split("/")[-2:])
        low = first is None or day >= first.isoformat()
        if int(number) <= batch_id and low and end is not None and day < end.isoformat():
            found.append(path)
    return sorted(found)


_SUMS = (
    "business_id string, stars_sum double, stars_count bigint, review_count bigint, "
    "positive_reviews bigint, negative_reviews bigint"
)


def _read_sums(spark: SparkSession, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], f"day date, {_SUMS}")
    frame = spark.read.schema(_SUMS).parquet(*folders)
    day = F.regexp_extract(F.input_file_name(), r"day=([0-9-]+)/[^/]*$", 1)
    return frame.withColumn("day", day.cast("date"))


def open_days(spark: SparkSession, base: str) -> DataFrame:
    """The sums so far of the days that ``start_daily_reviews`` has not closed."""
    held, marks = _daily_folders(base)
    done = complete_batches(spark, marks)
    if not done:
        return daily_from_rollup(_read_sums(spark, []))
    first_open = _first_open_day(spark, marks, done[-1] + 1)
    folders = _days_between(spark, held, first_open, date.max, done[-1])
    return daily_from_rollup(_read_sums(spark, folders))


IDENTITY = "_identity"


def drop_redelivered(records: DataFrame, key: str, within: str | None = "1 hour") -> DataFrame:
    """Drop records that arrive again within the given time of arrival, or ever if it is None.

    The clock is the arrival time, not the event time: copies arrive close to
    each other, while event times may be years apart and out of order. Records
    without a key, malformed ones too, are told apart by their bytes, which
    ``parse_records`` has put into the IDENTITY column.

    Without a limit every key stays in the state. The state lies on disk (RocksDB), a batch
    looks up its own keys only and checkpoints what it adds, so the cost of a batch does
    not follow the number of keys; the disk of an executor does.
    """
    identity = F.when(F.col(key).isNull(), F.col(IDENTITY))
    if within is None:
        marked = records.withColumn(IDENTITY, identity)
        return marked.dropDuplicates([key, IDENTITY]).drop(IDENTITY)
    return (
        with_ingest_time(records, within)
        .withColumn(IDENTITY, identity)
        .dropDuplicatesWithinWatermark([key, IDENTITY])
        .drop(IDENTITY, "ingest_time")
    )


def start_deduplicated_table(
    name: str,
    key: str,
    subscribe: Subscribe,
    base: str,
    lexicon: Lexicon | None = None,
    scorer: Callable[[str], float] | None = None,
    within: str | None = "1 hour",
    drop_malformed: bool = False,
    **trigger,
) -> StreamingQuery:
    """``start_table`` for topics that deliver a record more than once.

    ``within=None`` is for a producer that repeats its records for ever.

    The arrival-time watermark takes the place of the event-time one: Spark
    allows one watermark per query. Texts are labelled before the copies are
    dropped, so that the shuffle by key carries labels and no texts.
    """
    table = RESULT_TABLES[name]
    records = parse_records(
        subscribe(table.record_type), table.record_type, drop_malformed, IDENTITY
    )
    prepared = prepare_records(
        records, table.record_type, lexicon, scorer, watermark=None
    )
    frame = table.build(drop_redelivered(prepared, key, within))
    return _start(frame, name, table.mode, base, trigger)


def start_review_tables(
    subscribe: Subscribe,
    base: str,
    lexicon: Lexicon | None = None,
    scorer: Callable[[str], float] | None = None,
    drop_malformed: bool = False,
    **trigger,
) -> StreamingQuery:
    """Keep both review tables from one query, and one version of both.

    Reads and scores every review once instead of once per table. The state holds
    the sums of each month and of each business; a batch emits those it has changed
    and reads nothing of earlier batches, so its cost does not grow with the stream's age.
    """
    records = parse_records(subscribe("review"), "review", drop_malformed)
    levels = review_levels(prepare_records(records, "review", lexicon, scorer))

    def tables(changed: DataFrame) -> dict[str, DataFrame]:
        return {
            "review_trend_aggregation": trend_from_rollup(changed.where("NOT total")),
            "sentiment_aggregation": sentiment_from_rollup(changed.where("total")),
        }

    return _start_group("review_tables", levels, "update", tables, base, trigger)


def _start_group(
    name: str,
    frame: DataFrame,
    mode: str,
    tables: Callable[[DataFrame], dict[str, DataFrame]],
    base: str,
    trigger: dict,
) -> StreamingQuery:
    """A query that writes several tables from each batch, then one version of them all."""
    root = results_root(base)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with _scratch(spark, name) as folder:
            found = tables(materialize(batch, "batch", folder))
            for table, rows in found.items():
                path = table_path(root, table)
                if table in RESULT_KEYS:
                    write_batch(rows, batch_id, path)
                    merge_spans(spark, path, table, batch_id)
                else:
                    write_snapshot(rows, batch_id, path)
        commit_version(spark, root, name, batch_id, found)

    writer = (
        frame.writeStream.queryName(name)
        .outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", _checkpoint(base, name))
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_category_tables(
    subscribe: Subscribe, base: str, drop_malformed: bool = False, **trigger
) -> StreamingQuery:
    """Keep both category tables from one query that splits every list once."""
    records = parse_records(subscribe("business"), "business", drop_malformed)
    rollup = category_rollup(prepare_records(records, "business"))
    return _start_group("category_tables", rollup, "complete", categories_from_rollup, base, trigger)


# Tables that one query can keep together, and how.
SHARED = {
    ("sentiment_aggregation", "review_trend_aggregation"): (
        lambda subscribe, base, lexicon, scorer, trigger: start_review_tables(
            subscribe, base, lexicon, scorer, **trigger
        )
    ),
    ("category_distribution", "top_rated_categories"): (
        lambda subscribe, base, lexicon, scorer, trigger: start_category_tables(
            subscribe, base, **trigger
        )
    ),
}


def start_all(
    subscribe: Subscribe,
    base: str,
    lexicon: Lexicon | None = None,
    scorer: Callable[[str], float] | None = None,
    tables: Iterable[str] = tuple(RESULT_TABLES),
    predictions: bool = True,
    share: bool = True,
    **trigger,
) -> list[StreamingQuery]:
    """Start the result tables and the predictions, each query on its own checkpoint.

    With ``share`` the two review tables come from one query, and so do the two
    category tables. Decide before the first start: the ways have different checkpoints.
    """
    alone, queries = list(tables), []
    for group, start in SHARED.items():
        if share and set(group) <= set(alone):
            alone = [name for name in alone if name not in group]
            queries.append(start(subscribe, base, lexicon, scorer, trigger))
    queries += [start_table(name, subscribe, base, lexicon, scorer, **trigger) for name in alone]
    if predictions:
        queries.append(start_predictions(subscribe, base, trigger=trigger))
    return queries


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until all queries have ended; the first failure stops the others."""
    try:
        while any(q.isActive for q in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for query in queries:
            query.awaitTermination()
    except Exception:
        for query in queries:
            query.stop()
        raise
