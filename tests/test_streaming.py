import json
import os

import pytest
from pyspark.sql import functions as F

from reviewmill.operators.factors import fold_in
from reviewmill.plans.charts import users_top
from reviewmill.plans.refresh import CHARTS, refresh
from reviewmill.plans.tables import RESULT_TABLES, result_table
from reviewmill.schemas import RECORDS, RESULTS
from reviewmill.session import scratch_root, stream_session
from reviewmill.sources import results as R
from reviewmill.plans.fixtures import LEXICON, read_fixture
from reviewmill.sources.topics import publish_to_files, subscribe_to_files
from reviewmill.streaming import queries as S

LEX = {"good": 1.0, "bad": -1.0}
NOW = {"availableNow": True}


class Topics:
    """Topics in a folder, and the queries over them."""

    def __init__(self, spark, base):
        self.spark = stream_session(spark, 3)
        self.base = str(base)

    def publish(self, record_type, frame):
        publish_to_files(frame, self.base, "t", record_type)

    def reviews(self, *values):
        frame = self.spark.createDataFrame(list(values), RECORDS["review"])
        self.publish("review", frame.coalesce(1))

    def subscribe(self, record_type):
        return subscribe_to_files(self.spark, self.base, "t", record_type, maxFilesPerTrigger="1")

    def run(self, name, lexicon=LEX, **options):
        query = S.start_table(name, self.subscribe, self.base, lexicon, **options, **NOW)
        query.awaitTermination()
        return query

    def result(self, name):
        return R.read_result(self.spark, S.results_root(self.base), name)

    def batches(self, name):
        return R.complete_batches(self.spark, R.table_path(S.results_root(self.base), name))


@pytest.fixture
def topics(spark, tmp_path):
    return Topics(spark, tmp_path)


@pytest.mark.parametrize("name", sorted(RESULT_TABLES))
def test_many_micro_batches_equal_batch(spark, sf_dir, rows, topics, name):
    record_type = RESULT_TABLES[name].record_type
    records = read_fixture(spark, sf_dir, record_type)
    topics.publish(record_type, records.repartition(2))
    query = topics.run(name, LEXICON)
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == 2
    assert rows(topics.result(name)) == rows(result_table(name, records, LEXICON))


def review(number, business, day, text="good"):
    return (f"r{number}", business, "u", 3.0, text, f"{day} 12:00:00")


def test_restart_goes_on_where_it_stopped(rows, topics):
    topics.reviews(review(1, "a", "2018-01-01"), review(2, "b", "2018-01-01", "bad"))
    topics.run("sentiment_aggregation")
    topics.run("sentiment_aggregation")  # nothing new
    assert rows(topics.result("sentiment_aggregation")) == [("a", 3.0, 1, 1, 0), ("b", 3.0, 1, 0, 1)]
    topics.reviews(review(3, "a", "2018-02-01"))
    topics.run("sentiment_aggregation")
    assert rows(topics.result("sentiment_aggregation")) == [("a", 3.0, 2, 2, 0), ("b", 3.0, 1, 0, 1)]


def test_replayed_batch_changes_nothing(rows, topics):
    for number in range(3):
        topics.reviews(review(number, "a", "2018-01-01"))
    topics.run("sentiment_aggregation")
    commits = os.path.join(topics.base, "checkpoints/sentiment_aggregation/commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        path = os.path.join(commits, name)
        if os.path.exists(path):
            os.remove(path)  # as if the driver died between the write and the commit
    topics.run("sentiment_aggregation")
    assert rows(topics.result("sentiment_aggregation")) == [("a", 3.0, 3, 3, 0)]


def test_a_batch_writes_only_the_keys_it_changes(rows, topics):
    for number, business in enumerate(["a", "b", "c", "a"]):
        topics.reviews(review(number, business, "2018-01-01"))
        topics.run("sentiment_aggregation")
    path = R.table_path(S.results_root(topics.base), "sentiment_aggregation")
    last = topics.spark.read.parquet(f"{path}/batch_id={topics.batches('sentiment_aggregation')[-1]}")
    assert rows(last, "business_id", "review_count") == [("a", 2)]
    assert rows(topics.result("sentiment_aggregation"), "business_id", "review_count") == [
        ("a", 2), ("b", 1), ("c", 1),
    ]


def test_compaction_keeps_the_state_and_the_readers(rows, topics):
    name, root = "sentiment_aggregation", S.results_root(topics.base)
    for number, business in enumerate(["a", "b", "a"]):
        topics.reviews(review(number, business, "2018-01-01"))
        topics.run(name)
    before = topics.result(name)
    R.compact_result(topics.spark, root, name)
    assert rows(before) == rows(topics.result(name))  # old folders are still there
    topics.reviews(review(9, "c", "2018-01-01"))
    topics.run(name)
    assert rows(topics.result(name), "business_id", "review_count") == [("a", 2), ("b", 1), ("c", 1)]
    R.compact_result(topics.spark, root, name, retention=0)
    assert topics.batches(name) == []
    assert rows(topics.result(name), "business_id", "review_count") == [("a", 2), ("b", 1), ("c", 1)]


def test_a_snapshot_can_be_read_after_later_ones(rows, topics):
    path = R.table_path(S.results_root(topics.base), "category_distribution")
    frame = topics.spark.createDataFrame([("a", 1)], "category string, count bigint")
    R.write_snapshot(frame, 0, path)
    reading = topics.result("category_distribution")
    for batch in range(1, 4):
        R.write_snapshot(frame.withColumn("count", F.lit(batch + 1).cast("bigint")), batch, path)
    assert rows(reading) == [("a", 1)]
    assert rows(topics.result("category_distribution")) == [("a", 4)]
    R.write_snapshot(frame, 4, path, retention=0)
    assert topics.batches("category_distribution") == [4]


def test_half_written_snapshot_is_not_read(rows, topics):
    topics.reviews(review(1, "a", "2018-01-01"))
    topics.run("sentiment_aggregation")
    path = R.table_path(S.results_root(topics.base), "sentiment_aggregation")
    broken = f"{path}/batch_id=99"
    topics.result("sentiment_aggregation").write.parquet(broken)
    os.remove(f"{broken}/_SUCCESS")
    assert rows(topics.result("sentiment_aggregation")) == [("a", 3.0, 1, 1, 0)]
    assert 99 not in topics.batches("sentiment_aggregation")


def test_malformed_records_are_kept_or_dropped(rows, spark, tmp_path):
    for option, expected in ((False, [("a", 1), (None, 2)]), (True, [("a", 1)])):
        topics = Topics(spark, tmp_path / str(option))
        folder = os.path.join(topics.base, "t-checkin")
        os.makedirs(folder)
        with open(f"{folder}/part.txt", "w") as file:
            file.write(json.dumps({"business_id": "a"}) + "\nno json\n{}\n")
        topics.run("popularity_aggregation", drop_malformed=option)
        assert rows(topics.result("popularity_aggregation")) == expected


def test_empty_snapshot(spark, rows, topics):
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in
               spark.createDataFrame([], RECORDS["business"]).schema]
    topics.publish("business", spark.range(2).select(*columns))
    topics.run("category_distribution")
    assert rows(topics.result("category_distribution")) == []
    assert topics.batches("category_distribution")


def test_late_record_still_counts_without_a_window(rows, topics):
    for number, day in enumerate(["2018-01-01", "2018-06-01", "2018-01-02"]):
        topics.reviews(review(number, "a", day))
        topics.run("sentiment_aggregation")
    assert rows(topics.result("sentiment_aggregation")) == [("a", 3.0, 3, 3, 0)]


def test_late_record_is_dropped_from_closed_days(rows, topics):
    days = ["2018-01-01", "2018-06-01", "2018-01-01", "2018-06-01", "2019-01-01"]
    for number, day in enumerate(days):
        topics.reviews(review(number, "a", day))
        S.start_daily_reviews(topics.subscribe, topics.base, LEX, **NOW).awaitTermination()
    got = topics.result("daily_reviews").selectExpr("cast(day as string)", "review_count")
    assert rows(got) == [("2018-01-01", 1), ("2018-06-01", 2)]
    late = topics.result("late_reviews").selectExpr("review_id", "cast(day as string)", "sentiment")
    assert rows(late) == [("r2", "2018-01-01", "Positive")]
    still = S.open_days(topics.spark, topics.base).selectExpr("cast(day as string)", "review_count")
    assert rows(still) == [("2019-01-01", 1)]


def _everywhere(topics):
    """Ids or counts of the reviews in closed days, open days and the late table."""
    days = topics.result("daily_reviews").unionByName(S.open_days(topics.spark, topics.base))
    return (
        sum(r.review_count for r in days.collect()),
        sorted(r.review_id for r in topics.result("late_reviews").collect()),
    )


@pytest.mark.parametrize("files", [1, 9])
def test_each_review_is_in_one_place(topics, files):
    """Days out of order, in batches of one file or all at once, and one without a date."""
    days = [10, 1, 20, 21, 11, 12, 1, 20, 22]
    for number, day in enumerate(days):
        topics.reviews(review(number, "a", f"2018-01-{day:02}"))
    topics.reviews(("r99", "a", "u", 3.0, "good", "bad-date"))
    subscribe = lambda kind: subscribe_to_files(
        topics.spark, topics.base, "t", kind, maxFilesPerTrigger=str(files)
    )
    S.start_daily_reviews(subscribe, topics.base, LEX, **NOW).awaitTermination()
    counted, late = _everywhere(topics)
    assert counted + len(late) == 10
    assert "r99" in late
    # Files of one second come in no order, so which reviews are late is not fixed; none is in both.
    assert counted == 10 - len(set(late))


def test_replayed_daily_batch_changes_nothing(rows, topics):
    for number, day in enumerate([10, 20, 1, 21]):
        topics.reviews(review(number, "a", f"2018-01-{day:02}"))
        S.start_daily_reviews(topics.subscribe, topics.base, LEX, **NOW).awaitTermination()
    before = rows(topics.result("daily_reviews")), _everywhere(topics)
    commits = os.path.join(topics.base, "checkpoints/daily_reviews/commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    S.start_daily_reviews(topics.subscribe, topics.base, LEX, **NOW).awaitTermination()
    assert (rows(topics.result("daily_reviews")), _everywhere(topics)) == before


def test_batches_cost_what_they_change(rows, topics, monkeypatch):
    """What a batch reads does not grow with the stream: later ones read as many folders as early ones."""
    monkeypatch.setattr(R, "FAN_IN", 4)
    read = []
    real = R._state

    def counting(spark, path, table, folders):
        read.append(len(folders))
        return real(spark, path, table, folders)

    monkeypatch.setattr(R, "_state", counting)
    per_batch = []
    for number in range(18):
        topics.reviews(review(number, f"b{number % 3}", f"2018-{number % 12 + 1:02}-01"))
        read.clear()
        S.start_review_tables(topics.subscribe, topics.base, LEX, **NOW).awaitTermination()
        per_batch.append(sum(read))
    numbers = topics.batches("sentiment_aggregation")
    assert len(numbers) >= 18
    # Only batches that end a group read, and never more than FAN_IN folders a table and size.
    assert per_batch.count(0) >= 8 and max(per_batch) <= 2 * 4 * 2
    live = R.live_folders(topics.spark, R.table_path(S.results_root(topics.base), "sentiment_aggregation"))
    assert len(live) <= 6
    assert rows(topics.result("sentiment_aggregation"), "business_id", "review_count") == [
        ("b0", 6), ("b1", 6), ("b2", 6),
    ]
    trend = topics.result("review_trend_aggregation")
    assert trend.agg(F.sum("review_count")).first()[0] == 18


def test_merged_folders_replace_their_parts(rows, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "FAN_IN", 2)
    name, root = "popularity_aggregation", str(tmp_path)
    path = R.table_path(root, name)
    for batch in range(7):
        frame = spark.createDataFrame([(f"k{batch % 3}", batch + 1)], "business_id string, count bigint")
        R.write_batch(frame, batch, path)
        R.merge_spans(spark, path, name, batch, retention=0 if batch == 5 else 3600)
        R.commit_version(spark, root, "one", batch, [name])
    assert R.live_folders(spark, path) == ["span_id=0_3", "span_id=4_5", "batch_id=6"]
    assert R.complete_batches(spark, path) == [6]
    expected = [("k0", 7), ("k1", 5), ("k2", 6)]
    assert rows(R.read_result(spark, root, name)) == expected
    assert rows(R.read_result(spark, root, name, R.read_versions(spark, root)[name])) == expected
    R.compact_result(spark, root, name, retention=0)
    assert R.live_folders(spark, path) == ["base_id=6"] and rows(R.read_result(spark, root, name)) == expected


def test_charts_take_the_last_names(rows, topics):
    topics.reviews(review(1, "a", "2018-01-01"), review(2, "b", "2018-01-01", "bad"))
    topics.run("sentiment_aggregation")
    empty = topics.spark.createDataFrame([], RECORDS["business"])
    for names in ([("a", "old"), ("b", "B"), (None, "none")], [("a", "new"), ("a", "Anew"), ("b", None)]):
        made = topics.spark.createDataFrame(names, "business_id string, name string")
        topics.publish("business", empty.unionByName(made, allowMissingColumns=True).coalesce(1))
        S.start_business_names(topics.subscribe, topics.base, **NOW).awaitTermination()
    assert rows(topics.result("business_names")) == [("a", "new"), ("b", "B")]
    shown = refresh(topics.spark, S.results_root(topics.base))["sentiment_top_positive"]
    assert rows(shown, "business_id", "name")[0] == ("a", "new")


def test_ids_keep_their_numbers(rows, topics):
    def users(*names):
        topics.reviews(*[(f"r{n}", "b", n, 3.0, None, None) for n in names])
        S.start_index("user_id", topics.subscribe, topics.base, **NOW).awaitTermination()
        return rows(topics.result("user_index"))

    assert users("b", "c", "b") == [("b", 0), ("c", 1)]
    assert users("a", "c", None, "d") == [("a", 2), ("b", 0), ("c", 1), ("d", 3)]
    commits = os.path.join(topics.base, "checkpoints/user_index/commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    # A replayed batch numbers its ids as before, and new ones come after all others.
    assert users("0", "a") == [("0", 4), ("a", 2), ("b", 0), ("c", 1), ("d", 3)]


def test_copies_after_any_time_count_once(rows, topics):
    """No clock is asked, so copies of the first delivery are known after any number of batches."""
    first, other = review(1, "a", "2018-01-01"), review(2, "b", "2018-01-01")
    later = ("r3", "a", "u", 3.0, "bad", "2018-09-01 12:00:00")
    for values in ([first, other], [later], [first, first, later], [other]):
        topics.reviews(*values)
        query = S.start_deduplicated_table(
            "sentiment_aggregation", "review_id", topics.subscribe, topics.base, LEX, within=None, **NOW
        )
        query.awaitTermination()
    assert rows(topics.result("sentiment_aggregation")) == [("a", 3.0, 2, 1, 1), ("b", 3.0, 1, 1, 0)]
    # One state row for each record, whatever the number of copies.
    rows_kept = [s["numRowsTotal"] for s in query.lastProgress["stateOperators"] if "dedup" in s["operatorName"].lower()]
    assert rows_kept == [3]


def test_redelivered_records_count_once(rows, topics):
    first, second = review(1, "a", "2018-01-01"), review(2, "a", "2017-01-01", "bad")
    bad_date = ("r3", "a", "u", 3.0, "good", "bad-date")
    no_key = [(None, "a", "u", 3.0, "good", "x"), (None, "a", "u", 3.0, "bad", "y")]
    for values in ([first, second, bad_date], [second, bad_date, first, *no_key]):
        topics.reviews(*values)
        S.start_deduplicated_table(
            "sentiment_aggregation", "review_id", topics.subscribe, topics.base, LEX, **NOW
        ).awaitTermination()
    assert rows(topics.result("sentiment_aggregation")) == [("a", 3.0, 3, 3, 2)]


def test_malformed_records_are_no_copies_of_one_another(rows, topics):
    folder = os.path.join(topics.base, "t-checkin")
    os.makedirs(folder)
    with open(f"{folder}/part.txt", "w") as file:
        file.write("one\ntwo\nthree\ntwo\n" + json.dumps({"business_id": "a", "date": "x"}) + "\n")
    for option, expected in ((False, [("a", 1), (None, 3)]), (True, [("a", 1)])):
        topics.base = topics.base if not option else topics.base + "/other"
        if option:
            os.makedirs(topics.base)
            os.symlink(folder, os.path.join(topics.base, "t-checkin"))
        S.start_deduplicated_table(
            "popularity_aggregation", "business_id", topics.subscribe, topics.base,
            drop_malformed=option, **NOW,
        ).awaitTermination()
        assert rows(topics.result("popularity_aggregation")) == expected


def test_predictions_parse_no_texts(topics, capsys):
    topics.reviews(*ratings(3, 3, 0))
    query = S.start_predictions(topics.subscribe, topics.base, trigger=NOW, maxIter=1)
    query.awaitTermination()
    capsys.readouterr()
    query.explain(True)
    physical = capsys.readouterr().out.split("== Physical Plan ==")[1]
    assert "stars" in physical and "StructField(text" not in physical and "review_id" not in physical


def test_dedup_shuffles_no_texts(topics, capsys):
    topics.reviews(review(1, "a", "2018-01-01"))
    query = S.start_deduplicated_table(
        "sentiment_aggregation", "review_id", topics.subscribe, topics.base, LEX, **NOW
    )
    query.awaitTermination()
    capsys.readouterr()
    query.explain(True)
    physical = capsys.readouterr().out.split("== Physical Plan ==")[1]
    above_shuffle = physical.split("DeduplicateWithinWatermark")[1].split("EventTimeWatermark")[0]
    projected = above_shuffle.split("Project [")[1].split("CASE WHEN")[0]
    assert "review_id#" in projected and "text#" not in projected


def test_both_review_tables_from_one_query(spark, sf_dir, rows, topics):
    reviews = read_fixture(spark, sf_dir, "review")
    topics.publish("review", reviews.repartition(2))
    started = S.start_all(
        topics.subscribe, topics.base, LEXICON,
        tables=["sentiment_aggregation", "review_trend_aggregation"],
        predictions=False, **NOW,
    )
    assert [q.name for q in started] == ["review_tables"]
    S.await_all(topics.spark, started)
    for name in ("sentiment_aggregation", "review_trend_aggregation"):
        assert rows(topics.result(name)) == rows(result_table(name, reviews, LEXICON))


def test_scorer_on_a_stream(rows, topics):
    topics.reviews(review(1, "a", "2018-01-01", "xyz"))
    topics.run("sentiment_aggregation", None, scorer=lambda text: -float(len(text)))
    assert rows(topics.result("sentiment_aggregation")) == [("a", 3.0, 1, 0, 1)]


def ratings(users, businesses, shift):
    return [
        (f"r{u}-{b}", f"b{b}", f"u{u}", float(1 + (u + b + shift) % 5), None, None)
        for u in range(users)
        for b in range(businesses)
    ]


def test_user_factors_move_ratings_where_sums_would_be_larger(spark, topics):
    made = [(f"b{i}", [1.0 + i, 0.5]) for i in range(3)]
    path = f"{topics.base}/factors"
    spark.createDataFrame(made, "business_id string, features array<double>").write.parquet(path)
    topics.reviews(*ratings(20, 3, 0))
    query = S.start_user_factors(topics.subscribe, topics.base, path, rank=2, trigger=NOW)
    query.awaitTermination()
    # From the top: all sums of a user are made after the one exchange by users.
    plan = query._jsq.explainInternal(False)
    exchange = plan.index("Exchange hashpartitioning(user_id")
    assert plan.rindex("partial_sum") < exchange < plan.index("MapInArrow")
    assert topics.result("user_factors").count() == 20


def test_user_factors_learn_from_every_batch(spark, topics):
    """Two batches of one user give what both together give, and read no earlier batch."""
    made = [("b0", [1.0, 0.2]), ("b1", [0.1, 0.9]), ("b2", [0.5, 0.5])]
    factors = spark.createDataFrame(made, "business_id string, features array<double>")
    path = f"{topics.base}/factors"
    factors.write.parquet(path)
    for part in ([0, 1], [2]):
        topics.reviews(*[(f"r{b}", f"b{b}", "u1", float(b + 1), None, None) for b in part], ("r9", "unknown", "u2", 3.0, None, None))
        S.start_user_factors(topics.subscribe, topics.base, path, rank=2, trigger=NOW).awaitTermination()
    ratings = spark.createDataFrame([("u1", f"b{b}", float(b + 1)) for b in range(3)], "user_id string, business_id string, stars double")
    expected = fold_in(ratings, factors, rank=2).collect()
    got = topics.result("user_factors").collect()
    assert [r.user_id for r in got] == ["u1"]
    assert got[0].features == pytest.approx(expected[0].features)


@pytest.mark.parametrize("accumulate", [False, True])
def test_predictions_per_micro_batch(topics, accumulate):
    for shift in range(2):
        topics.reviews(*ratings(4, 5, shift), (None, None, "u1", None, "bad", None))
        S.start_predictions(
            topics.subscribe, topics.base, accumulate, trigger=NOW, maxIter=2
        ).awaitTermination()
    got = topics.result("predictions")
    assert got.count() == 40
    assert not [f for f in os.listdir(scratch_root(topics.spark)) if f.startswith("predictions-")]
    assert got.where("prediction < 0 OR isnan(prediction)").count() == 0


def test_all_queries_and_refresh(spark, sf_dir, rows, topics):
    types = {t.record_type for t in RESULT_TABLES.values()}
    records = {t: read_fixture(spark, sf_dir, t) for t in types}
    for record_type, frame in records.items():
        topics.publish(record_type, frame)
    started = S.start_all(topics.subscribe, topics.base, LEXICON, **NOW)
    # Two pairs of tables share a query each.
    assert len(started) == 8
    S.await_all(topics.spark, started)
    tables = refresh(spark, S.results_root(topics.base), records["business"])
    assert set(tables) == set(CHARTS)
    for name, frame in tables.items():
        assert frame.count() > 0, name
    users = result_table("user_engagement", records["user"])
    assert rows(tables["users_top"]) == rows(users_top(users))


def test_failed_query_stops_the_others(topics):
    topics.reviews(review(1, "a", "2018-01-01"))

    def fail(text):
        raise ValueError("no score")

    bad = S.start_table("sentiment_aggregation", topics.subscribe, topics.base, scorer=fail)
    open_ended = S.start_table("review_trend_aggregation", topics.subscribe, topics.base, LEX)
    with pytest.raises(Exception, match="no score"):
        S.await_all(topics.spark, [open_ended, bad])
    assert not open_ended.isActive


def test_refresh_before_any_result(spark, tmp_path):
    businesses = spark.createDataFrame([], RECORDS["business"])
    tables = refresh(spark, str(tmp_path), businesses)
    charted = {table for table, _, _ in CHARTS.values()}
    assert set(RESULTS) - charted == {
        "daily_reviews", "late_reviews", "user_factors", "user_index", "business_index", "business_names",
    }
    assert tables["popularity_top"].count() == 0
    assert tables["tips_scale_bound"].first().scale_bound is None
