from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewmill.operators.names import attach_names, business_names
from reviewmill.operators.ranking import first_per_key, highest, lowest, top_k, with_rest
from reviewmill.plans import charts as C
from reviewmill.schemas import RESULTS

NAMES = "business_id string, name string"
SLOW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def table(spark, name, values):
    return spark.createDataFrame(values, RESULTS[name])


def names(spark, **by_id):
    return spark.createDataFrame(list(by_id.items()), NAMES)


def ids(df):
    return [r[0] for r in df.select("business_id").collect()]


def test_lookup_takes_the_last_record(spark, rows):
    df = spark.createDataFrame(
        [("1", "a", 1), ("1", "b", 0), ("2", None, 1), ("2", "x", 0), (None, "n", 0)],
        NAMES + ", seen int",
    )
    assert rows(business_names(df)) == [("1", "b"), ("2", "x")]
    assert rows(business_names(df, F.col("seen"))) == [("1", "a"), ("2", None)]


def test_inner_join_drops_and_left_join_keeps(spark, rows):
    df = spark.createDataFrame([("1", 5), ("9", 6)], "business_id string, n int")
    lookup = names(spark, **{"1": "one"})
    assert rows(attach_names(df, lookup, "inner")) == [("1", 5, "one")]
    assert rows(attach_names(df, lookup)) == [("1", 5, "one"), ("9", 6, None)]


def test_sentiment_lists_break_ties_by_rating(spark):
    values = [("a", 3.0, 9, 5, 5), ("b", 4.0, 9, 5, 5), ("c", None, 9, 5, 5), ("d", 4.0, 9, 5, 4)]
    sentiment = table(spark, "sentiment_aggregation", values)
    lookup = names(spark, a="A", b="B", c="C", d="D")
    assert ids(C.sentiment_top_positive(sentiment, lookup)) == ["b", "d", "a", "c"]
    assert ids(C.sentiment_top_negative(sentiment, lookup)) == ["a", "b", "c", "d"]


def test_later_snapshot_wins_over_earlier(spark, rows):
    values = [("a", 3.0, 1, 1, 0), ("a", 3.5, 2, 2, 0)]
    sentiment = table(spark, "sentiment_aggregation", values)
    got = rows(C.sentiment_top_positive(sentiment, names(spark, a="A")))
    assert got == [("a", 3.5, 2, 2, 0, "A")]


def test_popularity_needs_a_name_and_cuts_at_ten(spark):
    values = [(str(i), i) for i in range(1, 15)]
    lookup = names(spark, **{str(i): f"n{i}" for i in range(1, 14)})
    popularity = table(spark, "popularity_aggregation", values)
    assert ids(C.popularity_top(popularity, lookup)) == [str(i) for i in range(13, 3, -1)]
    assert ids(C.popularity_bottom(popularity, lookup)) == [str(i) for i in range(1, 11)]


def test_map_colour_is_clamped(spark):
    values = [(str(i), "n", 1.0, 2.0, None, s, 3) for i, s in enumerate([0.5, 3.5, 6.0, None])]
    points = C.map_points(table(spark, "geospatial_aggregation", values)).collect()
    assert [(r.color_value, r.size_value) for r in points] == [(1.0, 3), (3.5, 3), (5.0, 3), (None, 3)]


def test_redelivered_users_show_once(spark):
    values = [("u1", "x", 5, 0, 0, 0), ("u1", "x", 7, 0, 0, 0), ("u2", "y", 6, 0, 0, 0)]
    values += [("u3", "z", None, 0, 0, 0)]
    users = table(spark, "user_engagement", values)
    top = [(r.user_id, r.review_count) for r in C.users_top(users).collect()]
    assert top == [("u1", 7), ("u2", 6), ("u3", None)]
    bottom = [(r.user_id, r.review_count) for r in C.users_bottom(users).collect()]
    assert bottom == [("u2", 6), ("u1", 7), ("u3", None)]


@pytest.mark.parametrize("size", [0, 3, 10, 11, 30])
def test_pie_is_whole(spark, size):
    values = [(f"c{i:02}", i + 1) for i in range(size)]
    pie = C.category_pie(table(spark, "category_distribution", values)).collect()
    assert len(pie) == min(size, 10) + 1
    other = [r for r in pie if r.category == "Other"]
    assert [r["count"] for r in other] == [sum(range(1, max(size - 10, 0) + 1))]
    assert sum(r["count"] for r in pie) == size * (size + 1) // 2
    if size:
        assert sum(r.share for r in pie) == pytest.approx(1)
    else:
        assert other[0].share is None


def test_categories_and_cities_put_nulls_last(spark):
    ratings = table(spark, "top_rated_categories", [("a", 2.0), ("b", None), ("c", 3.0)])
    assert [r[0] for r in C.categories_top(ratings).collect()] == ["c", "a", "b"]
    assert [r[0] for r in C.categories_worst(ratings).collect()] == ["a", "c", "b"]
    cities = table(spark, "city_wise_business_count", [(None, 2), ("x", 2), ("y", 1)])
    assert [r[0] for r in C.cities_top(cities).collect()] == ["x", None, "y"]
    assert [r[0] for r in C.cities_bottom(cities).collect()] == ["y", "x", None]


def test_tips_collapse_by_name(spark):
    values = [("1", 9, 5, 0), ("2", 9, 7, 1), ("3", 9, 2, 8), ("4", 9, 1, 0), ("5", 9, 3, 0)]
    tips = table(spark, "tip_sentiment_aggregation", values)
    lookup = names(spark, **{"1": "same", "2": "same", "3": "other"})
    assert ids(C.tips_top_positive(tips, lookup)) == ["2", "5", "3"]
    assert ids(C.tips_top_negative(tips, lookup)) == ["3", "2", "5"]
    assert C.tips_scale_bound(tips, lookup).first().scale_bound == 8


@SLOW
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 9), st.integers(0, 9)), max_size=40))
def test_scale_bound_is_the_bound_of_both_lists(spark, values):
    unique = {b: (str(b), 9, p, n) for b, p, n in values}
    tips = table(spark, "tip_sentiment_aggregation", list(unique.values()))
    lookup = names(spark, **{str(b): f"n{b % 25}" for b in range(25)})
    lists = [r.positive_tips for r in C.tips_top_positive(tips, lookup).collect()]
    lists += [r.negative_tips for r in C.tips_top_negative(tips, lookup).collect()]
    assert C.tips_scale_bound(tips, lookup).first().scale_bound == max(lists, default=None)


def trend(spark, *values):
    return table(
        spark,
        "review_trend_aggregation",
        [(y, m, b, p + n, 3.0, p, n) for y, m, b, p, n in values],
    )


def test_trend_series(spark):
    frame = trend(
        spark,
        (2018, 5, "a", 6, 1),
        (2018, 6, "a", 5, 0),
        (2018, 5, "b", 10, 10),  # not above the threshold
        (2018, 5, "c", 99, 0),  # no name
        (None, None, "a", 50, 50),  # no month
        (2018, 7, "d", 0, 11),
    )
    lookup = names(spark, a="A", b="B", d="D")
    got = [tuple(r) for r in C.review_trend_series(frame, lookup).collect()]
    may, june, july = date(2018, 5, 1), date(2018, 6, 1), date(2018, 7, 1)
    assert got == [
        ("a", "A", may, "negative_reviews", 1, "A (Negative)"),
        ("a", "A", may, "positive_reviews", 6, "A (Positive)"),
        ("a", "A", june, "negative_reviews", 0, "A (Negative)"),
        ("a", "A", june, "positive_reviews", 5, "A (Positive)"),
        ("d", "D", july, "negative_reviews", 11, "D (Negative)"),
        ("d", "D", july, "positive_reviews", 0, "D (Positive)"),
    ]


def test_trend_shows_ten_businesses(spark):
    frame = trend(spark, *[(2018, 1, f"b{i:02}", 11 + i, 0) for i in range(15)])
    lookup = names(spark, **{f"b{i:02}": "n" for i in range(15)})
    shown = {r.business_id for r in C.review_trend_series(frame, lookup).collect()}
    assert shown == {f"b{i:02}" for i in range(5, 15)}


def test_predictions_keep_the_best_per_business(spark):
    values = [("u1", f"b{i:02}", float(i % 7)) for i in range(60)] + [("u0", "b00", 9.5)]
    predictions = table(spark, "predictions", values)
    got = C.predictions_top50(predictions, names(spark, b00="first")).collect()
    assert len(got) == 50
    assert (got[0].business_id, got[0].user_id, got[0].name) == ("b00", "u0", "first")
    expected = sorted(({b: p for _, b, p in values}).items(), key=lambda x: (-x[1], x[0]))[:50]
    assert [(r.business_id, r.prediction) for r in got] == expected


ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.integers(-3, 3) | st.none()),
    min_size=1,
    max_size=40,
)


@SLOW
@given(ROWS)
def test_first_per_key_matches_brute_force(spark, values):
    df = spark.createDataFrame(values, "k string, v int").repartition(3)
    got = {r.k: r.v for r in first_per_key(df, ["k"], [highest("v")]).collect()}
    expected = {}
    for k, v in values:
        best = expected.get(k)
        expected[k] = v if best is None else max(best, v if v is not None else best)
    assert got == expected


@SLOW
@given(ROWS, st.integers(1, 5))
def test_top_k_is_part_of_the_input_and_rest_is_whole(spark, values, k):
    df = spark.createDataFrame(values, "k string, v int")
    top = top_k(df, k, highest("v"), lowest("k"))
    kept = [tuple(r) for r in top.collect()]
    assert len(kept) == min(k, len(values)) and set(kept) <= set(values)
    whole = sum(v or 0 for _, v in values)
    assert sum(r.v or 0 for r in with_rest(df, top, "k", "v", "rest").collect()) == whole
