from datetime import datetime

from reviewmill.functions.columns import explode_categories, with_date_parts, with_event_time
from reviewmill.operators import aggregates as A
from reviewmill.plans.build import build_tables
from reviewmill.plans.tables import RESULT_TABLES, result_table
from reviewmill.schemas import RECORDS, result_schema
from reviewmill.plans.fixtures import LEXICON, read_fixture

LEX = {"good": 1.0, "bad": -1.0}


def reviews(spark, *values):
    return spark.createDataFrame(list(values), RECORDS["review"])


def businesses(spark, *categories, stars=None, city=None):
    values = [
        (str(i), f"n{i}", None, city, None, None, None, None,
         None if stars is None else stars[i], 1, c)
        for i, c in enumerate(categories)
    ]
    return spark.createDataFrame(values, RECORDS["business"])


def test_columns_and_types_are_the_declared_ones(spark, sf_dir):
    for name, table in RESULT_TABLES.items():
        frame = result_table(name, read_fixture(spark, sf_dir, table.record_type), LEXICON)
        got = [(f.name, f.dataType) for f in frame.schema]
        assert got == [(f.name, f.dataType) for f in result_schema(name)], name


def test_review_counts_and_nulls(spark, rows):
    records = reviews(
        spark,
        ("r1", "b1", "u", 4.0, "good", "2018-01-02"),
        (None, "b1", "u", None, "bad", "2018-01-02"),
        ("r3", "b1", "u", 1.0, None, "2018-01-02"),
        ("r4", None, "u", 2.0, "so so", "2018-01-02"),
    )
    table = result_table("sentiment_aggregation", records, LEX)
    assert rows(table) == sorted([("b1", 2.5, 2, 1, 1), (None, 2.0, 1, 0, 0)], key=repr)


def test_bad_dates_form_a_null_month(spark, rows):
    records = reviews(
        spark,
        ("r1", "b", "u", 4.0, "good", "2018-01-02 01:02:03"),
        ("r2", "b", "u", 2.0, "bad", "2018-01-31"),
        ("r3", "b", "u", 1.0, "bad", "soon"),
        ("r4", "b", "u", 1.0, "bad", None),
    )
    table = result_table("review_trend_aggregation", records, LEX)
    assert rows(table) == [(2018, 1, "b", 2, 3.0, 1, 1), (None, None, "b", 2, 1.0, 0, 2)]


def test_date_parts(spark):
    records = reviews(spark, ("r", "b", "u", 1.0, None, "2019-12-31 22:09:11"))
    row = with_date_parts(with_event_time(records)).first()
    assert row.event_time == datetime(2019, 12, 31, 22, 9, 11)
    assert (row.review_year, row.review_month, row.review_day) == (2019, 12, 31)


def test_tips_count_texts_not_rows(spark, rows):
    tips = spark.createDataFrame(
        [("u", "b", "good", None, 0), ("u", "b", None, None, 0), ("u", "b", "", None, 0)],
        RECORDS["tip"],
    )
    table = result_table("tip_sentiment_aggregation", tips, LEX)
    assert rows(table) == [("b", 2, 1, 0)]


def test_one_checkin_record_counts_one(spark, rows):
    checkins = spark.createDataFrame(
        [("b", "2018-01-01, 2018-01-02"), ("b", None), (None, None)], RECORDS["checkin"]
    )
    table = A.popularity_aggregation(checkins)
    assert rows(table, "business_id", "count") == [("b", 2), (None, 1)]


def test_category_split(spark, rows):
    table = businesses(spark, "A, B", "A,B", "", None, "A, A")
    got = rows(A.category_distribution(table))
    assert got == sorted([("A", 3), ("B", 1), ("A,B", 1), ("", 1)], key=repr)
    total = sum(count for _, count in got)
    assert total == explode_categories(table).count() == 6


def test_category_ratings_are_unweighted_and_sorted(spark):
    table = businesses(spark, "A", "A", "B", "C", stars=[5.0, 2.0, 4.0, None])
    got = [tuple(r) for r in A.top_rated_categories(table).collect()]
    assert got == [("B", 4.0), ("A", 3.5), ("C", None)]


def test_null_city_is_a_group(spark, rows):
    assert rows(A.city_wise_business_count(businesses(spark, "A", "B"))) == [(None, 2)]


def test_shared_build_equals_single_tables(spark, sf_dir, rows):
    types = {t.record_type for t in RESULT_TABLES.values()}
    records = {t: read_fixture(spark, sf_dir, t) for t in types}
    built = build_tables(records, LEXICON)
    assert set(built) == set(RESULT_TABLES)
    for name, table in RESULT_TABLES.items():
        single = result_table(name, records[table.record_type], LEXICON)
        assert built[name].schema.names == single.schema.names
        assert [f.dataType for f in built[name].schema] == [f.dataType for f in single.schema]
        assert rows(built[name]) == rows(single), name


def test_mean_without_stars_is_null(spark, rows):
    records = reviews(spark, ("r", "b", "u", None, "good", "2018-01-02"))
    built = build_tables({"review": records}, LEX)
    assert rows(built["sentiment_aggregation"]) == [("b", None, 1, 1, 0)]
