"""Record and result-table schemas, written as Spark DDL.

Every field is nullable: a record that lacks a field, or carries it with the
wrong type, keeps its other fields.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the five input record types.
RECORDS = {
    "review": (
        "review_id string, business_id string, user_id string, "
        "stars double, text string, date string"
    ),
    "checkin": "business_id string, date string",
    "business": (
        "business_id string, name string, address string, city string, "
        "state string, postal_code string, latitude double, longitude double, "
        "stars double, review_count bigint, categories string"
    ),
    "user": (
        "user_id string, name string, review_count bigint, yelping_since string, "
        "friends string, useful bigint, funny bigint, cool bigint"
    ),
    "tip": (
        "user_id string, business_id string, text string, date string, "
        "compliment_count bigint"
    ),
}

# Collection that holds each record type. A topic is named
# "<prefix>-<collection>".
COLLECTIONS = {
    "review": "review",
    "checkin": "checkin",
    "business": "businesses",
    "user": "user",
    "tip": "tip",
}

# Names and columns of the result tables.
RESULTS = {
    "sentiment_aggregation": (
        "business_id string, average_rating double, review_count bigint, "
        "positive_reviews bigint, negative_reviews bigint"
    ),
    "popularity_aggregation": "business_id string, count bigint",
    "geospatial_aggregation": (
        "business_id string, name string, latitude double, longitude double, "
        "categories string, stars double, review_count bigint"
    ),
    "user_engagement": (
        "user_id string, name string, review_count bigint, useful bigint, "
        "cool bigint, funny bigint"
    ),
    "category_distribution": "category string, count bigint",
    "top_rated_categories": "category string, average_rating double",
    "city_wise_business_count": "city string, count bigint",
    "review_trend_aggregation": (
        "review_year int, review_month int, business_id string, "
        "review_count bigint, average_rating double, "
        "positive_reviews bigint, negative_reviews bigint"
    ),
    "tip_sentiment_aggregation": (
        "business_id string, tip_count bigint, positive_tips bigint, "
        "negative_tips bigint"
    ),
    "predictions": "user_id string, business_id string, prediction float",
    "user_factors": "user_id string, features array<double>",
    "business_names": "business_id string, name string",
    "user_index": "user_id string, user_index bigint",
    "business_index": "business_id string, business_index bigint",
    "daily_reviews": (
        "business_id string, day date, average_rating double, review_count bigint, "
        "positive_reviews bigint, negative_reviews bigint"
    ),
    "late_reviews": (
        "review_id string, business_id string, event_time timestamp, day date, "
        "stars double, sentiment string"
    ),
}

# Tables of which a micro-batch writes new rows; all of them count.
APPENDED = ("predictions", "daily_reviews", "late_reviews", "user_index", "business_index")

# Keys of the running tables of which a micro-batch writes the changed rows only.
RESULT_KEYS = {
    "sentiment_aggregation": ["business_id"],
    "popularity_aggregation": ["business_id"],
    "review_trend_aggregation": ["review_year", "review_month", "business_id"],
    "tip_sentiment_aggregation": ["business_id"],
    "user_factors": ["user_id"],
    "business_names": ["business_id"],
}


def record_schema(record_type: str) -> T.StructType:
    return T.StructType.fromDDL(RECORDS[record_type])


def result_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(RESULTS[table])


def topic_name(prefix: str, record_type: str) -> str:
    return f"{prefix}-{COLLECTIONS[record_type]}"
