"""The running result tables, as functions over DataFrames.

Each one serves batch and stream alike. All aggregates are sums, counts and
means that Spark combines on the map side, so a group that holds a large part
of the rows costs each task one partial row, not a transfer of the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from reviewmill.functions.columns import explode_categories
from reviewmill.functions.text import NEGATIVE, POSITIVE


def labelled(label: str) -> Column:
    """Number of rows with this sentiment label; unlabelled rows do not count."""
    return F.count_if(F.col("sentiment") == label)


def _review_measures() -> dict[str, Column]:
    return {
        "average_rating": F.avg("stars"),
        "review_count": F.count("review_id"),
        "positive_reviews": labelled(POSITIVE),
        "negative_reviews": labelled(NEGATIVE),
    }


def _measured(grouped: GroupedData, *names: str) -> DataFrame:
    measures = _review_measures()
    return grouped.agg(*[measures[name].alias(name) for name in names])


def sentiment_aggregation(reviews: DataFrame) -> DataFrame:
    return _measured(reviews.groupBy("business_id"), *_review_measures())


def review_trend_aggregation(reviews: DataFrame) -> DataFrame:
    return _measured(
        reviews.groupBy("review_year", "review_month", "business_id"),
        "review_count",
        "average_rating",
        "positive_reviews",
        "negative_reviews",
    )


def tip_sentiment_aggregation(tips: DataFrame) -> DataFrame:
    return tips.groupBy("business_id").agg(
        F.count("text").alias("tip_count"),
        labelled(POSITIVE).alias("positive_tips"),
        labelled(NEGATIVE).alias("negative_tips"),
    )


def popularity_aggregation(checkins: DataFrame) -> DataFrame:
    """Check-in records per business; one record counts one."""
    return checkins.groupBy("business_id").count()


def category_distribution(businesses: DataFrame) -> DataFrame:
    return explode_categories(businesses).groupBy("category").count()


def category_ratings(businesses: DataFrame) -> DataFrame:
    """Mean of the business stars per category, each business weighing the same."""
    return (
        explode_categories(businesses)
        .groupBy("category")
        .agg(F.avg("stars").alias("average_rating"))
    )


def top_rated_categories(businesses: DataFrame) -> DataFrame:
    """Category ratings, best first. On a stream this needs complete mode."""
    return category_ratings(businesses).orderBy(
        F.desc_nulls_last("average_rating"), "category"
    )


def city_wise_business_count(businesses: DataFrame) -> DataFrame:
    return businesses.groupBy("city").count()


def geospatial_aggregation(businesses: DataFrame) -> DataFrame:
    return businesses.select(
        "business_id",
        "name",
        "latitude",
        "longitude",
        "categories",
        "stars",
        "review_count",
    )


def user_engagement(users: DataFrame) -> DataFrame:
    return users.select("user_id", "name", "review_count", "useful", "cool", "funny")


def daily_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews per business and day of event time.

    The window key lets a stream close days behind the watermark, emit them
    once in append mode and forget their state.
    """
    grouped = reviews.groupBy(F.window("event_time", "1 day"), "business_id")
    return (
        _measured(grouped, *_review_measures())
        .withColumn("day", F.to_date("window.start"))
        .drop("window")
    )
