"""Chart tables: each takes result tables and returns one DataFrame.

Every ranking ends in the row's key, so results are the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.columns import clamp, month_start
from reviewmill.operators.names import attach_names
from reviewmill.operators.ranking import first_per_key, highest, lowest, top_k, with_rest

# List lengths, the trend threshold, and the fixed texts.
BUSINESSES_SHOWN = 10
USERS_SHOWN = 20
SLICES_SHOWN = 10
CATEGORIES_SHOWN = 20
CITIES_SHOWN = 20
TRENDS_SHOWN = 10
PREDICTIONS_SHOWN = 50
TREND_THRESHOLD = 10
STARS_LOW, STARS_HIGH = 1.0, 5.0
OTHER = "Other"
UNKNOWN_BUSINESS = "Unknown Business"
POSITIVE_SUFFIX = " (Positive)"
NEGATIVE_SUFFIX = " (Negative)"


def _named_sentiment(sentiment: DataFrame, names: DataFrame) -> DataFrame:
    return first_per_key(
        attach_names(sentiment, names, "inner"),
        ["business_id"],
        [highest("review_count"), highest("positive_reviews"), highest("average_rating")],
    )


def sentiment_top_positive(sentiment: DataFrame, names: DataFrame) -> DataFrame:
    return top_k(
        _named_sentiment(sentiment, names),
        BUSINESSES_SHOWN,
        highest("positive_reviews"),
        highest("average_rating"),
        lowest("business_id"),
    )


def sentiment_top_negative(sentiment: DataFrame, names: DataFrame) -> DataFrame:
    return top_k(
        _named_sentiment(sentiment, names),
        BUSINESSES_SHOWN,
        highest("negative_reviews"),
        lowest("average_rating"),
        lowest("business_id"),
    )


def _named_popularity(popularity: DataFrame, names: DataFrame) -> DataFrame:
    return first_per_key(
        attach_names(popularity, names, "inner"), ["business_id"], [highest("count")]
    )


def popularity_top(popularity: DataFrame, names: DataFrame) -> DataFrame:
    return top_k(
        _named_popularity(popularity, names),
        BUSINESSES_SHOWN,
        highest("count"),
        lowest("business_id"),
    )


def popularity_bottom(popularity: DataFrame, names: DataFrame) -> DataFrame:
    """Businesses with the fewest check-ins, among those with at least one."""
    return top_k(
        _named_popularity(popularity, names),
        BUSINESSES_SHOWN,
        lowest("count"),
        lowest("business_id"),
    )


def map_points(geospatial: DataFrame) -> DataFrame:
    return geospatial.select(
        "business_id",
        "latitude",
        "longitude",
        "name",
        "categories",
        "stars",
        "review_count",
        clamp(F.col("stars"), STARS_LOW, STARS_HIGH).alias("color_value"),
        F.col("review_count").alias("size_value"),
    )


def _distinct_users(users: DataFrame) -> DataFrame:
    measures = ["review_count", "useful", "cool", "funny", "name"]
    return first_per_key(users, ["user_id"], [highest(c) for c in measures])


def users_top(users: DataFrame) -> DataFrame:
    return top_k(
        _distinct_users(users), USERS_SHOWN, highest("review_count"), lowest("user_id")
    )


def users_bottom(users: DataFrame) -> DataFrame:
    return top_k(
        _distinct_users(users), USERS_SHOWN, lowest("review_count"), lowest("user_id")
    )


def category_pie(distribution: DataFrame) -> DataFrame:
    """The largest categories, one row for all others, and the share of each."""
    top = top_k(distribution, SLICES_SHOWN, highest("count"), lowest("category"))
    slices = with_rest(distribution, top, "category", "count", OTHER)
    # At most SLICES_SHOWN + 1 rows reach this window.
    total = F.sum("count").over(Window.partitionBy())
    return slices.withColumn("share", F.try_divide("count", total))


def _distinct_categories(ratings: DataFrame) -> DataFrame:
    return first_per_key(ratings, ["category"], [highest("average_rating")])


def categories_top(ratings: DataFrame) -> DataFrame:
    return top_k(
        _distinct_categories(ratings),
        CATEGORIES_SHOWN,
        highest("average_rating"),
        lowest("category"),
    )


def categories_worst(ratings: DataFrame) -> DataFrame:
    return top_k(
        _distinct_categories(ratings),
        CATEGORIES_SHOWN,
        lowest("average_rating"),
        lowest("category"),
    )


def _distinct_cities(cities: DataFrame) -> DataFrame:
    return first_per_key(cities, ["city"], [highest("count")])


def cities_top(cities: DataFrame) -> DataFrame:
    return top_k(_distinct_cities(cities), CITIES_SHOWN, highest("count"), lowest("city"))


def cities_bottom(cities: DataFrame) -> DataFrame:
    return top_k(_distinct_cities(cities), CITIES_SHOWN, lowest("count"), lowest("city"))


def _tips_by_name(tips: DataFrame, names: DataFrame) -> DataFrame:
    """Tips with one row per name; businesses without a name count as one name."""
    return first_per_key(
        attach_names(tips, names),
        ["name"],
        [highest("positive_tips"), lowest("business_id")],
    )


def tips_top_positive(tips: DataFrame, names: DataFrame) -> DataFrame:
    return top_k(
        _tips_by_name(tips, names),
        BUSINESSES_SHOWN,
        highest("positive_tips"),
        lowest("business_id"),
    )


def tips_top_negative(tips: DataFrame, names: DataFrame) -> DataFrame:
    return top_k(
        _tips_by_name(tips, names),
        BUSINESSES_SHOWN,
        highest("negative_tips"),
        lowest("business_id"),
    )


def tips_scale_bound(tips: DataFrame, names: DataFrame) -> DataFrame:
    """Upper end of the tip colour scale.

    The greatest count always leads its own top list, so the bound over both
    lists is the bound over all names: one aggregate, no sort.
    """
    return _tips_by_name(tips, names).agg(
        F.greatest(F.max("positive_tips"), F.max("negative_tips")).alias("scale_bound")
    )


def review_trend_series(trend: DataFrame, names: DataFrame) -> DataFrame:
    """Monthly positive and negative reviews of the most reviewed businesses.

    One row per business, month and series. Businesses without a name and
    rows without a month are left out.
    """
    sums = [F.sum(c).alias(c) for c in ("positive_reviews", "negative_reviews")]
    monthly = (
        attach_names(trend, names)
        .where(F.col("name").isNotNull())
        .withColumn("date", month_start(F.col("review_year"), F.col("review_month")))
        .where(F.col("date").isNotNull())
        .groupBy("business_id", "name", "date")
        .agg(*sums)
    )
    significant = (
        monthly.groupBy("business_id", "name")
        .agg(*sums)
        .where(
            (F.col("positive_reviews") > TREND_THRESHOLD)
            | (F.col("negative_reviews") > TREND_THRESHOLD)
        )
        .withColumn("total_reviews", F.col("positive_reviews") + F.col("negative_reviews"))
    )
    shown = top_k(
        significant, TRENDS_SHOWN, highest("total_reviews"), lowest("business_id")
    ).select("business_id")
    # The limit bounds the broadcast side to TRENDS_SHOWN rows.
    kept = monthly.join(F.broadcast(shown), "business_id", "left_semi")
    title = F.coalesce("name", F.lit(UNKNOWN_BUSINESS))
    suffix = F.when(F.col("series") == "positive_reviews", POSITIVE_SUFFIX).otherwise(
        NEGATIVE_SUFFIX
    )
    return (
        kept.unpivot(
            ["business_id", "name", "date"],
            ["positive_reviews", "negative_reviews"],
            "series",
            "value",
        )
        .withColumn("label", F.concat(title, suffix))
        .orderBy("business_id", "date", "series")
    )


def predictions_top50(predictions: DataFrame, names: DataFrame) -> DataFrame:
    """Businesses by their best predicted rating.

    The names are joined after the cut: a left lookup changes no rank, so only
    PREDICTIONS_SHOWN rows need one.
    """
    best = first_per_key(
        predictions, ["business_id"], [highest("prediction"), lowest("user_id")]
    )
    order = [highest("prediction"), lowest("business_id")]
    shown = top_k(best, PREDICTIONS_SHOWN, *order)
    # The limit bounds the broadcast ids; Spark moves this below the names' aggregate.
    named = names.join(F.broadcast(shown.select("business_id")), "business_id", "left_semi")
    return attach_names(shown, named).orderBy(*order)
