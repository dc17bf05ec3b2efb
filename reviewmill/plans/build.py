"""All result tables in one batch run, each input read and labelled once.

The review tables are roll-ups of one monthly aggregate and the category tables
of one aggregate per category, so the costly work (reading and scoring every
text, splitting every category list) is done once for both.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.columns import explode_categories
from reviewmill.functions.text import NEGATIVE, POSITIVE
from reviewmill.operators.aggregates import labelled
from reviewmill.operators.recommend import fit_score
from reviewmill.plans.tables import RESULT_TABLES, Lexicon, prepare_records, result_table
from reviewmill.session import materialize

_COUNTS = ("review_count", "positive_reviews", "negative_reviews")


def _sums() -> list[Column]:
    return [
        F.sum("stars").alias("stars_sum"),
        F.count("stars").alias("stars_count"),
        F.count("review_id").alias("review_count"),
        labelled(POSITIVE).alias("positive_reviews"),
        labelled(NEGATIVE).alias("negative_reviews"),
    ]


def review_rollup(reviews: DataFrame) -> DataFrame:
    """Sums and counts per month and business, from which any mean follows."""
    return reviews.groupBy("review_year", "review_month", "business_id").agg(*_sums())


def review_levels(reviews: DataFrame) -> DataFrame:
    """The same sums per month and business, and (``total``) per business, in one aggregate.

    A stream keeps both levels in its state, so a batch emits the new totals of the
    businesses it touches and reads no earlier result.
    """
    month = F.struct(F.lit(False).alias("total"), "review_year", "review_month")
    whole = F.struct(
        F.lit(True).alias("total"),
        F.lit(None).cast("int").alias("review_year"),
        F.lit(None).cast("int").alias("review_month"),
    )
    slim = reviews.select("business_id", "review_id", "stars", "sentiment", F.inline(F.array(month, whole)))
    return slim.groupBy("total", "review_year", "review_month", "business_id").agg(*_sums())


def daily_rollup(reviews: DataFrame) -> DataFrame:
    """Sums and counts per day of event time and business; partial ones add up."""
    return reviews.groupBy("day", "business_id").agg(*_sums())


def daily_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("business_id", "day").agg(
        _mean(F.sum("stars_sum"), F.sum("stars_count")),
        *[F.sum(c).alias(c) for c in _COUNTS],
    )


def _mean(total: str | Column, count: str | Column) -> Column:
    return F.try_divide(total, count).alias("average_rating")


def trend_from_rollup(rollup: DataFrame) -> DataFrame:
    keys = ("review_year", "review_month", "business_id")
    return rollup.select(
        *keys, "review_count", _mean("stars_sum", "stars_count"), *_COUNTS[1:]
    )


def sentiment_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("business_id").agg(
        _mean(F.sum("stars_sum"), F.sum("stars_count")),
        *[F.sum(c).alias(c) for c in _COUNTS],
    )


def category_rollup(businesses: DataFrame) -> DataFrame:
    return (
        explode_categories(businesses)
        .groupBy("category")
        .agg(F.count("*").alias("count"), F.avg("stars").alias("average_rating"))
    )


def categories_from_rollup(rollup: DataFrame) -> dict[str, DataFrame]:
    return {
        "category_distribution": rollup.select("category", "count"),
        "top_rated_categories": rollup.select("category", "average_rating").orderBy(
            F.desc_nulls_last("average_rating"), "category"
        ),
    }


def build_tables(
    records: Mapping[str, DataFrame],
    lexicon: Lexicon | None = None,
    scorer: Callable[[str], float] | None = None,
    ratings: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The result tables of the given record types, and predictions of ``ratings``."""
    tables: dict[str, DataFrame] = {}
    if "review" in records:
        labelled_reviews = prepare_records(records["review"], "review", lexicon, scorer)
        rollup = materialize(review_rollup(labelled_reviews), "review-rollup")
        tables["sentiment_aggregation"] = sentiment_from_rollup(rollup)
        tables["review_trend_aggregation"] = trend_from_rollup(rollup)
    if "business" in records:
        categories = materialize(category_rollup(records["business"]), "category-rollup")
        tables |= categories_from_rollup(categories)
    for name, table in RESULT_TABLES.items():
        if name not in tables and table.record_type in records:
            frame = records[table.record_type]
            tables[name] = result_table(name, frame, lexicon, scorer)
    if ratings is not None:
        tables["predictions"] = fit_score(ratings)
    return tables
