"""All chart tables from the current result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewmill.operators.names import business_names
from reviewmill.plans import charts
from reviewmill.schemas import RESULTS
from reviewmill.sources.results import read_result, read_versions

# chart table -> (result table, builder, whether it takes the business names)
CHARTS = {
    "sentiment_top_positive": ("sentiment_aggregation", charts.sentiment_top_positive, True),
    "sentiment_top_negative": ("sentiment_aggregation", charts.sentiment_top_negative, True),
    "popularity_top": ("popularity_aggregation", charts.popularity_top, True),
    "popularity_bottom": ("popularity_aggregation", charts.popularity_bottom, True),
    "map_points": ("geospatial_aggregation", charts.map_points, False),
    "users_top": ("user_engagement", charts.users_top, False),
    "users_bottom": ("user_engagement", charts.users_bottom, False),
    "category_pie": ("category_distribution", charts.category_pie, False),
    "categories_top": ("top_rated_categories", charts.categories_top, False),
    "categories_worst": ("top_rated_categories", charts.categories_worst, False),
    "cities_top": ("city_wise_business_count", charts.cities_top, False),
    "cities_bottom": ("city_wise_business_count", charts.cities_bottom, False),
    "tips_top_positive": ("tip_sentiment_aggregation", charts.tips_top_positive, True),
    "tips_top_negative": ("tip_sentiment_aggregation", charts.tips_top_negative, True),
    "tips_scale_bound": ("tip_sentiment_aggregation", charts.tips_scale_bound, True),
    "review_trend_series": ("review_trend_aggregation", charts.review_trend_series, True),
    "predictions_top50": ("predictions", charts.predictions_top50, True),
}


def chart_tables(
    results: dict[str, DataFrame], businesses: DataFrame
) -> dict[str, DataFrame]:
    """The chart tables of the given result tables."""
    names = business_names(businesses)
    return {
        chart: build(results[table], names) if named else build(results[table])
        for chart, (table, build, named) in CHARTS.items()
        if table in results
    }


def refresh(
    spark: SparkSession, result_root: str, businesses: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Chart tables over the result tables as they are now.

    Names come from ``businesses``, or without it from the table that
    ``start_business_names`` keeps, one row a business.
    Tables that one query keeps are read at one version, so their charts agree
    while the stream goes on.
    """
    versions = read_versions(spark, result_root)
    charted = {table for table, _, _ in CHARTS.values()}
    results = {
        table: read_result(spark, result_root, table, versions.get(table))
        for table in RESULTS
        if table in charted
    }
    if businesses is None:
        businesses = read_result(spark, result_root, "business_names")
    return chart_tables(results, businesses)
