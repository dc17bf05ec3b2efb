"""Column functions shared by the batch and the streaming plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how a business lists its categories inside one string.
CATEGORY_SEPARATOR = ", "


def event_time(date: Column) -> Column:
    """Timestamp of a date string; text that is no timestamp gives null."""
    return F.try_to_timestamp(date)


def with_event_time(df: DataFrame, delay: str | None = None) -> DataFrame:
    stamped = df.withColumn("event_time", event_time(F.col("date")))
    return stamped if delay is None else stamped.withWatermark("event_time", delay)


def with_ingest_time(df: DataFrame, delay: str | None = None) -> DataFrame:
    stamped = df.withColumn("ingest_time", F.current_timestamp())
    return stamped if delay is None else stamped.withWatermark("ingest_time", delay)


def with_date_parts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "review_year": F.year("event_time"),
            "review_month": F.month("event_time"),
            "review_day": F.dayofmonth("event_time"),
        }
    )


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def explode_categories(businesses: DataFrame) -> DataFrame:
    """One row per listed category; a business without a list gives no row."""
    return businesses.withColumn(
        "category", F.explode(F.split("categories", CATEGORY_SEPARATOR))
    )


def clamp(value: Column, low: float, high: float) -> Column:
    """``value`` held inside [low, high]; null stays null."""
    return F.when(
        value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high))
    )
