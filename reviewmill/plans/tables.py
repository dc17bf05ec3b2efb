"""The result tables: record type, builder and output mode of each.

One list drives the batch build and the streaming queries.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from reviewmill.functions.columns import (
    with_date_parts,
    with_event_time,
    with_ingest_time,
)
from reviewmill.functions.text import label_sentiment
from reviewmill.operators import aggregates as agg

# Fixed value: how long event time may lag behind.
WATERMARK = "10 minutes"

Lexicon = DataFrame | Mapping[str, float]


@dataclass(frozen=True)
class ResultTable:
    name: str
    record_type: str
    build: Callable[[DataFrame], DataFrame]
    mode: str


RESULT_TABLES = {
    t.name: t
    for t in (
        ResultTable(
            "sentiment_aggregation", "review", agg.sentiment_aggregation, "complete"
        ),
        ResultTable(
            "popularity_aggregation", "checkin", agg.popularity_aggregation, "complete"
        ),
        ResultTable(
            "geospatial_aggregation", "business", agg.geospatial_aggregation, "append"
        ),
        ResultTable("user_engagement", "user", agg.user_engagement, "append"),
        ResultTable(
            "category_distribution", "business", agg.category_distribution, "complete"
        ),
        ResultTable(
            "top_rated_categories", "business", agg.top_rated_categories, "complete"
        ),
        ResultTable(
            "city_wise_business_count",
            "business",
            agg.city_wise_business_count,
            "complete",
        ),
        ResultTable(
            "review_trend_aggregation",
            "review",
            agg.review_trend_aggregation,
            "complete",
        ),
        ResultTable(
            "tip_sentiment_aggregation",
            "tip",
            agg.tip_sentiment_aggregation,
            "complete",
        ),
    )
}


def prepare_records(
    records: DataFrame,
    record_type: str,
    lexicon: Lexicon | None = None,
    scorer: Callable[[str], float] | None = None,
    watermark: str | None = WATERMARK,
) -> DataFrame:
    """Parsed records with their event time, watermark, label and date parts."""
    if record_type == "review":
        timed = with_date_parts(with_event_time(records, watermark))
        return label_sentiment(timed, lexicon, scorer)
    if record_type == "tip":
        return label_sentiment(with_event_time(records, watermark), lexicon, scorer)
    if record_type == "business":
        return with_ingest_time(records, watermark)
    return records


def result_table(
    name: str,
    records: DataFrame,
    lexicon: Lexicon | None = None,
    scorer: Callable[[str], float] | None = None,
    watermark: str | None = WATERMARK,
) -> DataFrame:
    """One result table from parsed records, batch or stream.

    The watermark changes no result: no table groups by the watermarked time.
    """
    table = RESULT_TABLES[name]
    prepared = prepare_records(records, table.record_type, lexicon, scorer, watermark)
    return table.build(prepared)
