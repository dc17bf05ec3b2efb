"""The same queries as SQL text, for checking results in another engine."""

from __future__ import annotations

from reviewmill.plans.fixtures import NEGATORS, PHRASES, UNICODE_LEXICON, fixture_sql, lexicon_sql

_LABELS = r"""
{name}_labels AS (
    SELECT r.*,
        CASE WHEN r.text IS NULL THEN NULL
             WHEN coalesce(p.polarity, 0) > 0 THEN 'Positive'
             WHEN coalesce(p.polarity, 0) < 0 THEN 'Negative'
             ELSE 'Neutral' END AS sentiment,
        try_cast(r.date AS TIMESTAMP) AS event_time
    FROM {name}_rows r
    LEFT JOIN (
        SELECT row_id, avg(weight) AS polarity
        FROM (
            SELECT row_id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word
            FROM {name}_rows
        ) JOIN lexicon USING (word)
        GROUP BY row_id
    ) p ON p.row_id = r.row_id
)"""

_MEASURES = """
    avg(stars) AS average_rating,
    count(review_id) AS review_count,
    count(*) FILTER (sentiment = 'Positive') AS positive_reviews,
    count(*) FILTER (sentiment = 'Negative') AS negative_reviews"""

# Named steps; each query lists the ones it needs, in this order.
_STEPS = {
    "lexicon": f"lexicon AS ({lexicon_sql()})",
    "unicode_lexicon": f"lexicon AS ({lexicon_sql(UNICODE_LEXICON)})",
    # Its further words occur in no text, and two spellings share the mean weight.
    "large_lexicon": f"lexicon AS ({lexicon_sql()})",
    "made_predictions": (
        "made_predictions AS (SELECT user_id, "
        "CASE WHEN CAST(business_id AS BIGINT) % 7 = 0 THEN 'x' || business_id "
        "ELSE business_id END AS business_id, "
        "CAST((CAST(user_id AS BIGINT) * 31 + CAST(business_id AS BIGINT) * 17) % 23 AS FLOAT) "
        "AS prediction FROM rating)"
    ),
    "business": f"business AS ({fixture_sql('business')})",
    "user": f"users AS ({fixture_sql('user')})",
    "checkin": f"checkin AS ({fixture_sql('checkin')})",
    "rating": f"rating AS ({fixture_sql('rating')})",
    "review": f"review AS ({fixture_sql('review')})",
    "many_reviews": (
        "review AS (SELECT * REPLACE (CAST(CASE WHEN CAST(review_id AS BIGINT) % 3 = 0 "
        "THEN 100 + CAST(review_id AS BIGINT) % 400 ELSE CAST(review_id AS BIGINT) % 16 END "
        f"AS VARCHAR) AS business_id) FROM ({fixture_sql('review')}))"
    ),
    "tip": f"tip AS ({fixture_sql('tip')})",
    "review_labels": (
        "review_rows AS (SELECT *, row_number() OVER () AS row_id FROM review),"
        + _LABELS.format(name="review")
    ),
    "tip_labels": (
        "tip_rows AS (SELECT *, row_number() OVER () AS row_id FROM tip),"
        + _LABELS.format(name="tip")
    ),
    "names": (
        "names AS (SELECT business_id, max(name) AS name FROM business "
        "WHERE business_id IS NOT NULL GROUP BY business_id)"
    ),
    "exploded": (
        "exploded AS (SELECT *, unnest(string_split(categories, ', ')) AS category "
        "FROM business)"
    ),
    "sentiment": (
        f"sentiment AS (SELECT business_id, {_MEASURES} "
        "FROM review_labels GROUP BY business_id)"
    ),
    "popularity": (
        'popularity AS (SELECT business_id, count(*) AS "count" '
        "FROM checkin GROUP BY business_id)"
    ),
    "categories": (
        'categories AS (SELECT category, count(*) AS "count", '
        "avg(stars) AS average_rating FROM exploded GROUP BY category)"
    ),
    "cities": (
        'cities AS (SELECT city, count(*) AS "count" FROM business GROUP BY city)'
    ),
    "trend": (
        "trend AS (SELECT CAST(year(event_time) AS INTEGER) AS review_year, "
        "CAST(month(event_time) AS INTEGER) AS review_month, business_id, "
        f"{_MEASURES} FROM review_labels GROUP BY ALL)"
    ),
    "tip_sentiment": (
        "tip_sentiment AS (SELECT business_id, count(text) AS tip_count, "
        "count(*) FILTER (sentiment = 'Positive') AS positive_tips, "
        "count(*) FILTER (sentiment = 'Negative') AS negative_tips "
        "FROM tip_labels GROUP BY business_id)"
    ),
    "named_sentiment": (
        "named_sentiment AS (SELECT s.*, n.name FROM sentiment s "
        "JOIN names n USING (business_id))"
    ),
    "named_popularity": (
        "named_popularity AS (SELECT p.*, n.name FROM popularity p "
        "JOIN names n USING (business_id))"
    ),
    "named_tips": (
        "named_tips AS (SELECT t.*, n.name FROM tip_sentiment t "
        "LEFT JOIN names n USING (business_id) "
        "QUALIFY row_number() OVER (PARTITION BY n.name "
        "ORDER BY t.positive_tips DESC, t.business_id) = 1)"
    ),
    "ranked_categories": (
        "ranked_categories AS (SELECT *, row_number() OVER "
        '(ORDER BY "count" DESC, category) AS rn FROM categories)'
    ),
    "slices": (
        'slices AS (SELECT category, "count" FROM ranked_categories WHERE rn <= 10 '
        "UNION ALL SELECT 'Other', "
        'CAST(coalesce(sum("count") FILTER (rn > 10), 0) AS BIGINT) '
        "FROM ranked_categories)"
    ),
    "monthly": (
        "monthly AS (SELECT t.business_id, n.name, "
        "make_date(t.review_year, t.review_month, 1) AS date, "
        "CAST(sum(t.positive_reviews) AS BIGINT) AS positive_reviews, "
        "CAST(sum(t.negative_reviews) AS BIGINT) AS negative_reviews "
        "FROM trend t JOIN names n USING (business_id) "
        "WHERE n.name IS NOT NULL AND t.review_year IS NOT NULL "
        "GROUP BY t.business_id, n.name, date)"
    ),
    "shown": (
        "shown AS (SELECT business_id FROM monthly GROUP BY business_id, name "
        "HAVING sum(positive_reviews) > 10 OR sum(negative_reviews) > 10 "
        "ORDER BY sum(positive_reviews) + sum(negative_reviews) DESC, business_id "
        "LIMIT 10)"
    ),
}

_LABELLED_REVIEWS = ["lexicon", "review", "review_labels"]
_LABELLED_TIPS = ["lexicon", "tip", "tip_labels"]
_SENTIMENT = [*_LABELLED_REVIEWS, "sentiment"]
_TREND = [*_LABELLED_REVIEWS, "trend"]
_TIPS = [*_LABELLED_TIPS, "tip_sentiment"]
_CATEGORIES = ["business", "exploded", "categories"]
_NAMED_SENTIMENT = ["business", "names", *_SENTIMENT, "named_sentiment"]
_NAMED_POPULARITY = ["business", "names", "checkin", "popularity", "named_popularity"]
_NAMED_TIPS = ["business", "names", *_TIPS, "named_tips"]

_BUSINESS_COLUMNS = (
    "business_id, name, address, city, state, postal_code, latitude, longitude, "
    "stars, review_count, categories"
)
_SENTIMENT_COLUMNS = (
    "business_id, average_rating, review_count, positive_reviews, negative_reviews"
)
_TIP_COLUMNS = "business_id, tip_count, positive_tips, negative_tips"
_USER_COLUMNS = "user_id, name, review_count, useful, cool, funny"
_REVIEW_LABELS = "SELECT review_id, sentiment FROM review_labels"


def _index_sql(key: str, index: str) -> str:
    return (
        f"SELECT {key}, CAST(row_number() OVER (ORDER BY count(*) DESC, {key}) - 1 "
        f"AS INTEGER) AS {index} FROM rating GROUP BY {key}"
    )


def _phrases_sql() -> str:
    """Matches in order of place, the longest first, folded from the left."""
    rows = ", ".join(
        f"('{p}', {p.count(' ') + 1}, "
        f"{'NULL' if w is None else round(w * 1_000_000)}, {'NULL' if f is None else round(f * 1000)})"
        for p, w, f in PHRASES
    )
    first = "struct_pack(place := -1, size := 0, units := NULL, factor := 0, stop := 0, after := -1, times := 0, total := 0)"
    free = "m.place >= acc.stop"
    return rf"""SELECT review_id, CASE WHEN text IS NULL THEN NULL WHEN coalesce(total, 0) > 0 THEN 'Positive'
            WHEN coalesce(total, 0) < 0 THEN 'Negative' ELSE 'Neutral' END AS sentiment
        FROM review LEFT JOIN (
            SELECT review_id, list_reduce(list_prepend({first}::STRUCT(place BIGINT, size BIGINT, units BIGINT,
                    factor BIGINT, stop BIGINT, after BIGINT, times BIGINT, total BIGINT), found),
                lambda acc, m: struct_pack(place := m.place, size := m.size, units := m.units, factor := m.factor,
                    stop := CASE WHEN {free} AND m.units IS NOT NULL THEN m.place + m.size ELSE acc.stop END,
                    after := CASE WHEN {free} AND m.units IS NULL THEN m.place + 1 ELSE acc.after END,
                    times := CASE WHEN {free} AND m.units IS NULL THEN m.factor ELSE acc.times END,
                    total := acc.total + CASE WHEN {free} AND m.units IS NOT NULL
                        THEN m.units * CASE WHEN acc.after = m.place THEN acc.times ELSE 1000 END ELSE 0 END)).total AS total
            FROM (
                SELECT review_id, list(struct_pack(place := place, size := size, units := units, factor := factor,
                    stop := 0, after := 0, times := 0, total := 0)::STRUCT(place BIGINT, size BIGINT, units BIGINT,
                    factor BIGINT, stop BIGINT, after BIGINT, times BIGINT, total BIGINT)
                    ORDER BY place, size DESC) AS found
                FROM (
                    SELECT review_id, w, unnest(range(1, len(w) + 1)) AS place
                    FROM (SELECT review_id, regexp_extract_all(lower(text), '\p{{L}}+') AS w FROM review)
                ) t JOIN (SELECT * FROM (VALUES {rows}) AS v(phrase, size, units, factor)) p
                ON array_to_string(t.w[place:place + size - 1], ' ') = p.phrase
                GROUP BY review_id)
        ) USING (review_id)"""


_FOLDED_IN = (
    "SELECT CAST(count(*) AS BIGINT) AS predictions, TRUE AS better_than_mean FROM rating "
    "WHERE CAST(user_id AS BIGINT) % 5 = 0 AND business_id IN "
    "(SELECT business_id FROM rating WHERE CAST(user_id AS BIGINT) % 5 <> 0)"
)

# query -> (steps, final SELECT)
_QUERIES: dict[str, tuple[list[str], str]] = {
    "sentiment_aggregation": (_SENTIMENT, f"SELECT {_SENTIMENT_COLUMNS} FROM sentiment"),
    "popularity_aggregation": (
        ["checkin", "popularity"],
        'SELECT business_id, "count" FROM popularity',
    ),
    "geospatial_aggregation": (
        ["business"],
        "SELECT business_id, name, latitude, longitude, categories, stars, review_count "
        "FROM business",
    ),
    "user_engagement": (["user"], f"SELECT {_USER_COLUMNS} FROM users"),
    "category_distribution": (_CATEGORIES, 'SELECT category, "count" FROM categories'),
    "top_rated_categories": (
        _CATEGORIES,
        "SELECT category, average_rating FROM categories "
        "ORDER BY average_rating DESC NULLS LAST, category",
    ),
    "city_wise_business_count": (
        ["business", "cities"],
        'SELECT city, "count" FROM cities',
    ),
    "review_trend_aggregation": (_TREND, "SELECT * FROM trend"),
    "tip_sentiment_aggregation": (_TIPS, f"SELECT {_TIP_COLUMNS} FROM tip_sentiment"),
    "review_labels": (_LABELLED_REVIEWS, _REVIEW_LABELS),
    "review_labels_by_join": (_LABELLED_REVIEWS, _REVIEW_LABELS),
    "tip_labels": (
        _LABELLED_TIPS,
        "SELECT business_id, compliment_count, sentiment FROM tip_labels",
    ),
    "review_polarity": (
        _LABELLED_REVIEWS,
        "SELECT r.review_id, CASE WHEN r.text IS NULL THEN NULL ELSE "
        "round(coalesce(avg(l.weight), 0), 6) END AS polarity FROM review r "
        "LEFT JOIN (SELECT review_id, "
        "unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS word FROM review) t "
        "ON t.review_id = r.review_id LEFT JOIN lexicon l ON l.word = t.word "
        "GROUP BY r.review_id, r.text",
    ),
    "review_date_parts": (
        ["review"],
        "SELECT review_id, "
        "CAST(year(try_cast(date AS TIMESTAMP)) AS INTEGER) AS review_year, "
        "CAST(month(try_cast(date AS TIMESTAMP)) AS INTEGER) AS review_month, "
        "CAST(day(try_cast(date AS TIMESTAMP)) AS INTEGER) AS review_day FROM review",
    ),
    "business_lookup": (["business", "names"], "SELECT business_id, name FROM names"),
    "json_roundtrip": (["business"], f"SELECT {_BUSINESS_COLUMNS} FROM business"),
    "limited_export": (
        ["business"],
        f"SELECT {_BUSINESS_COLUMNS} FROM business ORDER BY business_id LIMIT 100",
    ),
    "sentiment_top_positive": (
        _NAMED_SENTIMENT,
        f"SELECT {_SENTIMENT_COLUMNS}, name FROM named_sentiment ORDER BY "
        "positive_reviews DESC, average_rating DESC NULLS LAST, business_id LIMIT 10",
    ),
    "sentiment_top_negative": (
        _NAMED_SENTIMENT,
        f"SELECT {_SENTIMENT_COLUMNS}, name FROM named_sentiment ORDER BY "
        "negative_reviews DESC, average_rating ASC NULLS LAST, business_id LIMIT 10",
    ),
    "popularity_top": (
        _NAMED_POPULARITY,
        'SELECT business_id, "count", name FROM named_popularity '
        'ORDER BY "count" DESC, business_id LIMIT 10',
    ),
    "popularity_bottom": (
        _NAMED_POPULARITY,
        'SELECT business_id, "count", name FROM named_popularity '
        'ORDER BY "count" ASC, business_id LIMIT 10',
    ),
    "map_points": (
        ["business"],
        "SELECT business_id, latitude, longitude, name, categories, stars, "
        "review_count, CASE WHEN stars < 1 THEN 1 WHEN stars > 5 THEN 5 ELSE stars END "
        "AS color_value, review_count AS size_value FROM business",
    ),
    "users_top": (
        ["user"],
        f"SELECT {_USER_COLUMNS} FROM users "
        "ORDER BY review_count DESC NULLS LAST, user_id LIMIT 20",
    ),
    "users_bottom": (
        ["user"],
        f"SELECT {_USER_COLUMNS} FROM users "
        "ORDER BY review_count ASC NULLS LAST, user_id LIMIT 20",
    ),
    "category_pie": (
        [*_CATEGORIES, "ranked_categories", "slices"],
        'SELECT category, "count", round("count" / sum("count") OVER (), 6) AS share '
        "FROM slices",
    ),
    "categories_top": (
        _CATEGORIES,
        "SELECT category, average_rating FROM categories "
        "ORDER BY average_rating DESC NULLS LAST, category LIMIT 20",
    ),
    "categories_worst": (
        _CATEGORIES,
        "SELECT category, average_rating FROM categories "
        "ORDER BY average_rating ASC NULLS LAST, category LIMIT 20",
    ),
    "cities_top": (
        ["business", "cities"],
        'SELECT city, "count" FROM cities '
        'ORDER BY "count" DESC, city NULLS LAST LIMIT 20',
    ),
    "cities_bottom": (
        ["business", "cities"],
        'SELECT city, "count" FROM cities '
        'ORDER BY "count" ASC, city NULLS LAST LIMIT 20',
    ),
    "tips_top_positive": (
        _NAMED_TIPS,
        f"SELECT {_TIP_COLUMNS}, name FROM named_tips "
        "ORDER BY positive_tips DESC, business_id LIMIT 10",
    ),
    "tips_top_negative": (
        _NAMED_TIPS,
        f"SELECT {_TIP_COLUMNS}, name FROM named_tips "
        "ORDER BY negative_tips DESC, business_id LIMIT 10",
    ),
    "tips_scale_bound": (
        _NAMED_TIPS,
        "SELECT greatest("
        "(SELECT max(positive_tips) FROM (SELECT positive_tips FROM named_tips "
        "ORDER BY positive_tips DESC LIMIT 10)), "
        "(SELECT max(negative_tips) FROM (SELECT negative_tips FROM named_tips "
        "ORDER BY negative_tips DESC LIMIT 10))) AS scale_bound",
    ),
    "review_trend_series": (
        ["business", "names", *_TREND, "monthly", "shown"],
        "SELECT business_id, name, date, 'positive_reviews' AS series, "
        "positive_reviews AS value, name || ' (Positive)' AS label "
        "FROM monthly WHERE business_id IN (SELECT business_id FROM shown) "
        "UNION ALL "
        "SELECT business_id, name, date, 'negative_reviews', negative_reviews, "
        "name || ' (Negative)' "
        "FROM monthly WHERE business_id IN (SELECT business_id FROM shown)",
    ),
    "user_index": (["rating"], _index_sql("user_id", "user_index")),
    "business_index": (["rating"], _index_sql("business_id", "business_index")),
    # The newest day is still open when the stream ends.
    "stream_review_daily": (
        _LABELLED_REVIEWS,
        f"SELECT business_id, CAST(event_time AS DATE) AS day, {_MEASURES} "
        "FROM review_labels WHERE CAST(event_time AS DATE) < "
        "(SELECT max(CAST(event_time AS DATE)) FROM review_labels) "
        "GROUP BY business_id, CAST(event_time AS DATE)",
    ),
    # Every review comes again at the end: all but those of the newest day are late.
    "stream_review_late": (
        ["review"],
        "SELECT review_id, business_id, CAST(try_cast(date AS TIMESTAMP) AS DATE) AS day "
        "FROM review WHERE CAST(try_cast(date AS TIMESTAMP) AS DATE) < "
        "(SELECT max(CAST(try_cast(date AS TIMESTAMP) AS DATE)) FROM review)",
    ),
    # Closed days, open days and late reviews together: every review, once.
    "stream_daily_complete": (
        _LABELLED_REVIEWS,
        "SELECT business_id, count(review_id) AS review_count, "
        "count(*) FILTER (sentiment = 'Positive') AS positive_reviews, "
        "count(*) FILTER (sentiment = 'Negative') AS negative_reviews "
        "FROM review_labels GROUP BY business_id",
    ),
    # New users' ratings of businesses that other users have rated.
    "predictions_fold_in": (["rating"], _FOLDED_IN),
    "stream_predictions_fold_in": (["rating"], _FOLDED_IN),
    "stream_business_lookup": (
        ["business"],
        "SELECT business_id, name || CASE WHEN CAST(business_id AS BIGINT) % 3 = 0 THEN ' 2' "
        "WHEN CAST(business_id AS BIGINT) % 2 = 0 THEN ' 1' ELSE '' END AS name "
        "FROM business WHERE name IS NOT NULL",
    ),
    "stream_user_index": (
        ["review"],
        "SELECT user_id, row_number() OVER (ORDER BY CAST(user_id AS BIGINT) % 3, user_id) - 1 AS user_index "
        "FROM (SELECT DISTINCT user_id FROM review)",
    ),
    "stream_one_version": (
        ["review"],
        "SELECT CAST(b AS INTEGER) AS batch, TRUE AS agree, count(review_id) AS review_count "
        "FROM range(3) AS t(b) JOIN review ON CAST(review_id AS BIGINT) % 3 <= b GROUP BY b",
    ),
    "review_labels_phrases": (["review"], _phrases_sql()),
    "review_labels_unicode": (
        ["unicode_lexicon", "review", "review_labels"],
        _REVIEW_LABELS,
    ),
    "review_labels_negation": (
        ["lexicon", "review"],
        r"""SELECT r.review_id, CASE WHEN r.text IS NULL THEN NULL
            WHEN coalesce(p.total, 0) > 0 THEN 'Positive'
            WHEN coalesce(p.total, 0) < 0 THEN 'Negative' ELSE 'Neutral' END AS sentiment
        FROM review r LEFT JOIN (
            SELECT review_id, sum(weight * flip) AS total
            FROM (
                SELECT review_id, words[i] AS word,
                    CASE WHEN i > 1 AND words[i - 1] IN %s THEN -1 ELSE 1 END AS flip
                FROM (
                    SELECT review_id, words, unnest(range(1, len(words) + 1)) AS i
                    FROM (SELECT review_id, regexp_extract_all(lower(text), '\p{L}+') AS words FROM review)
                )
            ) JOIN lexicon USING (word)
            GROUP BY review_id
        ) p USING (review_id)""" % (NEGATORS,),
    ),
    "review_labels_large_lexicon": (
        ["large_lexicon", "review", "review_labels"],
        _REVIEW_LABELS,
    ),
    "stream_labels_large_lexicon": (
        ["large_lexicon", "review", "review_labels"],
        _REVIEW_LABELS,
    ),
    "stream_dedup_malformed": (
        ["review"],
        'SELECT business_id, count(*) AS "count" FROM review GROUP BY business_id '
        "UNION ALL SELECT NULL, count(*) FROM customer",
    ),
    "predictions_coverage": (
        ["rating"],
        "SELECT user_id, business_id, count(*) AS predictions FROM rating "
        "WHERE user_id IS NOT NULL AND business_id IS NOT NULL AND stars IS NOT NULL "
        "GROUP BY user_id, business_id",
    ),
    "stream_predictions_coverage": (
        ["review"],
        "SELECT user_id, business_id, count(*) AS predictions FROM review "
        "WHERE user_id IS NOT NULL AND business_id IS NOT NULL AND stars IS NOT NULL "
        "GROUP BY user_id, business_id",
    ),
    "predictions_quality": (
        ["rating"],
        "SELECT count(*) AS predictions, CAST(0 AS BIGINT) AS negative, "
        "CAST(0 AS BIGINT) AS undefined, true AS better_than_mean FROM rating",
    ),
    "predictions_ranked": (
        ["business", "names", "rating", "made_predictions"],
        "SELECT p.user_id, p.business_id, p.prediction, n.name FROM made_predictions p "
        "LEFT JOIN names n USING (business_id) "
        "QUALIFY row_number() OVER (PARTITION BY p.business_id "
        "ORDER BY p.prediction DESC, p.user_id) = 1 "
        "ORDER BY p.prediction DESC, p.business_id LIMIT 50",
    ),
    "business_lookup_last": (
        [],
        "SELECT CAST(p_partkey % 50 AS VARCHAR) AS business_id, "
        "arg_max(p_name, struct_pack(a := p_size, b := p_name)) AS name "
        "FROM part GROUP BY ALL",
    ),
    "json_roundtrip_ids": (
        ["review"],
        "SELECT review_id, business_id, user_id, stars, text, date FROM review",
    ),
}

# Streams must end with the same rows as the batch query of the same table.
STREAMED = [
    "sentiment_aggregation",
    "popularity_aggregation",
    "geospatial_aggregation",
    "user_engagement",
    "category_distribution",
    "top_rated_categories",
    "city_wise_business_count",
    "review_trend_aggregation",
    "tip_sentiment_aggregation",
]

# Tables that the shared batch build derives from a roll-up.
BUILT = [
    "sentiment_aggregation",
    "review_trend_aggregation",
    "category_distribution",
    "top_rated_categories",
]


# Charts that must be the same when their table holds stale rows too.
DEDUPED = ["sentiment_top_positive", "popularity_top", "users_top", "categories_top", "cities_top"]

# Charts over tables that the streaming queries keep.
REFRESHED = [
    "sentiment_top_positive",
    "sentiment_top_negative",
    "popularity_top",
    "popularity_bottom",
    "map_points",
    "users_top",
    "users_bottom",
    "category_pie",
    "categories_top",
    "categories_worst",
    "cities_top",
    "cities_bottom",
    "tips_top_positive",
    "tips_top_negative",
    "tips_scale_bound",
    "review_trend_series",
]

# Reviews of some hundred businesses, most of them below the trend's threshold.
_MANY = {"review": "many_reviews"}


def oracle_sql() -> dict[str, str]:
    queries = dict(_QUERIES)
    for name in BUILT:
        queries[f"built_{name}"] = _QUERIES[name]
    for name in STREAMED:
        queries[f"stream_{name}"] = _QUERIES[name]
    for chart in DEDUPED:
        queries[f"dedup_{chart}"] = _QUERIES[chart]
    for chart in REFRESHED:
        queries[f"refresh_{chart}"] = _QUERIES[chart]
    steps, select = _QUERIES["review_trend_series"]
    queries["review_trend_series_many"] = ([_MANY.get(x, x) for x in steps], select)
    queries["stream_shared_sentiment"] = _QUERIES["sentiment_aggregation"]
    queries["stream_shared_trend"] = _QUERIES["review_trend_aggregation"]
    queries["stream_dedup_reviews"] = _QUERIES["sentiment_aggregation"]
    queries["stream_dedup_long"] = _QUERIES["sentiment_aggregation"]
    return {
        name: ("WITH " + ",\n".join(_STEPS[step] for step in steps) + "\n" if steps else "") + select
        for name, (steps, select) in queries.items()
    }
