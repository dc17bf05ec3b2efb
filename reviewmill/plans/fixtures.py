"""Record tables derived from the test data, for Spark and for SQL alike.

Each column is one expression that means the same in both. NULLs and bad dates
are put in on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# record type -> (source tables, {column: expression})
EXPRESSIONS: dict[str, tuple[str, dict[str, str]]] = {
    "business": (
        "part",
        {
            "business_id": "CAST(p_partkey AS STRING)",
            "name": "p_name",
            "address": "p_type",
            "city": "CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE p_brand END",
            "state": "p_type",
            "postal_code": "CAST(p_size AS STRING)",
            "latitude": (
                "CAST(39.5 + (p_partkey % 100) / CAST(128 AS DOUBLE) AS DOUBLE)"
            ),
            "longitude": (
                "CAST(-86.5 + (p_partkey % 64) / CAST(128 AS DOUBLE) AS DOUBLE)"
            ),
            "stars": (
                "CASE WHEN p_partkey % 83 = 0 THEN NULL "
                "ELSE CAST(1 + (p_size % 9) * 0.5 AS DOUBLE) END"
            ),
            "review_count": "CAST(p_size AS BIGINT)",
            "categories": (
                "CASE WHEN p_partkey % 97 = 0 THEN NULL "
                "ELSE concat(p_type, ', ', replace(p_name, ' ', ', ')) END"
            ),
        },
    ),
    "review": (
        "documents",
        {
            "review_id": "CAST(doc_id AS STRING)",
            "business_id": "CAST(doc_id % 12 AS STRING)",
            "user_id": "CAST(doc_id % 37 AS STRING)",
            "stars": "CAST(1 + (n_chars % 9) * 0.5 AS DOUBLE)",
            "text": "CASE WHEN doc_id % 103 = 0 THEN NULL ELSE text END",
            "date": (
                "CASE WHEN doc_id % 101 = 0 THEN 'bad-date' "
                "ELSE concat(CAST(DATE '2018-01-01' + CAST(n_chars % 720 AS INT) "
                "AS STRING), ' 22:09:11') END"
            ),
        },
    ),
    "tip": (
        "conversations",
        {
            "user_id": "role",
            "business_id": "CAST(conv_id AS STRING)",
            "text": "CASE WHEN (conv_id * 10 + turn) % 53 = 0 THEN NULL ELSE text END",
            "date": (
                "concat(CAST(DATE '2024-01-01' + CAST(conv_id % 28 AS INT) AS STRING), "
                "' 08:00:00')"
            ),
            "compliment_count": "CAST(turn AS BIGINT)",
        },
    ),
    "checkin": (
        "events",
        {
            "business_id": "regexp_extract(props, '([0-9]+)', 1)",
            "date": "CAST(ts AS STRING)",
        },
    ),
    "user": (
        "customer",
        {
            "user_id": "CAST(c_custkey AS STRING)",
            "name": "c_name",
            "review_count": "CAST((c_custkey * 7919) % 1000 AS BIGINT)",
            "yelping_since": "CAST(NULL AS STRING)",
            "friends": "CAST(NULL AS STRING)",
            "useful": "CAST(c_custkey % 11 AS BIGINT)",
            "funny": "CAST(c_custkey % 7 AS BIGINT)",
            "cool": "CAST(c_custkey % 5 AS BIGINT)",
        },
    ),
    "rating": (
        "lineitem JOIN orders ON l_orderkey = o_orderkey",
        {
            "user_id": "CAST(o_custkey AS STRING)",
            "business_id": "CAST(l_partkey AS STRING)",
            "stars": "CAST(1 + (l_quantity % 9) * 0.5 AS DOUBLE)",
        },
    ),
}

# Invented weights on common tokens of the invented test prose.
LEXICON = {
    "of": 0.5,
    "and": -0.5,
    "to": 0.25,
    "in": -0.25,
    "is": 0.75,
    "it": -0.75,
    "de": 0.5,
    "la": -0.5,
    "der": 0.25,
    "die": -0.25,
    "que": 0.25,
    "en": -0.25,
}


# Words outside ASCII, as they are in the test prose.
UNICODE_LEXICON = {"für": 0.5, "ré": -0.5, "é": 0.25, "según": 0.5, "ê": -0.25, "über": -0.75, "la": 0.25}

# Frequent words that stand before words of the lexicon.
NEGATORS = ("the", "of", "und", "les", "el", "de")

# Phrases (weight) and degree words (factor) of the invented prose: phrase, weight, factor.
PHRASES = [
    ("of the", -0.75, None),
    ("to the", 0.5, None),
    ("in the", 0.25, None),
    ("and of the", 1.0, None),
    ("de la", 0.75, None),
    ("of", 0.5, None),
    ("and", -0.5, None),
    ("is", 0.75, None),
    ("it", -0.75, None),
    ("der", 0.25, None),
    ("que", 0.25, None),
    ("en", -0.25, None),
    ("the", None, 1.5),
    ("for", None, -0.5),
    ("die", None, 2.0),
    ("el", None, -1.0),
]

# Invented words of a lexicon too large for a plan; none occurs in a text.
RARE_WORDS = 25_000


def large_lexicon(spark: SparkSession) -> DataFrame:
    """Over 20,000 words, and those of LEXICON in two spellings with the same mean."""
    rare = spark.range(RARE_WORDS).select(
        F.concat(
            F.lit("zzz"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
        ).alias("word"),
        F.lit(1.0).alias("weight"),
    )
    spellings = [(w.upper(), v + 0.25) for w, v in LEXICON.items()]
    spellings += [(w, v - 0.25) for w, v in LEXICON.items()]
    return rare.union(spark.createDataFrame(spellings, "word string, weight double"))


def _columns(record_type: str) -> list[str]:
    _, columns = EXPRESSIONS[record_type]
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def read_fixture(spark: SparkSession, sf_dir: str, record_type: str) -> DataFrame:
    source, _ = EXPRESSIONS[record_type]

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    if record_type == "rating":
        lines, orders = table("lineitem"), table("orders")
        frame = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    else:
        frame = table(source)
    return frame.selectExpr(*_columns(record_type))


def fixture_sql(record_type: str) -> str:
    source, _ = EXPRESSIONS[record_type]
    return f"SELECT {', '.join(_columns(record_type))} FROM {source}"


def lexicon_sql(lexicon: dict[str, float] = LEXICON) -> str:
    rows = ", ".join(f"('{word}', {weight})" for word, weight in lexicon.items())
    return f"SELECT * FROM (VALUES {rows}) AS v(word, weight)"
