"""Lexicon sentiment: the mean weight of the lexicon words found in a text.

The label is the sign of that mean. Three ways give the same labels:

* ``sentiment(text, weights)`` is one row-local expression that stays in the
  JVM and moves no data. It works on streams. The words are literals of the
  plan, which suits up to ``LITERAL_WORDS`` words.
* ``label_by_join`` joins tokens with a lexicon table of any size, in batch.
* ``label_by_lookup`` looks tokens up in Arrow batches: larger lexicons on streams.

``label_by_scorer`` calls any other Python polarity function, in Arrow batches.

All ways weigh words by ``lexicon_units``: words are lower-cased, repeated ones
take their mean weight, and weights are whole millionths. Sums of whole numbers
do not depend on the order of addition, so a label depends neither on the way
nor on the partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.session import materialize

# Labels by sign of the polarity.
POSITIVE, NEUTRAL, NEGATIVE = "Positive", "Neutral", "Negative"

# Tokens are runs of letters of any script. The possessive "++" finds the same
# runs as "+" and is faster.
TOKEN = r"\p{L}++"

UNITS = 1_000_000
# Up to this many words go into the plan; more are joined or looked up, with
# the same labels.
LITERAL_WORDS = 20_000
# Words that an executor holds for look-ups, at most: some hundred megabytes.
LOOKUP_WORDS = 5_000_000


# Put before a token that follows a negator. No token begins with it, and the
# lexicon holds each word with it as well, with the opposite weight.
NEGATED = "-"


def tokens(text: Column, negators: Collection[str] = ()) -> Column:
    """Words of a text; those right after a negator are marked as NEGATED."""
    words = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 0)
    if not negators:
        return words
    known = sorted({word.lower() for word in negators})
    marked = F.transform(
        F.arrays_zip(words.alias("word"), F.concat(F.array(F.lit("")), words).alias("before")),
        lambda pair: F.when(
            pair["before"].isin(known) & pair["word"].isNotNull(),
            F.concat(F.lit(NEGATED), pair["word"]),
        ).otherwise(pair["word"]),
    )
    # Zipped with one more word before than there are words.
    return F.filter(marked, lambda word: word.isNotNull())


def label_of(polarity: Column) -> Column:
    return (
        F.when(polarity > 0, POSITIVE)
        .when(polarity == 0, NEUTRAL)
        .when(polarity < 0, NEGATIVE)
    )


def lexicon_units(lexicon: DataFrame) -> DataFrame:
    """(word, units), one row per word; repeated words take their mean weight."""
    return (
        lexicon.where(F.col("word").isNotNull() & F.col("weight").isNotNull())
        .groupBy(F.lower("word").alias("word"))
        .agg(F.round(F.avg("weight") * UNITS).cast("bigint").alias("units"))
    )


def read_lexicon(
    spark: SparkSession, path: str, file_format: str = "parquet"
) -> DataFrame:
    """A lexicon stored as (word, weight) rows, checked.

    Raises ValueError where a row lacks its word or weight, a weight is beyond
    [-1, 1], or a word is no run of letters and so could never be found.
    """
    reader = spark.read.schema("word string, weight double")
    lexicon = reader.format(file_format).load(path)
    bad = ~F.col("word").rlike(r"^\p{L}+$") | ~F.col("weight").between(-1, 1)
    missing = F.col("word").isNull() | F.col("weight").isNull()
    wrong = lexicon.where(missing | bad).limit(1).collect()
    if wrong:
        raise ValueError(f"not a lexicon entry: {wrong[0].asDict()}")
    return lexicon


def with_negated(lexicon: DataFrame) -> DataFrame:
    """Each word also as NEGATED, with the opposite weight."""
    marked = F.concat(F.lit(NEGATED), "word").alias("word")
    return lexicon.union(lexicon.select(marked, (-F.col("weight")).alias("weight")))


def lexicon_table(spark: SparkSession, lexicon: DataFrame | Mapping[str, float]) -> DataFrame:
    """A lexicon as (word, weight) rows, whatever form it has."""
    if isinstance(lexicon, Mapping):
        rows = [(word, float(weight)) for word, weight in lexicon.items()]
        return spark.createDataFrame(rows, "word string, weight double")
    return lexicon.select("word", F.col("weight").cast("double").alias("weight"))


def literal_weights(
    spark: SparkSession, lexicon: DataFrame | Mapping[str, float]
) -> dict[str, int] | None:
    """Weights as plan literals, or None when the lexicon has too many words.

    A mapping without spellings to merge is weighed here, as ``lexicon_units`` would,
    which saves each labelling a job.
    """
    if isinstance(lexicon, Mapping) and all(word.isascii() and word == word.lower() for word in lexicon):
        if len(lexicon) > LITERAL_WORDS:
            return None
        return {word: _units(float(weight)) for word, weight in lexicon.items()}
    units = lexicon_units(lexicon_table(spark, lexicon))
    rows = units.limit(LITERAL_WORDS + 1).collect()
    return dict(map(tuple, rows)) if len(rows) <= LITERAL_WORDS else None


def _units(weight: float) -> int:
    """Whole millionths, halves away from zero, as Spark rounds."""
    return int(Decimal(repr(weight * UNITS)).to_integral_value(ROUND_HALF_UP))


def _weight_of(word: Column, by_weight: list[tuple[int, list[str]]]) -> Column:
    """Weight of a known lexicon word: a search tree of hashed word sets."""
    if len(by_weight) == 1:
        return F.lit(by_weight[0][0]).cast("bigint")
    left, right = by_weight[: len(by_weight) // 2], by_weight[len(by_weight) // 2 :]
    in_left = word.isin([w for _, words in left for w in words])
    return F.when(in_left, _weight_of(word, left)).otherwise(_weight_of(word, right))


def _found(
    text: Column, weights: Mapping[str, int], negators: Collection[str]
) -> tuple[Column, Callable]:
    """Lexicon words of one text, repeats kept, and the function that weighs one."""
    groups: dict[int, list[str]] = {}
    for word, units in sorted(weights.items()):
        groups.setdefault(units, []).append(word)
    by_weight = sorted(groups.items())
    found = F.filter(tokens(text, negators), lambda word: word.isin(sorted(weights)))
    return found, lambda word: _weight_of(word, by_weight)


def sentiment(
    text: Column, weights: Mapping[str, int], negators: Collection[str] = ()
) -> Column:
    """Label of one text. Only the sign counts, so the sum stands for the mean."""
    if not weights:
        return F.when(text.isNotNull(), NEUTRAL)
    found, weigh = _found(text, weights, negators)
    zero = F.lit(0).cast("bigint")
    return F.aggregate(found, zero, lambda acc, word: acc + weigh(word), label_of)


def polarity(text: Column, weights: Mapping[str, int]) -> Column:
    """Mean weight of the lexicon words in the text; 0 without any, null for null."""
    if not weights:
        return F.when(text.isNotNull(), F.lit(0.0))
    found, weigh = _found(text, weights, ())
    zero = F.lit(0).cast("bigint")
    return F.aggregate(
        found,
        F.struct(zero.alias("units"), zero.alias("hits")),
        lambda acc, word: F.struct(
            (acc["units"] + weigh(word)).alias("units"), (acc["hits"] + 1).alias("hits")
        ),
        lambda acc: F.when(acc["hits"] == 0, 0.0).otherwise(
            acc["units"] / acc["hits"] / UNITS
        ),
    )


def label_by_join(
    df: DataFrame,
    lexicon: DataFrame,
    text: str = "text",
    label: str = "sentiment",
    negators: Collection[str] = (),
) -> DataFrame:
    """Label texts against a lexicon table of any size (batch only).

    Tokens are summed per fingerprint of the text, map side first, so neither
    texts nor tokens are shuffled when the lexicon is small enough for Spark
    to broadcast. Copies of a text share a fingerprint: they scale the sum
    but not its sign. Null texts take no part in the join.
    """
    # Written out first, so that Spark knows its size when it picks the join.
    weights = materialize(lexicon_units(lexicon), "lexicon")
    known = df.where(F.col(text).isNotNull())
    # The text itself is not carried through the join unless someone asks for it.
    fingerprint = F.unhex(F.sha2(F.col(text), 256))
    totals = (
        # Hashed before the explode: once per text, not once per token. The
        # outer explode keeps Spark from tokenising again to test for empty
        # lists; the null words it gives find no partner in the join.
        known.select(fingerprint.alias("_fingerprint"), tokens(F.col(text), negators).alias("_tokens"))
        .select("_fingerprint", F.explode_outer("_tokens").alias("word"))
        .join(weights, "word")
        .groupBy("_fingerprint")
        .agg(F.sum("units").alias("_units"))
    )
    labelled = (
        known.withColumn("_fingerprint", fingerprint)
        .join(totals, "_fingerprint", "left")
        .withColumn(label, label_of(F.coalesce("_units", F.lit(0))))
        .drop("_fingerprint", "_units")
    )
    unknown = df.where(F.col(text).isNull()).withColumn(label, F.lit(None).cast("string"))
    return labelled.unionByName(unknown)


def label_by_lookup(
    df: DataFrame,
    lexicon: DataFrame,
    text: str = "text",
    label: str = "sentiment",
    negators: Collection[str] = (),
) -> DataFrame:
    """Label texts row by row against a lexicon of any size; works on streams.

    Every executor holds the lexicon once, so its size is bounded by a
    vocabulary, never by the texts: more than LOOKUP_WORDS words raise ValueError, for
    which ``label_by_join`` is the way. Tokens come from the JVM and are looked up
    a batch at a time.
    """
    spark = df.sparkSession
    table = lexicon_units(lexicon).limit(LOOKUP_WORDS + 1).toPandas()
    if len(table) > LOOKUP_WORDS:
        raise ValueError(f"more than {LOOKUP_WORDS} words; join them with label_by_join")
    shared = spark.sparkContext.broadcast(
        (table["word"].tolist(), table["units"].to_numpy(np.int64))
    )
    ready: list = []

    @F.pandas_udf("bigint")
    def total(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if not ready:
            words, units = shared.value
            ready.extend((pa.array(words, pa.string()), np.append(units, 0)))
        for batch in batches:
            lists = pa.array(batch, pa.list_(pa.string()))
            # A word that is not found points at the 0 at the end.
            places = pc.index_in(lists.flatten(), value_set=ready[0])
            found = ready[1][pc.fill_null(places, -1).to_numpy(zero_copy_only=False)]
            sums = np.concatenate([[0], np.cumsum(found)])
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            yield pd.Series(sums[ends] - sums[ends - lengths])

    units = total(F.coalesce(tokens(F.col(text), negators), F.array().cast("array<string>")))
    return df.withColumn(label, F.when(F.col(text).isNotNull(), label_of(units)))


def label_by_scorer(
    df: DataFrame,
    scorer: Callable[[str], float],
    text: str = "text",
    label: str = "sentiment",
) -> DataFrame:
    """Label texts by the sign of ``scorer(text)``, any Python polarity function."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(scorer, na_action="ignore").astype("float64")

    return df.withColumn(label, label_of(score(F.col(text))))


def label_sentiment(
    df: DataFrame,
    lexicon: DataFrame | Mapping[str, float] | None = None,
    scorer: Callable[[str], float] | None = None,
    text: str = "text",
    label: str = "sentiment",
    negators: Collection[str] = (),
) -> DataFrame:
    """Add the sentiment label by the cheapest way that fits the lexicon.

    A word right after one of the ``negators`` counts with the opposite weight.
    """
    if scorer is not None:
        return label_by_scorer(df, scorer, text, label)
    if lexicon is None:
        raise ValueError("give a lexicon or a scorer")
    plain = isinstance(lexicon, Mapping) and not negators
    table = lexicon_table(df.sparkSession, lexicon)
    if negators:
        table = with_negated(table)
    weights = literal_weights(df.sparkSession, lexicon if plain else table)
    if weights is not None:
        return df.withColumn(label, sentiment(F.col(text), weights, negators))
    way = label_by_lookup if df.isStreaming else label_by_join
    return way(df, table, text, label, negators)
