"""Lexicon sentiment with phrases and degree words.

Entries are phrases of one to LONGEST words with a weight, and degree words with a
factor ("very", "hardly"). A text is read from the left; at each place the longest
phrase counts, and the next one is looked for behind it. A degree word right before a
phrase multiplies its weight. The label is the sign of the sum.

Phrases are found by a join on word n-grams, so the lexicon may have any size, and only
what matches is gathered per text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.text import UNITS, label_of, tokens
from reviewmill.session import materialize

LONGEST = 4
# Factors are whole thousandths, so sums do not depend on the order of addition.
FACTOR_UNITS = 1000


def phrase_entries(lexicon: DataFrame) -> DataFrame:
    """(phrase, words, units, factor) from rows of phrase, weight and factor.

    Phrases are split into words like texts; equal ones take their mean. ``factor`` is
    null for phrases; a row with a factor is a degree word, and its weight does not count.
    """
    words = tokens(F.col("phrase"))
    rows = lexicon.select(
        F.array_join(words, " ").alias("phrase"), F.size(words).alias("words"), "weight", "factor"
    )
    return (
        rows.where(F.col("words").between(1, LONGEST))
        .groupBy("phrase", "words")
        .agg(
            F.round(F.avg(F.when(F.col("factor").isNull(), F.col("weight"))) * UNITS).cast("bigint").alias("units"),
            F.round(F.avg("factor") * FACTOR_UNITS).cast("bigint").alias("factor"),
        )
    )


def _grams(words: Column) -> Column:
    """(place, phrase) of every run of one to LONGEST words."""

    def at(count: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - count + 1)
        each = F.transform(
            starts,
            lambda i: F.struct(i.alias("place"), F.array_join(F.slice(words, i, count), " ").alias("phrase")),
        )
        none = F.array().cast("array<struct<place: int, phrase: string>>")
        return F.when(F.size(words) >= count, each).otherwise(none)

    return F.concat(*(at(count) for count in range(1, LONGEST + 1)))


def _total(found: Column) -> Column:
    """The sum over one text's matches, in order of place, the longest first."""
    zero = F.lit(0).cast("bigint")
    start = F.struct(
        F.lit(0).alias("end"), F.lit(-1).alias("degree_at"), zero.alias("factor"), zero.alias("total")
    )

    def step(acc: Column, m: Column) -> Column:
        free = m["place"] >= acc["end"]
        counts = free & m["units"].isNotNull()
        degree = free & m["units"].isNull()
        times = F.when(acc["degree_at"] == m["place"], acc["factor"]).otherwise(F.lit(FACTOR_UNITS))
        return F.struct(
            F.when(counts, m["place"] + m["words"]).otherwise(acc["end"]).alias("end"),
            F.when(degree, m["place"] + 1).otherwise(acc["degree_at"]).alias("degree_at"),
            F.when(degree, m["factor"]).otherwise(acc["factor"]).cast("bigint").alias("factor"),
            (acc["total"] + F.when(counts, m["units"] * times).otherwise(zero)).alias("total"),
        )

    return F.aggregate(found, start, step, lambda acc: acc["total"])


def label_by_phrases(
    df: DataFrame, lexicon: DataFrame, text: str = "text", label: str = "sentiment"
) -> DataFrame:
    """Add the label of each text by phrases and degree words (batch).

    An entry that is both a phrase and a degree word counts as a phrase. Null texts get a
    null label, texts without a match the neutral one. Texts are told by a fingerprint, so
    copies are scored once and no text is shuffled while the lexicon is small enough
    for Spark to broadcast; what is gathered per text are its own matches.
    """
    entries = materialize(phrase_entries(lexicon), "phrases")
    known = df.where(F.col(text).isNotNull())
    fingerprint = F.unhex(F.sha2(F.col(text), 256))
    words = known.select(fingerprint.alias("_fingerprint"), tokens(F.col(text)).alias("_words"))
    grams = words.select("_fingerprint", F.inline(_grams(F.col("_words"))))
    match = F.struct("place", (-F.col("words")).alias("order"), "words", "units", "factor")
    matches = (
        grams.join(entries, "phrase")
        # Copies of a text match alike.
        .groupBy("_fingerprint", "place", "words", "units", "factor")
        .agg(F.count("*").alias("_copies"))
        .groupBy("_fingerprint")
        .agg(F.sort_array(F.collect_list(match)).alias("_found"))
    )
    totals = matches.select("_fingerprint", _total(F.col("_found")).alias("_units"))
    labelled = (
        known.withColumn("_fingerprint", fingerprint)
        .join(totals, "_fingerprint", "left")
        .withColumn(label, label_of(F.coalesce("_units", F.lit(0))))
        .drop("_fingerprint", "_units")
    )
    unknown = df.where(F.col(text).isNull()).withColumn(label, F.lit(None).cast("string"))
    return labelled.unionByName(unknown)
