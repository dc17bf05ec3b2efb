"""Times the ways to label texts, and one row UDF, on many copies of the test reviews.

    python trials/scoring.py [copies] [lexicon words]

Reads BENCH_SF_DIR (default: sf0.1). Prints one line per way: seconds, the second run.
"""

from __future__ import annotations

import os
import re
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reviewmill.functions import text as T  # noqa: E402
from reviewmill.plans.fixtures import LEXICON, read_fixture  # noqa: E402
from reviewmill.session import SETTINGS, materialize  # noqa: E402


def main() -> None:
    copies, words = (int(x) for x in (sys.argv[1:] + ["10", "2000"])[:2])
    builder = SparkSession.builder.master("local[*]").appName("scoring").config("spark.driver.memory", "6g")
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    reviews = read_fixture(spark, sf_dir, "review").select("review_id", "text")
    copied = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")
    many = reviews.select("review_id", "text", copied).repartition(32)
    many = materialize(many.select("review_id", "text"), "trial")
    # Words of the texts themselves, so that many tokens are found.
    found = many.sample(0.01, 1).select(F.explode(T.tokens(F.col("text"))).alias("w")).distinct()
    lexicon = {r.w: (len(r.w) % 7 - 3) / 4 for r in found.orderBy(F.xxhash64("w")).limit(words).collect()}
    lexicon |= LEXICON
    table = T.lexicon_table(spark, lexicon)
    units = {w: round(v * T.UNITS) for w, v in lexicon.items()}
    pattern = re.compile(r"[^\W\d_]+")

    @F.udf("string")
    def row_udf(text):
        if text is None:
            return None
        total = sum(units.get(w, 0) for w in pattern.findall(text.lower()))
        return T.POSITIVE if total > 0 else T.NEGATIVE if total < 0 else T.NEUTRAL

    weights = T.literal_weights(spark, table)
    ways = {
        "expression": lambda: many.withColumn("sentiment", T.sentiment(F.col("text"), weights)),
        "lookup": lambda: T.label_by_lookup(many, table),
        "join": lambda: T.label_by_join(many, table),
        "row UDF": lambda: many.withColumn("sentiment", row_udf("text")),
    }
    for name, way in ways.items():
        for _ in range(2):
            start = time.perf_counter()
            counts = way().groupBy("sentiment").count().collect()
            took = time.perf_counter() - start
        print(f"{name}: {took:.2f} s", sorted((str(r[0]), r[1]) for r in counts), flush=True)


if __name__ == "__main__":
    main()
