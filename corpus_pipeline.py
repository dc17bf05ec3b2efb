"""A training corpus from raw documents, in five stages of one operator each.

Stages up to the last return the columns of ``documents``. Each works on all
that its predecessor kept, written to the shared folder in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewmill.llm.exact_copies import keep_exact
from reviewmill.llm.mixing import take_mix
from reviewmill.llm.near_copies import keep_near
from reviewmill.llm.packing import pack
from reviewmill.llm.quality import judge_quality
from reviewmill.llm.queries import ENTROPY_SHARE, MAX_REPEATS, vocabulary
from reviewmill.llm.shipping import ship_package
from reviewmill.session import bound_batches, materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site-aware classifier does not reject."""
    ship_package(spark)
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge_quality(docs, labels).filter("kept").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest as written."""
    return keep_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more."""
    ship_package(spark)
    bound_batches(spark)
    return keep_near(docs, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix has them, for as many tokens as there were."""
    return take_mix(docs, entropy_share=ENTROPY_SHARE, max_repeats=MAX_REPEATS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    ship_package(spark)
    bound_batches(spark)
    return pack(docs, vocabulary("byte_bpe_50k.json"), space_led=True, end_id=2, size=1024)


STAGES = [
    ("quality", quality),
    ("exact", exact),
    ("near", near),
    ("mix", mix),
    ("packing", packing),
]

# The classifier, the sketches and the tokenizer are beyond SQL; see
# tests/llm/test_pipeline.py for a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
