import duckdb
import pytest
from pyspark.sql import functions as F

from reviewmill.llm.shipping import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def docs(spark):
    """A documents table from texts, or (id, text) pairs, over three partitions."""

    def build(texts, source=lambda i: f"s{i % 2}"):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        values = [(i, t, "en", source(n), len(t or "")) for n, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(values, DOCS).repartition(3)

    return build


@pytest.fixture
def crowded(docs):
    """The same rows with columns that clash with names the operators use."""

    def build(texts):
        frame = docs(texts)
        for name in ("hash", "kept", "size", "key", "value", "part", "rank", "block", "count", "component_id"):
            frame = frame.withColumn(name, F.lit("x"))
        return frame

    return build


@pytest.fixture(scope="session")
def prose(sf_dir):
    """Whole texts of the small test data."""
    return duckdb.sql(
        f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id"
    ).fetchall()
