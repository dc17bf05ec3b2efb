"""Shape of the physical plans: what is shuffled, broadcast, sorted and read."""

import re

import pytest
from pyspark.sql import functions as F

from reviewmill.functions.text import label_by_join
from reviewmill.operators.ranking import first_per_key, highest
from reviewmill.plans import registry
from reviewmill.plans.tables import RESULT_TABLES
from reviewmill.plans.fixtures import LEXICON, read_fixture

QUERIES = registry.queries()
BATCH = sorted(
    n for n in QUERIES if not n.startswith(("stream_", "refresh_")) and "predictions" not in n
)
TOP_K = [n for n in BATCH if re.search("top_positive|top_negative|_top$|_bottom$|_worst$", n)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Sizes as they are at scale: nothing fits under the broadcast threshold."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python_in_the_plan(spark, sf_dir, no_broadcast, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


@pytest.mark.parametrize("name", TOP_K)
def test_top_lists_never_sort_globally(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


@pytest.mark.parametrize(
    "name", ["popularity_aggregation", "sentiment_aggregation", "category_distribution"]
)
def test_aggregates_combine_before_the_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    above, below = text.split("Exchange hashpartitioning", 1)
    assert "HashAggregate" in above and "partial_" in below


def test_sentiment_is_computed_once_per_text(spark, sf_dir):
    text = plan(QUERIES["sentiment_aggregation"](spark, sf_dir))
    assert text.count("regexp_extract_all") == 1


def test_join_labels_tokenise_once_and_do_not_carry_the_text(spark, sf_dir):
    reviews = read_fixture(spark, sf_dir, "review").select("review_id", "text")
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, weight double")
    text = plan(label_by_join(reviews, lexicon).select("review_id", "sentiment"))
    # Null texts come past the join, in the other branch of a union.
    assert text.count("regexp_extract_all") == 1
    shuffled = [line for line in text.split("\n") if "Exchange hashpartitioning" in line]
    assert len(shuffled) == 2 and all("fingerprint" in line for line in shuffled)


def test_names_join_without_another_shuffle(spark, sf_dir, no_broadcast):
    """Both sides are aggregated on business_id and join where they are."""
    text = plan(QUERIES["popularity_top"](spark, sf_dir))
    assert "SortMergeJoin" in text
    assert text.count("Exchange hashpartitioning") == 2


def test_first_per_key_cuts_down_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text = plan(first_per_key(df.repartition(4), ["k"], [highest("v")]))
    above, below = text.split("Exchange hashpartitioning", 1)
    assert "Final" in above and "WindowGroupLimit" in below and "Partial" in below


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("popularity_aggregation", "props"),
        ("city_wise_business_count", "p_partkey,p_brand"),
        ("business_lookup", "p_partkey,p_name"),
        ("users_top", "c_custkey,c_name"),
    ],
)
def test_scans_read_only_what_they_need(spark, sf_dir, name, columns):
    text = plan(QUERIES[name](spark, sf_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any(",".join(c.split(":")[0] for c in s.split(",")) == columns for s in schemas)


def test_hot_key_costs_one_row_per_task(spark):
    """A third of all rows on one key: each task ships one partial row for it."""
    hot = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("business_id"),
        F.lit(None).cast("string").alias("date"),
    )
    table = RESULT_TABLES["popularity_aggregation"].build(hot.repartition(6))
    assert table.where("business_id = 'hot'").first()["count"] == 100_000
    metrics = {}

    def walk(node):
        if node.nodeName().startswith("Exchange") and "business_id" in node.toString().split("\n")[0]:
            metrics["rows"] = node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    frame = table.where("business_id = 'hot'")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = frame.select("*")
        frame.collect()
        walk(frame._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert metrics["rows"] <= 6


def test_contained_operators_leave_their_result_only(spark):
    import os

    from reviewmill.session import contained, materialize, scratch_root

    def left():
        return {f.split("-")[0] for f in os.listdir(scratch_root(spark)) if f.startswith("contained")}

    @contained("containedresult")
    def build(fail):
        inner = materialize(materialize(spark.range(5), "containedstep"), "containedstep")
        if fail:
            raise ValueError("no result")
        return inner.where("id > 1")

    with pytest.raises(ValueError):
        build(True)
    assert left() == set()
    found = build(False)
    assert left() == {"containedresult"} and found.count() == 3
    materialize(spark.range(1), "containedlater")
    assert left() == {"containedresult", "containedlater"}
