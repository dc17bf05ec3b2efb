import pytest
from pyspark.sql import functions as F

from reviewmill.plans import registry
from reviewmill.sources.topics import topic_folder


def counts(spark, topics):
    """Records in each file of the review topic."""
    lines = spark.read.text(topic_folder(topics.base, registry.PREFIX, "review"))
    return [n for _, n in lines.groupBy(F.input_file_name()).count().collect()]


@pytest.fixture
def reviews(spark, sf_dir):
    return registry.read_fixture(spark, sf_dir, "review").repartition(12)


def test_no_task_publishes_more_than_its_part_of_the_input(spark, sf_dir, reviews):
    total = reviews.count()
    topics = registry._Topics(spark, sf_dir, "publish")
    topics.publish("review", reviews)
    found = counts(spark, topics)
    assert sum(found) == total and len(found) == 12 and max(found) <= total / 12 + 12
    assert topics.limit == {"maxFilesPerTrigger": "4"}


def test_a_batch_is_written_where_it_is_read(spark, sf_dir, reviews):
    topics = registry._Topics(spark, sf_dir, "publish-batch")
    topics.publish_batch("review", reviews)
    found = counts(spark, topics)
    assert sum(found) == reviews.count() and len(found) == 12


@pytest.mark.parametrize("name", ["stream_dedup_long", "stream_review_daily", "stream_shared_trend"])
def test_queries_publish_by_several_tasks(spark, sf_dir, monkeypatch, name):
    """Over an input of several parts, and as many micro-batches as before."""
    seen = []
    publish, subscribe = registry.publish_to_files, registry.subscribe_to_files

    def counted(frame, *rest):
        seen.append(frame.rdd.getNumPartitions())
        publish(frame, *rest)

    def limited(*rest, **options):
        seen.append(options)
        return subscribe(*rest, **options)

    fixture = registry.read_fixture
    monkeypatch.setattr(registry, "read_fixture", lambda s, d, t: fixture(s, d, t).repartition(6))
    monkeypatch.setattr(registry, "publish_to_files", counted)
    monkeypatch.setattr(registry, "subscribe_to_files", limited)
    registry.queries()[name](spark, sf_dir)
    assert {x for x in seen if isinstance(x, int)} == {6}
    whole = name != "stream_shared_trend"
    assert all(x == ({} if whole else {"maxFilesPerTrigger": "2"}) for x in seen if isinstance(x, dict))
