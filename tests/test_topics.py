import json

import pytest
from pyspark.sql import functions as F

from reviewmill.schemas import RECORDS, record_schema, topic_name
from reviewmill.plans.fixtures import read_fixture
from reviewmill.sources.tables import limited_export, list_tables, read_records
from reviewmill.sources.topics import (
    encode_records,
    kafka_options,
    parse_records,
    publish_to_files,
    topic_folder,
)

GOOD = {
    "review_id": "r1", "business_id": "b1", "user_id": "u1", "stars": 4.0,
    "text": "fine", "date": "2018-01-02 03:04:05",
}


def topic(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return df.select(F.col("value").cast("binary").alias("value"))


def parse(spark, *values, **options):
    parsed = parse_records(topic(spark, values), "review", **options)
    return [r.asDict() for r in parsed.collect()]


def test_good_record_and_extra_fields(spark):
    assert parse(spark, json.dumps(GOOD), json.dumps({**GOOD, "_id": "x", "more": [1]})) == [
        GOOD,
        GOOD,
    ]


def test_missing_and_wrong_typed_fields_are_null_alone(spark):
    missing = {k: v for k, v in GOOD.items() if k != "user_id"}
    assert parse(spark, json.dumps(missing), json.dumps({**GOOD, "stars": "4.0"})) == [
        {**GOOD, "user_id": None},
        {**GOOD, "stars": None},
    ]
    business = json.dumps({"business_id": "b", "review_count": 1.5, "stars": 3.5})
    row = parse_records(topic(spark, [business]), "business").first()
    assert (row.business_id, row.review_count, row.stars) == ("b", None, 3.5)


def test_malformed_text_is_a_row_of_nulls(spark):
    nulls = dict.fromkeys(GOOD)
    assert parse(spark, "not json", "", json.dumps(GOOD)) == [nulls, nulls, GOOD]
    assert parse(spark, "not json", "", "{}", json.dumps(GOOD), drop_malformed=True) == [GOOD]


def test_encoding_keeps_nulls_and_writes_the_id_as_text(spark):
    df = spark.createDataFrame([(7, "a", None)], "_id int, name string, note string")
    assert json.loads(encode_records(df).first().value) == {"_id": "7", "name": "a", "note": None}
    binary = spark.createDataFrame([(bytearray(b"\x5a\xff"),)], "_id binary")
    assert json.loads(encode_records(binary).first().value) == {"_id": "5aff"}


@pytest.mark.parametrize("record_type", sorted(RECORDS))
def test_round_trip(spark, sf_dir, rows, record_type):
    records = read_fixture(spark, sf_dir, record_type)
    assert rows(parse_records(encode_records(records), record_type)) == rows(records)


def test_text_with_line_ends_stays_one_record(spark, tmp_path):
    text = "a\nb\r\nc d \"q\" \\ é"
    df = spark.createDataFrame([(text,)], "text string")
    publish_to_files(df, str(tmp_path), "p", "review")
    lines = spark.read.option("lineSep", "\n").text(topic_folder(str(tmp_path), "p", "review"))
    assert [json.loads(r.value)["text"] for r in lines.collect()] == [text]


def test_topic_names_and_kafka_options():
    assert topic_name("app", "business") == "app-businesses"
    assert topic_name("app", "tip") == "app-tip"
    assert kafka_options("h:1", "app-tip", maxOffsetsPerTrigger="5") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "app-tip",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5",
    }


def test_limited_export(spark):
    df = spark.range(250).select(F.col("id").cast("string").alias("k"))
    assert limited_export(df, "k", 100).count() == 100
    assert [r.k for r in limited_export(df, "k", 2).collect()] == ["0", "1"]
    assert limited_export(df, ["k"], None).count() == 250


def test_read_records_and_list_tables(spark, sf_dir, rows, tmp_path):
    tips = read_fixture(spark, sf_dir, "tip")
    tips.write.json(str(tmp_path / "tip"))
    assert rows(read_records(spark, str(tmp_path), "tip", "json")) == rows(tips)
    assert read_records(spark, str(tmp_path), "tip", "json").schema == record_schema("tip")
    tips.createOrReplaceTempView("tips_for_listing")
    assert "tips_for_listing" in list_tables(spark)
