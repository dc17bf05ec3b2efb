"""Topics: JSON records as bytes, on Kafka or in folders of text files.

Both kinds of topic give a frame with a binary ``value`` column, so everything
after the read is the same. The Kafka functions need the Kafka connector
package on the class path of the session.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.schemas import record_schema, topic_name

ID_FIELD = "_id"


def encode_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON object in UTF-8 bytes; null fields are kept.

    The document id, where there is one, is written as text.
    """
    if ID_FIELD in df.columns:
        ident = F.col(ID_FIELD)
        if isinstance(df.schema[ID_FIELD].dataType, T.BinaryType):
            ident = F.lower(F.hex(ident))
        df = df.withColumn(ID_FIELD, ident.cast("string"))
    record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(record.cast("binary").alias("value"))


def parse_records(
    topic: DataFrame,
    record_type: str,
    drop_malformed: bool = False,
    identity: str | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Decode the ``value`` column into the columns of the record type.

    Text that is no JSON object gives a row of nulls; ``drop_malformed``
    leaves out rows without any field. ``identity`` names a further column that
    tells records apart by their bytes, parsed or not. ``columns`` are the only
    ones to be parsed: Spark prunes the parser by itself only for single uses.
    """
    schema = record_schema(record_type)
    if columns is not None:
        schema = T.StructType([schema[name] for name in columns])
    record = F.from_json(F.col("value").cast("string"), schema).alias("record")
    extra = [F.sha2("value", 256).alias(identity)] if identity else []
    parsed = topic.select(record, *extra).select("record.*", *([identity] if identity else []))
    if not drop_malformed:
        return parsed
    some_field = [F.col(name).isNotNull() for name in schema.names]
    return parsed.where(reduce(lambda a, b: a | b, some_field))


def publish_to_kafka(df: DataFrame, servers: str, prefix: str, record_type: str) -> None:
    (
        encode_records(df)
        .withColumn("topic", F.lit(topic_name(prefix, record_type)))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )


def kafka_options(servers: str, topic: str, **options: str) -> dict[str, str]:
    """Options of a topic read from its earliest offset.

    Pass ``maxOffsetsPerTrigger`` to bound a micro-batch and
    ``minPartitions`` to split topics with few partitions over more tasks.
    """
    base = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    return {**base, **options}


def subscribe_to_kafka(
    spark: SparkSession, servers: str, prefix: str, record_type: str, **options: str
) -> DataFrame:
    chosen = kafka_options(servers, topic_name(prefix, record_type), **options)
    return spark.readStream.format("kafka").options(**chosen).load()


def topic_folder(root: str, prefix: str, record_type: str) -> str:
    return f"{root.rstrip('/')}/{topic_name(prefix, record_type)}"


def publish_to_files(df: DataFrame, root: str, prefix: str, record_type: str) -> None:
    """Append the records to the topic's folder, one JSON object per line."""
    lines = encode_records(df).select(F.col("value").cast("string").alias("value"))
    path = topic_folder(root, prefix, record_type)
    lines.write.mode("append").option("lineSep", "\n").text(path)


def subscribe_to_files(
    spark: SparkSession, root: str, prefix: str, record_type: str, **options: str
) -> DataFrame:
    """Stream the topic's folder; bound a micro-batch with ``maxFilesPerTrigger``."""
    lines = (
        spark.readStream.format("text")
        .option("lineSep", "\n")
        .options(**options)
        .load(topic_folder(root, prefix, record_type))
    )
    return lines.select(F.col("value").cast("binary").alias("value"))
