"""Message topics: Kafka, or a directory that stands for one.

The directory holds Parquet files with a ``value`` column, so that a message keeps its line breaks
and a missing one stays null.

The Kafka branch needs the connector package of the running Spark version on the class path.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import scratch

MESSAGE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def kafka_source_options(servers: str, topic: str, starting_offsets: str = "earliest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }


def kafka_sink_options(servers: str, topic: str, compression: str = "lz4") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.compression.type": compression,
    }


def read_topic(
    spark: SparkSession,
    *,
    path: str | None = None,
    kafka: Mapping[str, str] | None = None,
    stream: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Messages of a topic, as a stream or (``stream=False``) as a table; ``value`` holds the message."""
    if (path is None) == (kafka is None):
        raise ValueError("give either path or kafka")
    reader = spark.readStream if stream else spark.read
    if kafka is not None:
        return reader.format("kafka").options(**kafka).load()
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.schema(MESSAGE_SCHEMA).parquet(path)


def as_json(rows: DataFrame) -> DataFrame:
    """Each row as one JSON message; null fields are written as null."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def publish(
    messages: DataFrame, *, path: str | None = None, kafka: Mapping[str, str] | None = None, files: int | None = None
) -> None:
    """Append messages (column ``value``) to a topic, from all executors at once.

    With ``files`` a directory gets exactly so many, of about equal size, however few the messages are: a stream that
    takes so many per trigger then has one delivery per micro-batch.
    """
    if (path is None) == (kafka is None):
        raise ValueError("give either path or kafka")
    value = messages.select("value")
    if kafka is not None:
        value.write.format("kafka").options(**kafka).save()
        return
    value = value.select(F.col("value").cast("string"))
    if files is None:
        value.write.mode("append").parquet(path)
        return
    spark = messages.sparkSession
    before = len(_files(spark, path))
    value.repartition(files).write.mode("append").parquet(path)
    # A task without messages leaves no file.
    for _ in range(files - (len(_files(spark, path)) - before)):
        spark.createDataFrame([], MESSAGE_SCHEMA).write.mode("append").parquet(path)


def _files(spark: SparkSession, path: str) -> list[str]:
    return [name for name in scratch.children(spark, path) if not name.startswith(("_", "."))]
