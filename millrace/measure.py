"""What queries moved, from Spark's event log read as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields used of the log's events; each line is one event.
EVENT = """Event string, `Job ID` long, `Stage ID` long, `Stage IDs` array<long>, Properties map<string, string>,
    `Task Metrics` struct<`Executor CPU Time`: long,
        `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: long, `Shuffle Records Written`: long>>"""

# Settings that a session needs before it starts.
LOGGED = {
    "spark.eventLog.enabled": "true",
    "spark.eventLog.rolling.enabled": "false",
    "spark.eventLog.compress": "false",
    "spark.eventLog.buffer.kb": "16",
}


def shuffles(spark: SparkSession, log: str) -> DataFrame:
    """Per job description: ``shuffles`` (stages that wrote some), ``shuffle_bytes``, ``shuffle_rows`` and ``cpu_ns``.

    A stage that several jobs list counts for the first, which ran it. Jobs without a description are left out.
    """
    events = spark.read.schema(EVENT).json(log)
    label = F.col("Properties")["spark.job.description"]
    jobs = events.where("Event = 'SparkListenerJobStart'").select(
        label.alias("label"), F.col("Job ID").alias("job"), F.explode("Stage IDs").alias("stage")
    )
    owners = jobs.groupBy("stage").agg(F.min_by("label", "job").alias("label")).where("label is not null")
    written = F.col("Task Metrics")["Shuffle Write Metrics"]
    stages = (
        events.where("Event = 'SparkListenerTaskEnd'")
        .groupBy(F.col("Stage ID").alias("stage"))
        .agg(
            F.sum(written["Shuffle Bytes Written"]).alias("bytes"),
            F.sum(written["Shuffle Records Written"]).alias("rows"),
            F.sum(F.col("Task Metrics")["Executor CPU Time"]).alias("cpu"),
        )
    )
    return stages.join(owners, "stage").groupBy("label").agg(
        F.count_if(F.col("bytes") > 0).alias("shuffles"),
        F.sum("bytes").alias("shuffle_bytes"),
        F.sum("rows").alias("shuffle_rows"),
        F.sum("cpu").alias("cpu_ns"),
    )
