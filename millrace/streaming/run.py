"""Run streaming transforms: drain what is available, keep positions, hand back a table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.sources import scratch



def start(
    result: DataFrame,
    sink: str,
    mode: str,
    *,
    path: str | None = None,
    name: str | None = None,
    checkpoint: str | None = None,
    drain: bool = True,
    keep: int = 2,
) -> StreamingQuery:
    """Start a streaming query.

    ``drain`` processes what is available and stops; otherwise micro-batches go on until the
    query is stopped. State store and number of state partitions are those of the session
    (``millrace.session``, ``spark.sql.shuffle.partitions``); a checkpoint keeps the number it began with.

    Sinks: ``memory`` (a named table on the driver, for small results), ``console``, any file
    format in append mode, and ``results``, which writes each complete result to its own folder and
    drops all but the last ``keep``: a result that was handed out is readable for so many batches.
    """
    spark = result.sparkSession
    writer = result.writeStream.outputMode(mode)
    if name:
        writer = writer.queryName(name)
    if sink == "results":
        writer = writer.foreachBatch(lambda rows, batch: _keep_result(rows, batch, path, keep))
    else:
        writer = writer.format(sink)
        if path:
            writer = writer.option("path", path)
        if sink == "console":
            writer = writer.option("truncate", False)
    writer = writer.option("checkpointLocation", checkpoint or scratch.new_path(spark, "checkpoint"))
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batch folders below a path; other entries are none of ours."""
    return [int(name) for name in scratch.children(spark, path) if name.isdecimal()]


def _keep_result(rows: DataFrame, batch: int, path: str, keep: int) -> None:
    """One folder per micro-batch: a repeated batch overwrites its own, older ones are dropped."""
    rows.write.mode("overwrite").parquet(f"{path}/{batch}")
    for old in _batches(rows.sparkSession, path):
        if old <= batch - keep:
            scratch.remove(rows.sparkSession, f"{path}/{old}")


def batches(query: StreamingQuery) -> DataFrame:
    """``batch``, ``messages`` read and ``late`` groups dropped of the batches that the query still remembers.

    Late rows of one group and batch are one group: they are added up before they meet the state. A session
    remembers ``spark.sql.streaming.numRecentProgressUpdates`` batches.
    """
    seen = {
        p.batchId: (p.batchId, p.numInputRows, sum(s.numRowsDroppedByWatermark for s in p.stateOperators))
        for p in query.recentProgress
    }
    return SparkSession.active().createDataFrame(list(seen.values()), "batch long, messages long, late long")


def finish(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for a draining query; one that is not done in time is stopped and reported."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout} s")


def run_to_memory(result: DataFrame, mode: str = "complete", timeout: float | None = None) -> DataFrame:
    """Drain into a driver-side table. Only for results of bounded size: totals and top-k lists."""
    name = f"result_{uuid.uuid4().hex}"
    finish(start(result, "memory", mode, name=name), timeout)
    return result.sparkSession.table(name)


def run_to_results(
    result: DataFrame,
    path: str | None = None,
    checkpoint: str | None = None,
    timeout: float | None = None,
    keep: int = 2,
) -> DataFrame:
    """Drain an aggregate in complete mode into shared storage and read the last full result.

    The files of the last ``keep`` results stay, so that one handed out earlier outlives later runs.
    """
    spark = result.sparkSession
    path = path or scratch.new_path(spark, "results")
    finish(start(result, "results", "complete", path=path, checkpoint=checkpoint, keep=keep), timeout)
    done = [b for b in _batches(spark, path) if "_SUCCESS" in scratch.children(spark, f"{path}/{b}")]
    if not done:
        # No batch ran: the source was empty.
        return spark.createDataFrame([], result.schema)
    return spark.read.schema(result.schema).parquet(f"{path}/{max(done)}")


def run_to_files(
    rows: DataFrame,
    path: str | None = None,
    checkpoint: str | None = None,
    file_format: str = "parquet",
    timeout: float | None = None,
) -> DataFrame:
    """Drain in append mode into files, each row once, and read all of them.

    Called again with the same path and checkpoint it reads only new input and appends.
    """
    spark = rows.sparkSession
    path = path or scratch.new_path(spark, "rows")
    finish(start(rows, file_format, "append", path=path, checkpoint=checkpoint), timeout)
    if not scratch.children(spark, path):
        return spark.createDataFrame([], rows.schema)
    return spark.read.schema(rows.schema).format(file_format).load(path)
