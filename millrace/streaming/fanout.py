"""Many answers from one reading of a stream.

Each micro-batch is read once, kept, and handed to several answers, which work side by side. An answer stores what
it makes of a batch under the batch's number, so a batch that is repeated after a failure changes nothing. Answers
and positions of the stream lie below one folder: they are only of use together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.sources import scratch
from millrace.streaming.heavy import Heavy
from millrace.streaming.totals import Totals


@dataclass(frozen=True)
class Kept:
    """Totals of a stream: ``partial`` makes partial sums of a batch, ``merges`` says how these merge."""

    partial: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    merges: Mapping[str, str]
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows
    buckets: int = 16

    def table(self, path: str) -> Totals:
        return Totals(path, self.keys, dict(self.merges), self.buckets)

    def take(self, rows: DataFrame, batch: int, path: str) -> None:
        self.table(path).merge(self.partial(rows), batch)

    def read(self, spark: SparkSession, path: str, rows: T.StructType) -> DataFrame:
        schema = self.partial(spark.createDataFrame([], rows)).select(*self.keys, *self.merges).schema
        return self.finish(self.table(path).read(spark, schema))


@dataclass(frozen=True)
class Appended:
    """Rows of a stream, changed one by one by ``transform`` and written per batch."""

    transform: Callable[[DataFrame], DataFrame]

    def take(self, rows: DataFrame, batch: int, path: str) -> None:
        self.transform(rows).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    def read(self, spark: SparkSession, path: str, rows: T.StructType) -> DataFrame:
        schema = self.transform(spark.createDataFrame([], rows)).schema
        whole = [name for name in scratch.children(spark, path) if "_SUCCESS" in scratch.children(spark, f"{path}/{name}")]
        return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in whole]) if whole else spark.createDataFrame([], schema)


Answer = Kept | Appended | Heavy


def start(stream: DataFrame, answers: Mapping[str, Answer], path: str, drain: bool = True) -> StreamingQuery:
    """Start a query that gives every micro-batch of ``stream`` to all answers; see ``read`` for their tables."""

    def take(rows: DataFrame, batch: int) -> None:
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        rows.count()  # read now, before the answers would all read at once
        run = inheritable_thread_target(rows.sparkSession)(lambda name: answers[name].take(rows, batch, f"{path}/{name}"))
        try:
            with ThreadPoolExecutor(len(answers)) as pool:
                list(pool.map(run, answers))
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{path}/checkpoint")
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def drain(stream: DataFrame, answers: Mapping[str, Answer], path: str) -> dict[str, DataFrame]:
    """Give all answers what the stream has by now, and read them."""
    start(stream, answers, path).awaitTermination()
    return read(stream.sparkSession, answers, path, stream.schema)


def read(spark: SparkSession, answers: Mapping[str, Answer], path: str, rows: T.StructType) -> dict[str, DataFrame]:
    """What the answers hold by now; ``rows`` is the schema of the stream."""
    return {name: answer.read(spark, f"{path}/{name}", rows) for name, answer in answers.items()}
