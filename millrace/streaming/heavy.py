"""The most frequent keys of an endless stream, in a state of fixed size and with a known error.

Counters of the heaviest keys are kept from batch to batch. A batch's exact counts are added; if there are then more
than ``counters`` keys, the count of the next one is taken off all, and keys left with nothing go. Every
such cut takes its amount from ``counters + 1`` keys at least, so what a key may lack in all is at most the
number of rows read divided by ``counters + 1``. It is kept beside the counters as ``missed``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import scratch


@dataclass(frozen=True)
class Heavy:
    """An answer for ``fanout``: ``counts`` gives the ``keys`` of a batch with ``n``, how often they occur."""

    counts: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    counters: int = 1000
    keep: int = 2

    def _done(self, spark: SparkSession, path: str) -> list[int]:
        found = sorted(int(name) for name in scratch.children(spark, path) if name.isdecimal())
        return [b for b in found if "_SUCCESS" in scratch.children(spark, f"{path}/{b}")]

    def _state(self, spark: SparkSession, path: str, batch: int | None, schema: T.StructType) -> DataFrame:
        """Rows of keys, and one row for all (``whole``): the rows read and what a key may lack."""
        schema = T.StructType([*[schema[key] for key in self.keys]]).add("n", "long").add("missed", "long").add("whole", "boolean")
        if batch is None:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{path}/{batch}")

    def take(self, rows: DataFrame, batch: int, path: str) -> None:
        """Add a batch. One that is in already, or an older one, changes nothing."""
        spark, done = rows.sparkSession, self._done(rows.sparkSession, path)
        if done and done[-1] >= batch:
            return
        own = self.counts(rows).select(*self.keys, "n").persist(StorageLevel.MEMORY_AND_DISK)
        old = self._state(spark, path, done[-1] if done else None, own.schema)
        merged = own.unionByName(old.where("not whole").select(*self.keys, "n")).groupBy(*self.keys).agg(F.sum("n").alias("n"))
        merged = merged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            first = merged.orderBy(F.desc("n")).limit(self.counters + 1).agg(F.count("*").alias("keys"), F.min("n").alias("least")).first()
            cut = first["least"] if first["keys"] > self.counters else 0
            before = old.where("whole").first()
            read = (own.agg(F.sum("n")).first()[0] or 0) + (before["n"] if before else 0)
            missed = cut + (before["missed"] if before else 0)
            left = merged.where(F.col("n") > cut).select(*self.keys, (F.col("n") - cut).alias("n"), F.lit(missed).cast("long").alias("missed"), F.lit(False).alias("whole"))
            nothing = [F.lit(None).cast(own.schema[key].dataType).alias(key) for key in self.keys]
            whole = spark.range(1).select(*nothing, F.lit(read).cast("long").alias("n"), F.lit(missed).cast("long").alias("missed"), F.lit(True).alias("whole"))
            left.unionByName(whole).coalesce(1).write.mode("overwrite").parquet(f"{path}/{batch}")
        finally:
            merged.unpersist()
            own.unpersist()
        for old_batch in done[: 1 - self.keep or None]:
            scratch.remove(spark, f"{path}/{old_batch}")

    def read(self, spark: SparkSession, path: str, rows: T.StructType) -> DataFrame:
        """``keys``, ``at_least`` and ``at_most``: between them lies how often a key occurred.

        A key that is not listed occurred ``at_most`` as often as the row of nulls with ``at_least`` 0 says.
        """
        done = self._done(spark, path)
        schema = self.counts(spark.createDataFrame([], rows)).schema
        state = self._state(spark, path, done[-1] if done else None, schema)
        at_least = F.when(F.col("whole"), 0).otherwise(F.col("n"))
        return state.select(*self.keys, at_least.alias("at_least"), (at_least + F.col("missed")).alias("at_most"), "whole")
