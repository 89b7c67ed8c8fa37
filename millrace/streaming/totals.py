"""A table of totals kept on shared storage: micro-batches merge their partial sums into it.

Rows are dealt to hash buckets by their key. A batch rewrites the buckets its keys fall into, as a new version;
a manifest names the version of every bucket. Readers follow the last manifest, so they see a
batch whole or not at all. No streaming state is kept, the driver holds a number per bucket, and a batch costs what
the buckets it touches hold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import scratch

MERGES = {"sum": F.sum, "min": F.min, "max": F.max}
_BUCKET = "_bucket"


@dataclass(frozen=True)
class Totals:
    """A keyed table below ``path``; ``merges`` says how each further column is merged (sum, min, max).

    One writer at a time. ``buckets`` is fixed for the life of a table; take so many that one fits
    a few tasks. Older versions are removed once ``keep`` manifests have followed. Null keys are keys like others.
    """

    path: str
    keys: Sequence[str]
    merges: Mapping[str, str]
    buckets: int = 16
    keep: int = 2

    def _done(self, spark: SparkSession) -> list[int]:
        """Batches whose manifest is complete, in order."""
        found = [int(name) for name in scratch.children(spark, f"{self.path}/manifests") if name.isdecimal()]
        return [b for b in sorted(found) if "_SUCCESS" in scratch.children(spark, f"{self.path}/manifests/{b}")]

    def _versions(self, spark: SparkSession, batch: int) -> dict[int, int]:
        rows = spark.read.schema("bucket int, version long").parquet(f"{self.path}/manifests/{batch}").collect()
        return {r["bucket"]: r["version"] for r in rows}

    def _read(self, spark: SparkSession, versions: Mapping[int, int], schema: T.StructType) -> DataFrame:
        paths = [f"{self.path}/data/{version}/{_BUCKET}={bucket}" for bucket, version in sorted(versions.items())]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def last_batch(self, spark: SparkSession) -> int | None:
        return next(reversed(self._done(spark)), None)

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The table after the last whole batch; ``schema`` is that of the partial sums."""
        batch = self.last_batch(spark)
        return self._read(spark, self._versions(spark, batch) if batch is not None else {}, schema)

    def merge(self, partials: DataFrame, batch: int) -> None:
        """Merge one batch's partial sums. A batch that is already in, or an older one, changes nothing."""
        spark = partials.sparkSession
        done = self._done(spark)
        if done and done[-1] >= batch:
            return
        versions = self._versions(spark, done[-1]) if done else {}
        columns = [*self.keys, *self.merges]
        schema = partials.select(*columns).schema
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(_BUCKET)
        dealt = partials.select(*columns, bucket).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # At most one number per bucket.
            touched = {r[0] for r in dealt.select(_BUCKET).distinct().collect()}
            if touched:
                old = self._read(spark, {b: versions[b] for b in touched if b in versions}, schema)
                both = dealt.unionByName(old.select("*", bucket))
                merged = both.groupBy(_BUCKET, *self.keys).agg(*[MERGES[how](c).alias(c) for c, how in self.merges.items()])
                # A bucket is written by as many tasks as its size asks for.
                typed = merged.select(_BUCKET, *[F.col(f.name).cast(f.dataType) for f in schema.fields])
                typed.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).mode("overwrite").parquet(f"{self.path}/data/{batch}")
        finally:
            dealt.unpersist()
        versions |= dict.fromkeys(touched, batch)
        manifest = spark.createDataFrame(sorted(versions.items()), "bucket int, version long")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifests/{batch}")
        self._forget(spark, [*done, batch])

    def _forget(self, spark: SparkSession, done: list[int]) -> None:
        """Drop old manifests, and the buckets that none of the others names."""
        named = {(v, b) for batch in done[-self.keep :] for b, v in self._versions(spark, batch).items()}
        for batch in done[: -self.keep]:
            scratch.remove(spark, f"{self.path}/manifests/{batch}")
        for version in [int(v) for v in scratch.children(spark, f"{self.path}/data") if v.isdecimal()]:
            folder = f"{self.path}/data/{version}"
            held = [name for name in scratch.children(spark, folder) if name.startswith(f"{_BUCKET}=")]
            stale = [name for name in held if (version, int(name.removeprefix(f"{_BUCKET}="))) not in named]
            for name in stale:
                scratch.remove(spark, f"{folder}/{name}")
            if len(stale) == len(held) and version != done[-1]:
                scratch.remove(spark, folder)
