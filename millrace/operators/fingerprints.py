"""Do two results hold the same rows? Told by sums of row hashes, without sorting or grouping the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.words import multiset_difference

PARTS = 4  # numbers of 32 bits, of the 128 of a row's hash
BUCKETS = 256


def row_text(frame: DataFrame) -> Column:
    """A row as one text, columns in order of their names; values are told apart by their lengths, nulls by a mark."""
    texts = [F.col(f"`{name}`").cast("string") for name in sorted(frame.columns)]
    return F.concat(*[F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")) for text in texts])


def _parts(frame: DataFrame) -> list[Column]:
    digest = F.md5(row_text(frame))
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("decimal(38,0)").alias(f"p{i}") for i in range(PARTS)]


def _sums() -> list[Column]:
    """Sums do not depend on the order of rows, and two equal rows do not cancel out."""
    return [F.count("*").alias("n_rows"), *[F.sum(f"p{i}").alias(f"p{i}") for i in range(PARTS)]]


def fingerprint(frame: DataFrame) -> DataFrame:
    """``n_rows`` and ``fingerprint`` of the rows as a multiset: one row per task is all that moves."""
    summed = frame.select(*_parts(frame)).agg(*_sums())
    marks = [F.coalesce(F.col(f"p{i}"), F.lit(0)).cast("string") for i in range(PARTS)]
    return summed.select("n_rows", F.concat_ws("-", *marks).alias("fingerprint"))


def _bucketed(frame: DataFrame, buckets: int) -> DataFrame:
    return frame.select("*", *_parts(frame)).withColumn("_bucket", F.pmod(F.col("p0"), F.lit(buckets)).cast("int"))


def differences(first: DataFrame, second: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """How many rows each side has that the other lacks, as ``words.multiset_difference`` tells, for results that rarely differ.

    Both sides are summed per bucket of row hashes. Only rows in buckets whose sums differ are grouped; equal
    sides move no rows at all. At most ``buckets`` numbers come to the driver.
    """
    second = second.select(*first.columns)
    marks = [f"p{i}" for i in range(PARTS)]
    signed = [
        _bucketed(side, buckets).groupBy("_bucket").agg(*_sums()).select("_bucket", *[(F.col(c) * sign).alias(c) for c in ("n_rows", *marks)])
        for side, sign in ((first, 1), (second, -1))
    ]
    balance = signed[0].unionByName(signed[1]).groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in ("n_rows", *marks)])
    uneven = reduce(Column.__or__, [F.col(c) != 0 for c in ("n_rows", *marks)])
    found = [r["_bucket"] for r in balance.where(uneven).collect()]
    if not found:
        return first.sparkSession.range(1).select(F.lit(0).cast("long").alias("only_first"), F.lit(0).cast("long").alias("only_second"))
    left, right = (_bucketed(side, buckets).where(F.col("_bucket").isin(found)).select(*first.columns) for side in (first, second))
    return multiset_difference(left, right)
