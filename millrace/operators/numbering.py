"""Dense row numbers that are the same in every run, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources import scratch

_PLACE_BITS = (1 << 33) - 1  # the part of a monotonically increasing id that counts the rows of a task


def free_name(rows: DataFrame, name: str) -> str:
    """The name, or one made from it that no column has."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def number_rows(rows: DataFrame, name: str = "row_number", order: Sequence[str] | None = None) -> DataFrame:
    """The rows with their numbers, 1 to n, in the order of the given columns and then of all others (nulls first).

    Rows are dealt into ranges of that order and counted per range; a row's number is what lies in the ranges
    before plus its place in its own. Equal rows may take each other's numbers, so the result is the same in
    every run. They are told apart by a stored id, so that a row that makes up a third of the table still spreads
    over several ranges. Two tables are written below the scratch folder: the rows with those ids, which a repeated task
    must find unchanged, and the sorted ranges, which the result reads.
    """
    spark = rows.sparkSession
    first = list(order or [])
    by = [*first, *[column for column in rows.columns if column not in first]]
    tie, part, place = (free_name(rows, label) for label in ("_tie", "_part", "_place"))

    kept = scratch.stored(rows.withColumn(tie, F.monotonically_increasing_id()), "rows")
    ranged = kept.repartitionByRange(*by, tie).sortWithinPartitions(*by, tie).drop(tie)
    own_place = F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS))
    ranged = scratch.stored(ranged.withColumns({part: F.spark_partition_id(), place: own_place}), "ranges")

    # One number per range comes to the driver, as many as there are shuffle partitions.
    sizes = sorted(tuple(r) for r in ranged.groupBy(part).count().collect())
    before = [0, *accumulate(n for _, n in sizes)]
    begin = free_name(rows, "_begin")
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], f"{part} int, {begin} long")
    numbered = ranged.join(F.broadcast(offsets), part)
    return numbered.select(*rows.columns, (F.col(begin) + F.col(place) + 1).alias(name))
