"""What the corpus operators share: tables, stored intermediate results, sizes of row batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import scratch

# The ASCII white space that separates words: \x20 and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it from there.

    It cuts the lineage: a lost executor costs the running tasks, not what led up to them.
    """
    path = scratch.new_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 2000, size: int = 8 << 20) -> None:
    """Bound what reaches a Python worker at once: long texts make batches of few rows.

    The settings stay on, because the result of an operator is evaluated later.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; empty for null."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def numbered(docs: DataFrame, prefix: str = "col") -> DataFrame:
    """The same columns under numbered names, which no name of an operator can clash with."""
    return docs.toDF(*[f"{prefix}_{i}" for i in range(len(docs.columns))])
