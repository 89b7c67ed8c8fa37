"""Tables stored by month: a period reads its months, a month is replaced without touching the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import time as tm

MONTH = "stored_month"


def month_number(time: Column) -> Column:
    """Year and month as a number such as 199602; null for a null time."""
    return (F.year(time) * 100 + F.month(time)).cast("int")


def write_months(rows: DataFrame, path: str, time: str) -> None:
    """Write rows into the folders of their months, replacing the months that occur and no others.

    Months are dealt out by size: a month with a third of all rows is written by several tasks, small ones are not
    cut into many files. Rows without a time have a folder of their own.
    """
    stored = rows.withColumn(MONTH, month_number(F.col(time))).hint("rebalance", MONTH)
    writer = stored.write.partitionBy(MONTH).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_period(spark: SparkSession, path: str, schema: T.StructType, time: str, start: str, end: str) -> DataFrame:
    """Rows of a half-open period; only the folders of its months are listed and read."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.IntegerType())])).parquet(path)
    first, last = (month_number(F.lit(edge).cast("timestamp_ntz")) for edge in (start, end))
    months = (F.col(MONTH) >= first) & (F.col(MONTH) <= last)
    return rows.where(months & tm.in_period(F.col(time), start, end)).drop(MONTH)
