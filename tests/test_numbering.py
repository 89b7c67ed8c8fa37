"""Dense numbers: complete, in order, the same in every run, and spread over ranges."""

from __future__ import annotations

from helpers import plan, rows
from pyspark.sql import functions as F

from millrace.operators import numbering, trips as tr


def expected(values):
    """Nulls first, numbered from 1."""
    ordered = sorted(values, key=lambda row: tuple((x is not None, x if x is not None else 0) for x in row))
    return sorted(((*row, i) for i, row in enumerate(ordered, 1)), key=repr)


def test_numbers_follow_all_columns(spark):
    values = [(i * 7 % 10 if i % 4 else None, i * 5 % 3) for i in range(200)]
    frame = spark.createDataFrame(values, "a int, b int").repartition(5)
    assert rows(numbering.number_rows(frame)) == expected(values)
    by_b = rows(numbering.number_rows(frame, "n", ["b"]).select("b", "a", "n"))
    assert by_b == expected([(b, a) for a, b in values])


def test_numbers_do_not_depend_on_the_partitions(spark):
    frame = spark.range(500).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"))
    runs = [rows(numbering.number_rows(frame.repartition(n), "n")) for n in (1, 3, 8)]
    assert runs[0] == runs[1] == runs[2]


def test_a_row_that_is_a_third_of_the_table_spreads(spark):
    frame = spark.range(0, 30000, 1, 6).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("a"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = numbering.number_rows(frame, "n")
        files = numbered.where("a = -1").groupBy(F.input_file_name().alias("file")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files) > 1 and sum(r["count"] for r in files) == 10000
    checked = numbered.agg(F.count("*"), F.count_distinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(checked) == (30000, 30000, 1, 30000)
    # No task sees all rows.
    assert "Window" not in plan(numbered) and "SinglePartition" not in plan(numbered)


def test_own_names_and_no_rows(spark):
    frame = spark.createDataFrame([(2, "x", 1, 5), (1, "y", 2, 6)], "_tie int, _part string, _place int, _begin int")
    assert rows(numbering.number_rows(frame, "n"), "_tie", "n") == [(1, 1), (2, 2)]
    assert rows(numbering.number_rows(frame.limit(0))) == []
    assert numbering.number_rows(frame, "n").columns == [*frame.columns, "n"]


def test_ids_of_equal_keys_differ(spark):
    frame = spark.createDataFrame([(1, 1, 2.0), (1, 1, 3.0), (1, 1, 3.0), (2, 1, 0.0)], "k int, l int, x double")
    ids = tr.with_key_id(numbering.number_rows(frame, "trip_number"), ["k", "l"])
    assert [r[0] for r in rows(ids, "trip_id")] == ["1-1-1", "1-1-2", "1-1-3", "2-1-4"]
