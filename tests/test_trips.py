"""Trip jobs on small literal tables."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from millrace.functions import time as tm
from millrace.operators import boroughs as b
from millrace.operators import trips as tr
from millrace.plans import trips as plans
from millrace.sources import tables

SCHEMA = (
    "trip string, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double,"
    " trip_distance double, PULocationID int, DOLocationID int, payment_type int, fare_amount double, extra double,"
    " tip_amount double, total_amount double"
)


def trip(name, pickup="2019-01-07 10:00:00", minutes=30, passengers=1.0, distance=2.0, pu=1, do=2, payment=1, fare=10.0,
         extra=0.5, tip=1.0):
    start = datetime.fromisoformat(pickup) if pickup else None
    end = datetime.fromtimestamp(start.timestamp() + minutes * 60) if start else None
    return (name, start, end, passengers, distance, pu, do, payment, fare, extra, tip, fare + tip)


def frame(spark, *trips):
    return tr.with_duration(spark.createDataFrame(list(trips), SCHEMA))


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame(
        [(1, "Manhattan", "Soho"), (2, "Queens", "JFK"), (264, "Unknown", "NV"), (265, "N/A", "Outside")],
        "LocationID int, Borough string, Zone string",
    )


def test_duration(spark):
    result = frame(spark, trip("a", minutes=90), trip("b", minutes=-0.5), trip("c", pickup=None))
    assert rows(result, "trip", "duration_min") == [("a", 90.0), ("b", -0.5), ("c", None)]


def test_hour_edges(spark):
    hours = spark.createDataFrame([(datetime(2019, 1, 1, h),) for h in (0, 5, 6, 11, 12, 17, 18, 23)], "t timestamp_ntz")
    labels = [r[0] for r in hours.orderBy("t").select(tm.period_of_day(F.col("t"))).collect()]
    assert labels == ["late night"] * 2 + ["morning"] * 2 + ["afternoon"] * 2 + ["evening"] * 2


def test_season(spark):
    months = spark.createDataFrame([(datetime(2019, m, 1),) for m in range(1, 13)], "t timestamp_ntz")
    labels = [r[0] for r in months.orderBy("t").select(tm.season(F.col("t"))).collect()]
    assert labels == ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["fall"] * 3 + ["winter"]


def test_period_is_half_open(spark):
    result = frame(spark, trip("a", "2019-01-01 00:00:00"), trip("b", "2019-01-31 23:59:59"), trip("c", "2019-02-01 00:00:00"))
    assert rows(tr.in_period(result, "2019-01-01", "2019-02-01"), "trip") == [("a",), ("b",)]


def test_ids_are_unique(spark):
    result = tr.with_id(frame(spark, *[trip(str(i)) for i in range(50)]).repartition(4))
    assert result.select("trip_id").distinct().count() == 50


def test_extremes(spark):
    result = tr.extremes(
        frame(spark, trip("zero", distance=0.0, minutes=5), trip("far", distance=800.0, minutes=9),
              trip("near", distance=0.01, minutes=-10), trip("full", passengers=9.0, extra=500.0, minutes=2000)),
        ["trip", "passenger_count", "trip_distance", "duration_min", "extra"],
    )
    first = {}
    for row in result.collect():
        first.setdefault(row.question, row.trip)
    assert first == {
        "most passengers": "full",
        "shortest distance": "zero",
        "longest distance": "far",
        "shortest distance above zero": "near",
        "highest extra": "full",
        "shortest time": "near",
        "longest time": "full",
    }


def test_top_breaks_ties_by_key(spark):
    table = spark.createDataFrame([("c", 1), ("a", 1), ("b", 1), ("d", None)], "k string, v int")
    assert [r.k for r in tr.top(table, "v", 2, ["k"]).collect()] == ["a", "b"]
    assert [r.k for r in tr.top(table, "v", 2, ["k"], highest=False).collect()] == ["d", "a"]


def test_passenger_mean_skips_nulls(spark):
    result = tr.passenger_stats(frame(spark, trip("a", passengers=None), trip("b", passengers=0.0), trip("c", passengers=3.0)))
    assert rows(result) == [(3.0, 1.5)]


def test_busiest_and_slowest_keeps_ties(spark):
    counts = spark.createDataFrame([(1, 9), (2, 9), (3, 5), (4, 5), (5, 1)], "hour int, n_trips int")
    ranked = {r.hour: (r.busy_rank, r.slow_rank) for r in tr.busiest_and_slowest(counts, "hour", 1).collect()}
    assert ranked == {1: (1, 4), 2: (1, 4), 5: (5, 1)}


def test_weekday_average(spark):
    # Two Mondays with 1 and 2 trips, one Tuesday with 1.
    result = tr.weekday_average(
        frame(spark, trip("a"), trip("b", "2019-01-14 01:00:00"), trip("c", "2019-01-14 02:00:00"), trip("d", "2019-01-08 02:00:00"))
    )
    assert rows(result) == [("Monday", 1.5), ("Tuesday", 1.0)]
    assert rows(tr.per_day(frame(spark, trip("a")))) == [(date(2019, 1, 7), 1)]


def test_correlation(spark):
    cards = [trip(str(i), distance=float(i), tip=float(2 * i), passengers=2.0) for i in range(5)]
    cash = trip("cash", payment=2, distance=100.0, tip=0.0)
    hole = trip("hole", distance=None, tip=50.0, passengers=2.0)
    [(by_distance, by_passengers)] = rows(tr.tip_correlation(frame(spark, *cards, cash, hole)))
    assert by_distance == 1.0
    # Every card trip has two passengers: no correlation, and no error.
    assert by_passengers is None


def test_quality(spark):
    result = tr.quality(
        frame(spark, trip("a", passengers=0.0), trip("b", passengers=None), trip("c", distance=0.0), trip("d", fare=-1.0),
              trip("e", minutes=0), trip("f", minutes=-5), trip("g", minutes=1441), trip("h", minutes=1440),
              trip("i", "2088-01-01 00:00:00"), trip("j", pickup=None)),
        "2019-01-01", "2019-02-01",
    )
    assert rows(result) == [(1, 1, 1, 1, 2, 1, 2)]


def test_describe(spark):
    result = tr.describe(frame(spark, trip("a", passengers=1.0), trip("b", passengers=3.0), trip("c", passengers=None)))
    found = {r.measure: r for r in result.collect()}
    assert set(found) == set(tr.DESCRIBED)
    p = found["passenger_count"]
    assert (p.n, p["mean"], p.stddev, p["min"], p["max"]) == (2, 2.0, 1.414, 1.0, 3.0)


def test_band_edges_are_excluded(spark):
    edges = [trip("f0", fare=0.0), trip("f500", fare=500.0), trip("d100", distance=100.0), trip("d0", distance=0.0),
             trip("t180", minutes=180), trip("t0", minutes=0)]
    kept = [trip("in", fare=499.0, minutes=179, distance=99.0, passengers=None), trip("in2")]
    trips = frame(spark, *edges, *kept)
    result = tr.compare_periods(trips, {"2019": ("2019-01-01", "2020-01-01"), "2026": ("2026-01-01", "2027-01-01")})
    found = {r.period: r for r in result.collect()}
    assert (found["2019"].n_trips, found["2019"].mean_passengers, found["2019"].mean_distance) == (2, 1.0, 50.5)
    assert (found["2026"].n_trips, found["2026"].mean_fare) == (0, None)


def test_boroughs_left_and_inner(spark, zones):
    trips = frame(spark, trip("a"), trip("b", pu=264, do=265), trip("c", pu=999))
    joined = b.with_boroughs(trips, zones)
    assert rows(joined, "trip", "pu_borough", "do_borough") == [
        ("a", "Manhattan", "Queens"), ("b", "Unknown", "N/A"), ("c", None, "Queens")
    ]
    counted = trips.withColumn("n_trips", F.lit(1))
    inner = tr.ask_sql(tr.SQL_PICKUPS_BY_BOROUGH, trips=counted, zones=zones)
    assert rows(inner) == [("Manhattan", 1), ("Unknown", 1)]


def test_sql_and_dataframe_agree(spark, sf_dir):
    matched = plans.pickups_by_borough(spark, sf_dir).where("pu_borough is not null")
    assert rows(plans.sql_pickups_by_borough(spark, sf_dir)) == rows(matched)
    assert rows(plans.sql_passenger_stats(spark, sf_dir)) == rows(plans.passenger_stats(spark, sf_dir))
    hours = tr.top(plans.trips_per_hour(spark, sf_dir), "n_trips", 3, ["hour"])
    assert rows(plans.sql_busiest_hours(spark, sf_dir)) == rows(hours)


def test_pivot_gap_is_null(spark, zones):
    trips = frame(spark, trip("a", "2019-01-07 07:00:00"), trip("b", "2019-01-07 08:00:00"), trip("c", "2019-01-07 13:00:00", pu=2))
    table = b.by_period_of_day(b.with_boroughs(trips, zones))
    assert rows(table) == [("Manhattan", 2, None, None, None), ("Queens", None, 1, None, None)]


def test_weekday_means_with_and_without_empty_days(spark, zones):
    # Queens has trips on one of two Mondays.
    trips = b.with_boroughs(
        frame(spark, trip("a"), trip("b", "2019-01-14 01:00:00"), trip("c", pu=2), trip("d", pu=2)), zones, ["PU"]
    )
    assert {r.pu_borough: r.Monday for r in b.by_weekday(trips).collect()} == {"Manhattan": 1.0, "Queens": 2.0}
    filled = b.by_weekday(trips, zero_fill=True, digits=1)
    assert {r.pu_borough: (r.Monday, r.Friday) for r in filled.collect()} == {"Manhattan": (1.0, 0.0), "Queens": (1.0, 0.0)}


def test_shares(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 1)], "pu_borough string, n_trips int")
    assert rows(b.shares(counts), "pu_borough", "share") == [("a", 0.75), ("b", 0.25)]


def test_fare_extremes(spark, zones):
    trips = b.with_boroughs(frame(spark, *[trip(str(i), fare=float(i)) for i in range(10)]), zones)
    result = b.fare_extremes(trips, ["trip"], 2)
    assert rows(result, "question", "trip") == [("highest", "8"), ("highest", "9"), ("lowest", "0"), ("lowest", "1")]


def test_contenders_hold_all_that_may_be_first(spark):
    values = [(n, v, n % 2) for n, v in enumerate([5.0, None, 1.0, 5.0, 3.0, None, 1.0, 5.0, 2.0, 4.0])]
    table = spark.createDataFrame(values, "id int, v double, w int")
    for k in (1, 2, 3, 4, 20):
        for highest in (True, False):
            some = tr.contenders(table, "v", k, ["w"], [highest])
            assert rows(tr.top(some, "v", k, ["w", "id"], highest)) == rows(tr.top(table, "v", k, ["w", "id"], highest))
    assert tr.contenders(table, "v", 1, ["id"]).count() == 2


# --- plans ----------------------------------------------------------------------------------


def test_time_range_reaches_the_scan(spark, sf_dir):
    text = plan(plans.trips_in_period(spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_scan_reads_needed_columns_only(spark, sf_dir):
    assert "ReadSchema: struct<l_linenumber:int>" in plan(plans.passenger_stats(spark, sf_dir))


def test_count_and_join_share_a_shuffle(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(plans.trips_per_day(spark, sf_dir))
        # Lines by order, orders by order, result by day.
        assert text.count("Exchange hashpartitioning") == 3
        assert "partial_count(1)" in text.split("SortMergeJoin")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_few_lines_are_joined_for_extremes(spark, sf_dir):
    for query in (plans.fare_extremes_borough, plans.trips_shortest_positive):
        assert "subquery" in plan(query(spark, sf_dir)).lower()


def test_periods_are_one_pass(spark, sf_dir):
    assert plan(plans.period_metrics(spark, sf_dir)).count("FileScan parquet") == 2


def test_quality_is_one_pass(spark, sf_dir):
    assert plan(plans.trips_quality(spark, sf_dir)).count("FileScan parquet") == 2


def test_hot_order_is_split(spark, tmp_path):
    """A third of all lines on one order: the join splits that partition instead of one task taking it."""
    n = 60000
    lines = spark.range(n).selectExpr(
        "if(id % 3 = 0, 1L, id) as l_orderkey", "cast(id % 7 as int) as l_linenumber", "id as l_suppkey",
        "1.0D as l_quantity", "1.0D as l_extendedprice", "0.1D as l_discount", "0.0D as l_tax", "'R' as l_returnflag",
        "timestamp_ntz'2019-01-02 00:00:00' as l_shipdate",
    )
    lines.repartition(8).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(n).selectExpr("id as o_orderkey", "id as o_custkey", "timestamp_ntz'2019-01-01 00:00:00' as o_orderdate").write.parquet(
        str(tmp_path / "orders.parquet")
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        result = tr.per_day(tables.trips(spark, str(tmp_path), [tr.PICKUP]))
        assert rows(result) == [(date(2019, 1, 1), n)]
        assert "skew=true" in plan(result)
        # Counted before the join there is nothing left to split.
        counted = tr.per_day(tables.trip_counts(spark, str(tmp_path), [tr.PICKUP]))
        assert rows(counted) == [(date(2019, 1, 1), n)]
        assert "skew=true" not in plan(counted)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
