"""Registered trip queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.time import WEEKDAYS
from millrace.operators import boroughs as b
from millrace.operators import trips as tr
from millrace.sources import files, partitioned, scratch, tables

KEYS = ["order_key", "line_number"]
TIMES = [tr.PICKUP, tr.DROPOFF]
AMOUNT_COLUMNS = [*KEYS, "passenger_count", "trip_distance", "extra", "fare_amount", "total_amount"]
TIME_COLUMNS = [*KEYS, *TIMES, "trip_distance", "duration_min"]
YEAR_1, YEAR_2 = ("1996-01-01", "1997-01-01"), ("2000-01-01", "2001-01-01")
# The stand-in trips cost more and last longer than taxi rides; same shape of bands.
BANDS = {"fare_amount": (0, 50000), "trip_distance": (0, 40), "duration_min": (0, 1440 * 365)}


def _timed(spark, sf, *columns):
    return tr.with_duration(tables.trips(spark, sf, [*KEYS, *TIMES, *columns]))


def _with_boroughs(spark, sf, *columns, ends=("PU", "DO")):
    trips = tables.trips(spark, sf, [*columns, *[f"{end}LocationID" for end in ends]])
    return b.with_boroughs(trips, tables.zones(spark, sf), ends)


def _counts_with_boroughs(spark, sf, *columns, end):
    counts = tables.trip_counts(spark, sf, [*columns, f"{end}LocationID"])
    return b.with_boroughs(counts, tables.zones(spark, sf), [end])


def _rides_with_boroughs(spark, sf):
    return b.with_boroughs(tables.rides(spark, sf, zones=True), tables.zones(spark, sf), ["PU"])


def trips_scan(spark, sf):
    return tables.trips(spark, sf, [*KEYS, "trip_distance", "fare_amount", "payment_type"])


def zones_csv_roundtrip(spark, sf):
    path = scratch.new_path(spark, "zones")
    files.write_csv(tables.zones(spark, sf), path)
    return files.read_zones(spark, path)


def zones_csv_rejects(spark, sf):
    """Zones as CSV text in which records are damaged in several ways; some only look so."""
    path = scratch.new_path(spark, "zones")
    record = """case LocationID % 6
        when 1 then concat('x', LocationID, ',', Borough, ',', Zone)
        when 2 then concat(LocationID, ',', Borough)
        when 3 then concat(LocationID, ',"', Borough, chr(10), 'and more",', Zone)
        when 4 then concat(LocationID, ',', Borough, ',', Zone, ',more')
        when 5 then concat(LocationID, ',"', Borough, ', N/A",', Zone)
        else concat(LocationID, ',', Borough, ',', Zone) end as value"""
    tables.zones(spark, sf).selectExpr(record).write.text(path)
    good, damaged = files.read_csv_checked(spark, path, files.ZONE_SCHEMA, header=False, multi_line=True)
    return good.unionByName(damaged.select("raw"), allowMissingColumns=True)


def trips_derive(spark, sf):
    return _timed(spark, sf)


def trips_with_id(spark, sf):
    return tr.with_id(tables.trips(spark, sf, [*KEYS, "trip_distance", "fare_amount"]))


def trips_numbered(spark, sf):
    """Trips with ids from 1 to their number, in the order of all columns of a line."""
    columns = [*KEYS, "trip_distance", "fare_amount"]
    return tables.trips(spark, sf, columns, tables.numbered_lines(spark, sf), ["trip_id"])


def trips_with_key_id(spark, sf):
    lines = tables.numbered_lines(spark, sf, "trip_number")
    trips = tables.trips(spark, sf, [*KEYS, "trip_distance", "fare_amount"], lines, ["trip_number"])
    return tr.with_key_id(trips, KEYS).drop("trip_number")


def longest_trips_with_id(spark, sf):
    """The id carried into an answer."""
    trips = tables.trips(spark, sf, ["trip_distance"], tables.numbered_lines(spark, sf), ["trip_id"])
    return tr.top(trips, "trip_distance", 3, ["trip_id"])


def trips_numbered_check(spark, sf):
    """The ids that answers carry: as many as trips, none twice, from 1 to the number of trips."""
    ids = tables.numbered_lines(spark, sf)
    return ids.agg(
        F.count("*").alias("n_trips"),
        F.count_distinct("trip_id").alias("n_ids"),
        F.min("trip_id").alias("least"),
        F.max("trip_id").alias("largest"),
    )


def trips_id_check(spark, sf):
    """Ids are unique: those of a task are consecutive, and the ranges of the tasks do not meet.

    One row per task is enough to tell; no id is moved. ``n_ids`` is the number of trips in ranges that are as
    long as their count and begin behind the one before.
    """
    task = F.shiftright("trip_id", 33)
    ranges = (
        trips_with_id(spark, sf)
        .groupBy(task.alias("task"))
        .agg(F.min("trip_id").alias("low"), F.max("trip_id").alias("high"), F.count("*").alias("n"))
    )
    before = F.lag("high", 1, -1).over(Window.orderBy("task"))
    sound = ranges.withColumn("sound", (F.col("high") - F.col("low") + 1 == F.col("n")) & (F.col("low") > before))
    return sound.agg(F.sum("n").alias("n_trips"), F.sum(F.when(F.col("sound"), F.col("n")).otherwise(0)).alias("n_ids"))


def trips_in_period(spark, sf):
    return tr.in_period(tables.trips(spark, sf, [*KEYS, *TIMES, "trip_distance"]), *YEAR_1)


def trips_in_stored_period(spark, sf):
    """The same from trips stored by month: one year reads twelve folders."""
    path, trips = scratch.new_path(spark, "trips"), tables.trips(spark, sf, [*KEYS, *TIMES, "trip_distance"])
    partitioned.write_months(trips, path, tr.PICKUP)
    return partitioned.read_period(spark, path, trips.schema, tr.PICKUP, *YEAR_1)


def _contenders(spark, sf, measure, k, ends, where="true", lines=None):
    """Lines that may be among the k first by a measure of their own, found before anything is joined."""
    columns = [tables.TRIP_VIEW[name] for name in (measure, *KEYS)]
    lines = (tables.table(spark, sf, "lineitem") if lines is None else lines).where(where)
    return tr.contenders(lines, columns[0], k, columns[1:], ends)


def trips_shortest_positive(spark, sf):
    lines = _contenders(spark, sf, "trip_distance", 3, [False], "l_quantity > 0")
    trips = tables.trips(spark, sf, [*KEYS, *TIMES, "trip_distance"], lines)
    return tr.shortest_positive(tr.with_duration(trips), 3, KEYS)


def trips_extremes(spark, sf):
    """Extremes of what a line knows by itself: no join."""
    return tr.extremes(tables.trips(spark, sf, AMOUNT_COLUMNS), AMOUNT_COLUMNS, tr.AMOUNT_QUESTIONS)


def trips_extremes_time(spark, sf):
    """Extremes of the duration; both questions share the shuffle that finds the pick-up time."""
    return tr.extremes(_timed(spark, sf, "trip_distance"), TIME_COLUMNS, tr.TIME_QUESTIONS)


def passenger_stats(spark, sf):
    return tr.passenger_stats(tables.trips(spark, sf, ["passenger_count"]))


def trips_per_day(spark, sf):
    return tr.per_day(tables.trip_counts(spark, sf, [tr.PICKUP]))


def trips_per_hour(spark, sf):
    return tr.per_hour(tables.rides(spark, sf))


def period_of_day(spark, sf):
    return tr.per_period_of_day(tables.rides(spark, sf))


def trips_by_season(spark, sf):
    return tr.per_season(tables.trip_counts(spark, sf, [tr.PICKUP]))


def busiest_days(spark, sf):
    return tr.busiest_and_slowest(trips_per_day(spark, sf), "day")


def busiest_hours(spark, sf):
    return tr.busiest_and_slowest(trips_per_hour(spark, sf), "hour")


def weekday_average(spark, sf):
    return tr.weekday_average(tables.trip_counts(spark, sf, [tr.PICKUP]))


def tip_by_payment(spark, sf):
    return tr.tip_by_payment(tables.trips(spark, sf, ["payment_type", "tip_amount"]))


def tip_correlation(spark, sf):
    return tr.tip_correlation(
        tables.trips(spark, sf, ["payment_type", "tip_amount", "trip_distance", "passenger_count"])
    )


def tip_by_passengers(spark, sf):
    return tr.tip_by_passengers(tables.trips(spark, sf, ["payment_type", "tip_amount", "passenger_count"]))


def trips_quality(spark, sf):
    return tr.quality(_timed(spark, sf, "passenger_count", "trip_distance", "fare_amount"), *YEAR_1)


def trips_describe(spark, sf):
    return tr.describe(_timed(spark, sf, *[c for c in tr.DESCRIBED if c != "duration_min"]))


def trips_with_boroughs(spark, sf):
    return _with_boroughs(spark, sf, *KEYS, "fare_amount")


def pickups_by_borough(spark, sf):
    return b.pickups(_counts_with_boroughs(spark, sf, end="PU"))


def dropoffs_by_borough(spark, sf):
    return b.dropoffs(_counts_with_boroughs(spark, sf, end="DO"))


def borough_shares(spark, sf):
    return b.shares(pickups_by_borough(spark, sf))


def period_by_borough(spark, sf):
    return b.by_period_of_day(_rides_with_boroughs(spark, sf))


def weekday_by_borough(spark, sf):
    return b.by_weekday(_counts_with_boroughs(spark, sf, tr.PICKUP, end="PU"))


def weekday_by_borough_all_days(spark, sf):
    """The same mean over every day of the data, days without trips included."""
    return b.by_weekday(_counts_with_boroughs(spark, sf, tr.PICKUP, end="PU"), zero_fill=True)


def borough_averages(spark, sf):
    sums = tables.trip_sums(spark, sf, ["PULocationID"], ["trip_distance", "fare_amount"])
    return b.averages(b.with_boroughs(sums, tables.zones(spark, sf), ["PU"]))


def fare_extremes_borough(spark, sf):
    lines = _contenders(spark, sf, "fare_amount", 3, [True, False], lines=tables.numbered_lines(spark, sf))
    columns = [*KEYS, "fare_amount", "trip_distance", "PULocationID", "DOLocationID"]
    trips = tables.trips(spark, sf, columns, lines, ["trip_id"])
    return b.fare_extremes(b.with_boroughs(trips, tables.zones(spark, sf)), [*KEYS, "trip_id"])


def period_metrics(spark, sf):
    trips = _timed(spark, sf, "passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount")
    return tr.compare_periods(trips, {"1996": YEAR_1, "2000": YEAR_2}, BANDS)


def sql_passenger_stats(spark, sf):
    return tr.ask_sql(tr.SQL_PASSENGER_STATS, trips=tables.trips(spark, sf, ["passenger_count"]))


def sql_busiest_hours(spark, sf):
    return tr.ask_sql(tr.SQL_BUSIEST_HOURS, trips=tables.rides(spark, sf))


def sql_pickups_by_borough(spark, sf):
    return tr.ask_sql(
        tr.SQL_PICKUPS_BY_BOROUGH, trips=tables.trip_counts(spark, sf, ["PULocationID"]), zones=tables.zones(spark, sf)
    )


QUERIES = {
    f.__name__: f
    for f in (
        trips_scan,
        zones_csv_roundtrip,
        zones_csv_rejects,
        trips_derive,
        trips_with_id,
        trips_numbered,
        trips_numbered_check,
        trips_with_key_id,
        longest_trips_with_id,
        trips_id_check,
        trips_in_period,
        trips_in_stored_period,
        trips_shortest_positive,
        trips_extremes,
        trips_extremes_time,
        passenger_stats,
        trips_per_day,
        trips_per_hour,
        period_of_day,
        trips_by_season,
        busiest_days,
        busiest_hours,
        weekday_average,
        tip_by_payment,
        tip_correlation,
        tip_by_passengers,
        trips_quality,
        trips_describe,
        trips_with_boroughs,
        pickups_by_borough,
        dropoffs_by_borough,
        borough_shares,
        period_by_borough,
        weekday_by_borough,
        weekday_by_borough_all_days,
        borough_averages,
        fare_extremes_borough,
        period_metrics,
        sql_passenger_stats,
        sql_busiest_hours,
        sql_pickups_by_borough,
    )
}

# --- SQL ------------------------------------------------------------------------------------

_TRIPS = """WITH trips AS (
    SELECT l_orderkey AS order_key, l_linenumber AS line_number, o_orderdate AS tpep_pickup_datetime,
           l_shipdate AS tpep_dropoff_datetime, CAST(l_linenumber AS DOUBLE) AS passenger_count,
           l_quantity AS trip_distance, c_nationkey AS PULocationID, s_nationkey AS DOLocationID,
           CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS payment_type,
           l_extendedprice AS fare_amount, l_tax AS extra, l_extendedprice * l_discount AS tip_amount,
           l_extendedprice + l_extendedprice * l_discount AS total_amount,
           date_diff('second', o_orderdate, l_shipdate) / 60.0::DOUBLE AS duration_min
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
         LEFT JOIN customer ON o_custkey = c_custkey
         LEFT JOIN supplier ON l_suppkey = s_suppkey),
zones AS (
    SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone
    FROM nation JOIN region ON n_regionkey = r_regionkey),
boroughs AS (
    SELECT trips.*, pu.Borough AS pu_borough, dr.Borough AS do_borough
    FROM trips LEFT JOIN zones pu ON PULocationID = pu.LocationID
         LEFT JOIN zones dr ON DOLocationID = dr.LocationID),
days AS (SELECT CAST(tpep_pickup_datetime AS DATE) AS day, count(*) AS n_trips FROM trips GROUP BY ALL),
hours AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n_trips FROM events GROUP BY ALL)
"""
# The same with the number of a line in the order of all its columns.
_NUMBERED = _TRIPS.replace("SELECT l_orderkey AS", "SELECT trip_id, l_orderkey AS").replace(
    "FROM lineitem",
    """FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
        l_linenumber NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
        l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS trip_id
        FROM lineitem)""",
)


def _extreme(columns, question, by, k, where="true"):
    shown = ", ".join(columns)
    return f"(SELECT {shown}, '{question}' AS question FROM trips WHERE {where} ORDER BY {by}, {shown} LIMIT {k})"


def _ranked(source, key):
    return f"""SELECT * FROM (
        SELECT {key}, n_trips, CAST(rank() OVER (ORDER BY n_trips DESC) AS INTEGER) AS busy_rank,
               CAST(rank() OVER (ORDER BY n_trips) AS INTEGER) AS slow_rank FROM {source})
        WHERE busy_rank <= 3 OR slow_rank <= 3"""


def _described(column):
    return f"""SELECT '{column}' AS measure, count({column}) AS n, round(avg({column}), 3) AS mean,
        round(stddev_samp({column}), 3) AS stddev, CAST(min({column}) AS DOUBLE) AS min,
        CAST(max({column}) AS DOUBLE) AS max FROM trips"""


def _metrics(label, start, end):
    bands = " AND ".join(f"{c} > {low} AND {c} < {high}" for c, (low, high) in BANDS.items())
    return f"""SELECT '{label}' AS period, count(*) AS n_trips, round(avg(passenger_count), 2) AS mean_passengers,
        round(avg(trip_distance), 2) AS mean_distance, round(avg(duration_min), 2) AS mean_duration_min,
        round(avg(fare_amount), 2) AS mean_fare, round(avg(tip_amount), 2) AS mean_tip,
        round(avg(total_amount), 2) AS mean_total
        FROM trips WHERE tpep_pickup_datetime >= '{start}' AND tpep_pickup_datetime < '{end}' AND {bands}"""


_PERIOD = """CASE WHEN hour(ts) >= 6 AND hour(ts) < 12 THEN 'morning'
    WHEN hour(ts) >= 12 AND hour(ts) < 18 THEN 'afternoon'
    WHEN hour(ts) >= 18 THEN 'evening' ELSE 'late night' END"""
_TIPS = "FROM trips WHERE payment_type = 1"
_IN_PERIOD = (
    _TRIPS
    + f"""SELECT order_key, line_number, tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance FROM trips
        WHERE tpep_pickup_datetime >= '{YEAR_1[0]}' AND tpep_pickup_datetime < '{YEAR_1[1]}'"""
)
_PICKUPS = _TRIPS + "SELECT pu_borough, count(*) AS n_trips FROM boroughs GROUP BY pu_borough"

ORACLE = {
    "trips_scan": _TRIPS + "SELECT order_key, line_number, trip_distance, fare_amount, payment_type FROM trips",
    "zones_csv_roundtrip": _TRIPS + "SELECT LocationID, Borough, Zone FROM zones",
    "trips_derive": _TRIPS
    + "SELECT order_key, line_number, tpep_pickup_datetime, tpep_dropoff_datetime, duration_min FROM trips",
    "trips_numbered": _NUMBERED + "SELECT order_key, line_number, trip_distance, fare_amount, trip_id FROM trips",
    "trips_numbered_check": """SELECT count(*) AS n_trips, count(*) AS n_ids, CAST(1 AS BIGINT) AS least, count(*) AS largest
        FROM lineitem""",
    "trips_with_key_id": _NUMBERED
    + """SELECT order_key, line_number, trip_distance, fare_amount,
        concat_ws('-', order_key, line_number, trip_id) AS trip_id FROM trips""",
    "longest_trips_with_id": _NUMBERED
    + "SELECT trip_distance, trip_id FROM trips ORDER BY trip_distance DESC NULLS LAST, trip_id LIMIT 3",
    "trips_id_check": "SELECT count(*) AS n_trips, count(*) AS n_ids FROM lineitem",
    "trips_in_period": _IN_PERIOD,
    "trips_in_stored_period": _IN_PERIOD,
    "zones_csv_rejects": _TRIPS
    + """SELECT CASE WHEN LocationID % 6 IN (0, 3, 5) THEN LocationID END AS LocationID,
        CASE LocationID % 6 WHEN 0 THEN Borough WHEN 3 THEN Borough || chr(10) || 'and more' WHEN 5 THEN Borough || ', N/A' END AS Borough,
        CASE WHEN LocationID % 6 IN (0, 3, 5) THEN Zone END AS Zone,
        CASE LocationID % 6 WHEN 1 THEN concat('x', LocationID, ',', Borough, ',', Zone) WHEN 2 THEN concat(LocationID, ',', Borough)
            WHEN 4 THEN concat(LocationID, ',', Borough, ',', Zone, ',more') END AS raw
        FROM zones""",
    "trips_shortest_positive": _TRIPS
    + """SELECT order_key, line_number, trip_distance, duration_min FROM trips WHERE trip_distance > 0
        ORDER BY trip_distance, order_key, line_number, duration_min NULLS FIRST LIMIT 3""",
    "trips_extremes": _TRIPS
    + " UNION ALL ".join(
        [
            _extreme(AMOUNT_COLUMNS, "most passengers", "passenger_count DESC NULLS LAST", 5),
            _extreme(AMOUNT_COLUMNS, "shortest distance", "trip_distance NULLS FIRST", 3),
            _extreme(AMOUNT_COLUMNS, "longest distance", "trip_distance DESC NULLS LAST", 3),
            _extreme(AMOUNT_COLUMNS, "shortest distance above zero", "trip_distance", 3, "trip_distance > 0"),
            _extreme(AMOUNT_COLUMNS, "highest extra", "extra DESC NULLS LAST", 3),
        ]
    ),
    "trips_extremes_time": _TRIPS
    + " UNION ALL ".join(
        [
            _extreme(TIME_COLUMNS, "shortest time", "duration_min NULLS FIRST", 3),
            _extreme(TIME_COLUMNS, "longest time", "duration_min DESC NULLS LAST", 3),
        ]
    ),
    "passenger_stats": _TRIPS
    + "SELECT max(passenger_count) AS max_passengers, round(avg(passenger_count), 2) AS mean_passengers FROM trips",
    "trips_per_day": _TRIPS + "SELECT day, n_trips FROM days",
    "trips_per_hour": _TRIPS + "SELECT hour, n_trips FROM hours",
    "period_of_day": f"SELECT {_PERIOD} AS period, count(*) AS n_trips FROM events GROUP BY ALL",
    "trips_by_season": _TRIPS
    + """SELECT CASE WHEN month(tpep_pickup_datetime) IN (12, 1, 2) THEN 'winter'
            WHEN month(tpep_pickup_datetime) IN (3, 4, 5) THEN 'spring'
            WHEN month(tpep_pickup_datetime) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season,
            count(*) AS n_trips FROM trips GROUP BY ALL""",
    "busiest_days": _TRIPS + _ranked("days", "day"),
    "busiest_hours": _TRIPS + _ranked("hours", "hour"),
    "weekday_average": _TRIPS + "SELECT dayname(day) AS weekday, avg(n_trips) AS mean_trips FROM days GROUP BY ALL",
    "tip_by_payment": _TRIPS
    + "SELECT payment_type, round(avg(tip_amount), 6) AS mean_tip FROM trips GROUP BY payment_type",
    "tip_correlation": _TRIPS
    + f"""SELECT round(corr(trip_distance, tip_amount), 6) AS corr_distance_tip,
        round(corr(passenger_count, tip_amount), 6) AS corr_passengers_tip {_TIPS}""",
    "tip_by_passengers": _TRIPS
    + f"""SELECT passenger_count, round(avg(tip_amount), 6) AS mean_tip, count(*) AS n_trips {_TIPS}
        GROUP BY passenger_count""",
    "trips_quality": _TRIPS
    + f"""SELECT count(*) FILTER (passenger_count = 0) AS no_passenger,
        count(*) FILTER (passenger_count IS NULL) AS passengers_unknown,
        count(*) FILTER (trip_distance = 0) AS no_distance,
        count(*) FILTER (fare_amount < 0) AS negative_fare,
        count(*) FILTER (duration_min <= 0) AS no_duration,
        count(*) FILTER (duration_min > 1440) AS over_a_day,
        count(*) - count(*) FILTER (tpep_pickup_datetime >= '{YEAR_1[0]}' AND tpep_pickup_datetime < '{YEAR_1[1]}')
            AS outside_period FROM trips""",
    "trips_describe": _TRIPS
    + " UNION ALL ".join(
        _described(c)
        for c in ("trip_distance", "fare_amount", "tip_amount", "extra", "passenger_count", "duration_min")
    ),
    "trips_with_boroughs": _TRIPS
    + """SELECT order_key, line_number, fare_amount, PULocationID, DOLocationID, pu_borough, do_borough
        FROM boroughs""",
    "pickups_by_borough": _PICKUPS,
    "dropoffs_by_borough": _TRIPS + "SELECT do_borough, count(*) AS n_trips FROM boroughs GROUP BY do_borough",
    "borough_shares": _TRIPS
    + """SELECT pu_borough, count(*) AS n_trips,
        CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM trips) AS share FROM boroughs GROUP BY pu_borough""",
    "period_by_borough": _TRIPS
    + ", rides AS (SELECT Borough AS pu_borough, "
    + _PERIOD
    + """ AS period FROM events LEFT JOIN customer ON user_id = c_custkey
           LEFT JOIN zones ON c_nationkey = LocationID)
        SELECT pu_borough, """
    + ", ".join(
        f"nullif(count(*) FILTER (period = '{p}'), 0) AS \"{p}\""
        for p in ("morning", "afternoon", "evening", "late night")
    )
    + " FROM rides GROUP BY pu_borough",
    "weekday_by_borough": _TRIPS
    + """, daily AS (SELECT pu_borough, CAST(tpep_pickup_datetime AS DATE) AS day, count(*) AS n
                    FROM boroughs GROUP BY ALL)
        SELECT pu_borough, """
    + ", ".join(f"round(avg(n) FILTER (dayname(day) = '{d}')) AS {d}" for d in WEEKDAYS)
    + " FROM daily GROUP BY pu_borough",
    "weekday_by_borough_all_days": _TRIPS
    + "SELECT pu_borough, "
    + ", ".join(
        f"""round(CAST(count(*) FILTER (dayname(tpep_pickup_datetime) = '{d}') AS DOUBLE)
            / (SELECT count(*) FROM days WHERE dayname(day) = '{d}')) AS {d}"""
        for d in WEEKDAYS
    )
    + " FROM boroughs GROUP BY pu_borough",
    "borough_averages": _TRIPS
    + """SELECT pu_borough, round(avg(trip_distance), 2) AS mean_distance, round(avg(fare_amount), 2) AS mean_fare,
        count(*) AS n_trips FROM boroughs GROUP BY pu_borough""",
    "fare_extremes_borough": _NUMBERED
    + " UNION ALL ".join(
        f"""(SELECT order_key, line_number, trip_id, fare_amount, trip_distance, pu_borough, do_borough, '{q}' AS question
            FROM boroughs ORDER BY fare_amount {o}, order_key, line_number, trip_id, trip_distance,
            pu_borough NULLS FIRST, do_borough NULLS FIRST LIMIT 3)"""
        for q, o in (("highest", "DESC NULLS LAST"), ("lowest", "NULLS FIRST"))
    ),
    "period_metrics": _TRIPS + " UNION ALL ".join([_metrics("1996", *YEAR_1), _metrics("2000", *YEAR_2)]),
    "sql_passenger_stats": _TRIPS
    + "SELECT max(passenger_count) AS max_passengers, round(avg(passenger_count), 2) AS mean_passengers FROM trips",
    "sql_busiest_hours": _TRIPS + "SELECT hour, n_trips FROM hours ORDER BY n_trips DESC, hour LIMIT 3",
    "sql_pickups_by_borough": _TRIPS
    + """SELECT Borough AS pu_borough, count(*) AS n_trips FROM trips JOIN zones ON PULocationID = LocationID
        GROUP BY Borough""",
}
