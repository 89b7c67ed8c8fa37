"""Time the headline queries: whole result to the no-op sink, one warm-up round, median of the others.

The tables are first dealt into files of their own, outside the clock: as one row group each they would keep one
core busy. One more round counts the shuffles of each query and the bytes they wrote, from Spark's event log (null for
streams, whose jobs carry labels of their own).
Prints one JSON line. Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS (3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import tempfile
import time
from pathlib import Path

from millrace import measure
from millrace.operators import trips as tr
from millrace.plans.registry import QUERIES
from millrace.plans.trips import YEAR_1
from millrace.session import session
from millrace.sources import tables

HEADLINE = (
    "word_count",
    "word_count_late_clean",
    "language_stats",
    "clean_lines",
    "clean_lines_summary",
    "trips_with_boroughs",
    "trips_quality",
    "trips_extremes",
    "period_by_borough",
    "weekday_by_borough",
    "borough_averages",
    "edits_tumbling",
    "edits_sliding",
    "edits_sliding_stream",
    "service_availability",
    "usage_with_total",
)


def to_nowhere(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def quality_by_separate_counts(spark, sf_dir: str) -> None:
    """The one-pass quality report as one job per count, for comparison."""
    trips = tr.with_duration(
        tables.trips(
            spark, sf_dir, [tr.PICKUP, tr.DROPOFF, "passenger_count", "trip_distance", "fare_amount"]
        )
    )
    for test in (
        "passenger_count = 0",
        "passenger_count IS NULL",
        "trip_distance = 0",
        "fare_amount < 0",
        "duration_min <= 0",
        "duration_min > 1440",
        "true",
    ):
        trips.where(test).count()
    tr.in_period(trips, *YEAR_1).count()


TABLES = ("documents", "events", "lineitem", "orders", "customer", "supplier", "nation", "region")


def dealt(spark, sf_dir: str, folder: str, files: int) -> str:
    """The tables as several files each."""
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def moved(spark, jobs: dict, logs: str) -> dict[str, tuple[int, int]]:
    """Shuffles and bytes written per job; the last round of the session, since it closes it."""
    for name, job in jobs.items():
        spark.sparkContext.setJobDescription(f"count {name}")
        job()
    app = spark.sparkContext.applicationId
    spark.stop()
    reader = session("counts", "local[1]", spark__eventLog__enabled="false", spark__ui__showConsoleProgress="false")
    reader.sparkContext.setLogLevel("ERROR")
    found = measure.shuffles(reader, str(next(Path(logs).glob(f"{app}*")))).where("label like 'count %'").collect()
    reader.stop()
    return {r["label"].removeprefix("count "): (r["shuffles"], r["shuffle_bytes"]) for r in found}


def median_times(jobs: dict, runs: int) -> dict[str, float]:
    """Run all jobs in rounds, so that all of them meet the JVM equally warm; the first round does not count."""
    times = {name: [] for name in jobs}
    for _ in range(runs + 1):
        for name, job in jobs.items():
            start = time.perf_counter()
            job()
            times[name].append(time.perf_counter() - start)
    return {name: statistics.median(taken[1:]) for name, taken in times.items()}


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        print(json.dumps(measured(scratch)))


def measured(scratch: str) -> dict:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    logs = f"{scratch}/logs"
    os.mkdir(logs)
    spark = session(
        "bench",
        f"local[{cpus}]",
        spark__driver__memory="12g",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=f"{scratch}/warehouse",
        spark__eventLog__dir=f"file://{logs}",
        **{key.replace(".", "__"): value for key, value in measure.LOGGED.items()},
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = dealt(spark, sf_dir, f"{scratch}/tables", int(cpus))
    jobs = {name: lambda query=QUERIES[name]: to_nowhere(query(spark, folder)) for name in HEADLINE}
    jobs["trips_quality_separate_counts"] = lambda: quality_by_separate_counts(spark, folder)
    seconds = median_times(jobs, runs)
    counted = moved(spark, jobs, logs)
    scale = re.search(r"sf([\d.]+)$", sf_dir)
    return {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "shuffles": {name: counted.get(name, (None, None))[0] for name in jobs},
        "shuffle_bytes": {name: counted.get(name, (None, None))[1] for name in jobs},
        "sf": float(scale.group(1)) if scale else sf_dir,
        "cpus": int(cpus),
        "rounds": runs,
    }


if __name__ == "__main__":
    main()
