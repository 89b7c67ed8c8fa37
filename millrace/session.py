"""Session settings the jobs are written for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Adaptive execution sizes shuffles, splits skewed join partitions and turns a
    # sort-merge join into a broadcast join once the real size of a side is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Windows and epoch conversions are shown in the session zone.
    "spark.sql.session.timeZone": "UTC",
    # State of streaming queries outside the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}


def session(app: str = "millrace", master: str | None = None, **settings: str) -> SparkSession:
    """Create or get a session; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, **wanted: str) -> Iterator[None]:
    """Session settings (``__`` for dots) for the jobs run inside; what was set before comes back."""
    keys = {key.replace("__", "."): value for key, value in wanted.items()}
    before = {key: spark.conf.get(key, None) for key in keys}
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
