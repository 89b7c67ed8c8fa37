"""Files, topics and the service log."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from helpers import rows
from pyspark.sql import types as T

from millrace.operators import service
from millrace.sources import files, tables, topics


def test_csv_with_declared_schema(spark, tmp_path):
    zones = spark.createDataFrame([(264, "Unknown", "NV"), (265, "N/A", 'Outside, "far"')], files.ZONE_SCHEMA)
    files.write_csv(zones, str(tmp_path / "zones"))
    read = files.read_zones(spark, str(tmp_path / "zones"))
    assert read.schema == files.ZONE_SCHEMA
    assert rows(read) == rows(zones)


def test_csv_inferred(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("LocationID;Borough\n1;EWR\n2;Queens\n")
    read = files.read_csv(spark, str(tmp_path / "zones.csv"), sep=";", sampling_ratio=1.0)
    assert [f.dataType for f in read.schema] == [T.IntegerType(), T.StringType()]
    assert rows(read) == [(1, "EWR"), (2, "Queens")]


def test_trip_schema_is_checked(spark, sf_dir, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    trips = tables.trips(spark, sf_dir)
    trips.write.parquet(good)
    assert files.read_trips(spark, good).count() == trips.count()
    trips.drop("extra").selectExpr("* except (tip_amount)", "'x' as tip_amount").write.parquet(bad)
    with pytest.raises(ValueError, match="extra: missing, tip_amount: string"):
        files.read_trips(spark, bad)


def test_texts_and_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    assert rows(files.read_lines(spark, str(tmp_path))) == [("one",), ("two",)]
    assert rows(files.read_texts(spark, str(tmp_path)), "value") == [("one\ntwo\n",)]


def test_kafka_options():
    assert topics.kafka_source_options("kafka:19092", "edits") == {
        "kafka.bootstrap.servers": "kafka:19092",
        "subscribe": "edits",
        "startingOffsets": "earliest",
    }
    assert topics.kafka_sink_options("kafka:19092", "edits") == {
        "kafka.bootstrap.servers": "kafka:19092",
        "topic": "edits",
        "kafka.compression.type": "lz4",
    }


def test_topic_needs_one_place(spark):
    with pytest.raises(ValueError):
        topics.read_topic(spark)
    with pytest.raises(ValueError):
        topics.read_topic(spark, path="x", kafka={})
    with pytest.raises(ValueError):
        topics.publish(spark.createDataFrame([("m",)], "value string"))


def test_publish_appends_and_keeps_nulls(spark, tmp_path):
    topic = str(tmp_path / "topic")
    record = spark.createDataFrame([("a\nb", None)], "title string, user string")
    topics.publish(topics.as_json(record), path=topic)
    topics.publish(topics.as_json(record), path=topic)
    assert rows(topics.read_topic(spark, path=topic, stream=False)) == [('{"title":"a\\nb","user":null}',)] * 2


# --- service log ----------------------------------------------------------------------------

OLD, NEW = "bootcamp-5cc66bcc9b-{}", "bootcamp-7d5c7d7dc4-{}"
# Which pod answered, request by request, while version 1 was replaced by version 2.
PODS = [OLD.format(p) for p in "qk5gt qk5gt c4fpr c4fpr c4fpr qk5gt qk5gt c4fpr qk5gt c4fpr c4fpr".split()] + [
    NEW.format(p) for p in "xwvbd h4n2h xwvbd h4n2h h4n2h h4n2h h4n2h h4n2h h4n2h xwvbd xwvbd xwvbd".split()
]


def request_log(tmp_path, failures=0):
    start = datetime(2026, 10, 15, 16, 52, 11, 218433, timezone(timedelta(hours=2)))
    lines = ['"Time","ExitCode","Response"']
    for i, pod in enumerate(PODS):
        time = (start + timedelta(milliseconds=600 * i)).isoformat().replace("+02:00", "9+02:00")
        version = 1 if pod.startswith("bootcamp-5") else 2
        lines.append(f'"{time}","0","Hello! | Running on: {pod} | v={version}"')
    lines += [f'"{time}","28",""'] * failures
    path = tmp_path / "requests.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_availability(spark, tmp_path):
    log = files.read_requests(spark, request_log(tmp_path))
    [first] = log.orderBy("Time").limit(1).collect()
    # Seven digits of fraction are cut to microseconds, the offset is applied.
    assert first.Time.astimezone(timezone.utc) == datetime(2026, 10, 15, 14, 52, 11, 218433, timezone.utc)
    found = {(kind, label): n for kind, label, n in rows(service.availability(log))}
    assert found[("samples", "all")] == 23
    assert found[("failures", "all")] == 0
    assert (found[("version", "1")], found[("version", "2")]) == (11, 12)
    assert sum(n for (kind, _), n in found.items() if kind == "pod") == 23


def test_failures_have_no_version(spark, tmp_path):
    found = {(k, l): n for k, l, n in rows(service.availability(files.read_requests(spark, request_log(tmp_path, 2))))}
    assert (found[("samples", "all")], found[("failures", "all")]) == (25, 2)
    assert sum(n for (kind, _), n in found.items() if kind == "version") == 23


def test_usage_with_total(spark):
    usage = spark.createDataFrame(
        [("kube-system", "api", "61m", "238Mi"), ("default", "app", "4m", "9Mi"), ("kube-system", "etcd", "37m", "33Mi")],
        "namespace string, name string, cpu string, memory string",
    )
    report = [tuple(r) for r in service.usage_with_total(usage).collect()]
    assert report == [
        ("kube-system", "api", 0, 61, 238),
        ("kube-system", "etcd", 0, 37, 33),
        ("default", "app", 0, 4, 9),
        (None, None, 1, 102, 280),
    ]


def test_usage_units(spark):
    usage = spark.createDataFrame(
        [("n", "a", "1", "2Gi"), ("n", "a", "250m", "512Ki"), ("n", "b", "0.5", "1048576"), ("n", "c", None, "1G")],
        "namespace string, name string, cpu string, memory string",
    )
    report = {r["name"]: (r.cpu_millicores, r.memory_mib) for r in service.usage_with_total(usage).collect()}
    assert report == {"a": (1250, 2049), "b": (500, 1), "c": (None, 954), None: (1750, 3004)}
    odd = spark.createDataFrame([("n", "a", "5 apples", "1Mi")], usage.schema)
    with pytest.raises(Exception, match="no cpu quantity: 5 apples"):
        service.usage_with_total(odd).collect()


def test_empty_log_and_missing_exit_codes(spark):
    schema = "Time timestamp, ExitCode int, Response string"
    assert rows(service.availability(spark.createDataFrame([], schema))) == [("failures", "all", 0), ("samples", "all", 0)]
    log = spark.createDataFrame([(None, None, None), (None, 0, "v=1"), (None, 7, None)], schema)
    found = rows(service.availability(log))
    assert found == [("failures", "all", 1), ("samples", "all", 3), ("unknown", "all", 1), ("version", "1", 1)]
