"""Shuffles read from a log, one written here and one of this session's kind."""

from __future__ import annotations

import json

from helpers import rows

from millrace import measure


def task(stage, written, records=1):
    metrics = {"Executor CPU Time": 5, "Shuffle Write Metrics": {"Shuffle Bytes Written": written, "Shuffle Records Written": records}}
    return {"Event": "SparkListenerTaskEnd", "Stage ID": stage, "Task Metrics": metrics}


def job(number, stages, label):
    properties = {"spark.job.description": label} if label else {}
    return {"Event": "SparkListenerJobStart", "Job ID": number, "Stage IDs": stages, "Properties": properties, "Stage Infos": [{"x": 1}]}


def test_shuffles_of_a_log(spark, tmp_path):
    events = [
        {"Event": "SparkListenerLogStart", "Spark Version": "4"},
        job(0, [0, 1], "one"), task(0, 10), task(0, 20, 3), task(1, 0, 0),
        job(1, [0, 2, 3], "two"), task(2, 7), task(3, 0, 0),
        job(2, [4], None), task(4, 99),
        {"Event": "SparkListenerTaskEnd", "Stage ID": 5},
    ]
    (tmp_path / "log").write_text("\n".join(map(json.dumps, events)))
    assert rows(measure.shuffles(spark, str(tmp_path / "log"))) == [("one", 1, 30, 4, 15), ("two", 1, 7, 1, 10)]


def test_an_empty_log(spark, tmp_path):
    (tmp_path / "log").write_text("")
    assert rows(measure.shuffles(spark, str(tmp_path / "log"))) == []
