"""Streams against the same question asked of a table, restarts, and sinks."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from helpers import rows
from pyspark.sql import functions as F

from millrace.operators import edits as e
from millrace.operators import words as w
from millrace.sources import scratch, tables, topics
from millrace.streaming import run
from test_edits import NOON, message, utc

JOBS = {
    "hourly_bots": e.hourly_bots,
    "tumbling": e.tumbling,
    "sliding": e.sliding,
    "per_wiki": e.per_wiki,
    "size_types": e.size_types,
    "per_page": e.per_page,
    "per_user": e.per_user,
}


def publish(spark, path, *messages):
    topics.publish(spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1), path=path)


@pytest.mark.parametrize("name", JOBS)
def test_stream_equals_table(spark, sf_dir, name):
    job = JOBS[name]
    from_table = job(e.parse(tables.edit_messages(spark, sf_dir)))
    from_stream = run.run_to_results(job(e.parse(tables.edit_messages(spark, sf_dir, stream=True))), timeout=300)
    assert rows(w.multiset_difference(from_stream, from_table)) == [(0, 0)]


def test_sliding_counts_each_edit_twice(spark, sf_dir):
    edits = e.parse(tables.edit_messages(spark, sf_dir))
    assert e.sliding(edits).agg(F.sum("edits")).first()[0] == 2 * edits.count()


def test_results_are_replaced_as_messages_arrive(spark, tmp_path):
    topic, out, checkpoint = (str(tmp_path / name) for name in ("topic", "out", "checkpoint"))

    def totals():
        per_wiki = e.per_wiki(e.parse(topics.read_topic(spark, path=topic)))
        return rows(run.run_to_results(per_wiki, out, checkpoint, timeout=300), "wiki", "edits")

    publish(spark, topic, message(), message(wiki="en"))
    assert totals() == [("en", 1), ("fr", 1)]
    # Nothing new: the last result stands.
    assert totals() == [("en", 1), ("fr", 1)]
    for expected in (2, 3, 4):
        publish(spark, topic, message())
        assert totals() == [("en", 1), ("fr", expected)]
    # Older results are dropped.
    assert len(scratch.children(spark, out)) == 2


def test_resume_reads_only_new_lines(spark, tmp_path):
    topic, out, checkpoint = (str(tmp_path / name) for name in ("topic", "out", "checkpoint"))

    def cleaned():
        return rows(run.run_to_files(w.clean_lines(topics.read_topic(spark, path=topic)), out, checkpoint, "text", 300))

    publish(spark, topic, "Hello, the World", "the and")
    assert cleaned() == [("hello world",)]
    assert cleaned() == [("hello world",)]
    publish(spark, topic, "Fogg 0!")
    assert cleaned() == [("fogg 0",), ("hello world",)]


def test_empty_topic(spark, tmp_path):
    topic = str(tmp_path / "topic")
    (tmp_path / "topic").mkdir()
    edits = e.parse(topics.read_topic(spark, path=topic))
    assert rows(run.run_to_files(edits.select("wiki"), timeout=300)) == []
    assert rows(run.run_to_results(e.per_wiki(edits), timeout=300)) == []


def test_append_writes_closed_windows_once(spark, tmp_path):
    topic, out, checkpoint = (str(tmp_path / name) for name in ("topic", "out", "checkpoint"))

    def closed():
        windows = e.tumbling(e.parse(topics.read_topic(spark, path=topic)), watermark="10 minutes")
        return rows(run.run_to_files(windows, out, checkpoint, timeout=300), "window_start", "edits")

    publish(spark, topic, message(at=NOON), message(at=NOON + 60))
    assert closed() == []
    publish(spark, topic, message(at=NOON + 20 * 60))
    assert closed() == [(utc(2026, 2, 1, 12, 0), 2)]
    # Late for a closed window: dropped. In time for an open one: counted when it closes.
    publish(spark, topic, message(at=NOON + 120), message(at=NOON + 19 * 60), message(at=NOON + 40 * 60))
    assert closed() == [
        (utc(2026, 2, 1, 12, 0), 2), (utc(2026, 2, 1, 12, 15), 1), (utc(2026, 2, 1, 12, 20), 1)
    ]


def test_top_k_in_memory(spark, sf_dir):
    users = e.per_user(e.parse(tables.edit_messages(spark, sf_dir, stream=True)))
    result = run.run_to_memory(e.most_active(users, 3), timeout=300)
    expected = e.most_active(e.per_user(e.parse(tables.edit_messages(spark, sf_dir))), 3)
    assert rows(result) == rows(expected)


def test_console_and_continuous_batches(spark, sf_dir):
    hourly = e.hourly_bots(e.parse(tables.edit_messages(spark, sf_dir, stream=True)))
    query = run.start(hourly, "console", "complete", drain=False)
    query.processAllAvailable()
    assert query.isActive
    assert "Console" in query.lastProgress.sink.description
    query.stop()


def test_timeout_stops_the_query(spark, sf_dir):
    hourly = e.hourly_bots(e.parse(tables.edit_messages(spark, sf_dir, stream=True)))
    query = run.start(hourly, "memory", "complete", name="slow", drain=False)
    with pytest.raises(TimeoutError):
        run.finish(query, 0.2)
    assert not query.isActive


def test_settings_are_left_alone(spark, sf_dir):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")
    before = {key: spark.conf.get(key) for key in keys}
    run.run_to_memory(e.per_wiki(e.parse(tables.edit_messages(spark, sf_dir, stream=True))), timeout=300)
    assert {key: spark.conf.get(key) for key in keys} == before
    assert "RocksDB" in before[keys[1]]


def test_messages_come_back_whole(spark, tmp_path):
    topic = str(tmp_path / "topic")
    sent = ["a\rb", "c\nd", "e\r\n", "", None, " f "]
    publish(spark, topic, *sent)
    as_table = topics.read_topic(spark, path=topic, stream=False)
    as_stream = run.run_to_files(topics.read_topic(spark, path=topic), timeout=300)
    for found in (as_table, as_stream):
        assert sorted((r.value for r in found.collect()), key=repr) == sorted(sent, key=repr)


def test_table_stream_reads_a_directory(spark, sf_dir, tmp_path):
    events = tables.table(spark, sf_dir, "events")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    result = run.run_to_memory(e.per_wiki(e.parse(tables.edit_messages(spark, str(tmp_path), stream=True))), timeout=300)
    assert result.agg(F.sum("edits")).first()[0] == events.count()


def session_stub(master, **settings):
    settings.setdefault("spark_sql_warehouse_dir", "file:/here/warehouse")
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key.replace(".", "_"), default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=f"stub-{master}"))


def test_scratch_follows_the_cluster_setting():
    spark = session_stub("yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert scratch.new_path(spark, "x").startswith("hdfs:///shared/x-")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_root(session_stub("yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_root(session_stub("spark://host:7077", spark_sql_warehouse_dir="/here/warehouse"))
    assert scratch.shared_root(session_stub("local[2]")).startswith("file:/here/warehouse/")
    assert scratch.shared_root(session_stub("yarn", spark_sql_warehouse_dir="hdfs://n/w")).startswith("hdfs://n/w/")
