"""Several answers from one reading, kept totals, repeated and broken-off batches."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F

from millrace.operators import edits as e
from millrace.plans import edits as plans
from millrace.plans import text
from millrace.sources import scratch, tables, topics
from millrace.streaming import fanout, run
from millrace.streaming.heavy import Heavy
from millrace.streaming.totals import Totals
from test_edits import NOON, edits as as_edits, message, topic as as_topic
from test_streaming import publish

NAMES = ("per_wiki", "per_page", "sliding")  # all six: the query `edits_answers_stream`


def answers():
    return {name: e.kept(e.REPORTS[name], buckets=3) for name in NAMES} | {
        "titles": fanout.Appended(lambda edits: edits.select("title"))
    }


def stream(spark, topic):
    return e.parse(topics.read_topic(spark, path=topic, max_files_per_trigger=1))


@pytest.fixture
def deliveries(spark, tmp_path):
    topic = str(tmp_path / "topic")
    sent = []
    for n in range(4):
        part = [message(f"P{i % 5}", f"u{i % 3}", NOON + 60 * i, new=100 + 7 * i - 20 * n, wiki=["fr", None][i % 2]) for i in range(n, n + 6)]
        publish(spark, topic, *part)
        sent += part
    return topic, sent


def test_each_message_is_read_once(spark, deliveries, tmp_path):
    topic, sent = deliveries
    query = fanout.start(stream(spark, topic), answers(), str(tmp_path / "out"))
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress] == [6] * 4
    found = fanout.read(spark, answers(), str(tmp_path / "out"), stream(spark, topic).schema)
    edits = as_edits(spark, *sent)
    for name in NAMES:
        assert rows(found[name]) == rows(e.summary(edits, e.REPORTS[name]))
    assert rows(found["titles"]) == rows(edits, "title")


def test_a_repeated_batch_changes_nothing(spark, deliveries, tmp_path):
    topic, sent = deliveries
    out = str(tmp_path / "out")
    before = {name: rows(frame) for name, frame in fanout.drain(stream(spark, topic), answers(), out).items()}
    batch = as_edits(spark, *sent[-6:])
    for name, answer in answers().items():
        answer.take(batch, 3, f"{out}/{name}")
    schema = stream(spark, topic).schema
    assert {name: rows(frame) for name, frame in fanout.read(spark, answers(), out, schema).items()} == before


def test_a_batch_that_broke_off_is_done_again(spark, deliveries, tmp_path):
    """One answer has the batch, one fails: the stream stops, and goes on with the same batch."""
    topic, sent = deliveries
    out = str(tmp_path / "out")
    fails = [True]

    def breaking(edits):
        if edits.limit(1).count() and fails[0]:
            raise RuntimeError("broken off")
        return edits.select("title")

    chosen = {"per_page": e.kept(e.REPORTS["per_page"], buckets=3), "titles": fanout.Appended(breaking)}
    with pytest.raises(Exception, match="broken off"):
        fanout.drain(stream(spark, topic), chosen, out)
    fails[0] = False
    found = fanout.drain(stream(spark, topic), chosen, out)
    assert rows(found["per_page"]) == rows(e.per_page(as_edits(spark, *sent)))
    assert found["titles"].count() == len(sent)


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = Totals(str(tmp_path / "t"), ("k",), {"n": "sum", "low": "min", "high": "max"}, buckets=4)

    def batch(n, *keys):
        table.merge(spark.createDataFrame([(k, 1, n, n) for k in keys], "k string, n long, low int, high int"), n)

    schema = spark.createDataFrame([], "k string, n long, low int, high int").schema
    assert rows(table.read(spark, schema)) == [] and table.last_batch(spark) is None
    batch(0, *"abcdefgh", None)
    files = {f for f in scratch.children(spark, f"{table.path}/data/0") if f.startswith("_bucket")}
    batch(1, "a")
    assert len([f for f in scratch.children(spark, f"{table.path}/data/1") if f.startswith("_bucket")]) == 1 < len(files)
    batch(2, "a", None)
    found = dict((r["k"], tuple(r)[1:]) for r in table.read(spark, schema).collect())
    assert found["a"] == (3, 0, 2) and found["b"] == (1, 0, 0) and found[None] == (2, 0, 2) and len(found) == 9
    batch(3, "z")
    batch(4)
    # What no kept manifest names is gone.
    assert len(scratch.children(spark, f"{table.path}/manifests")) - len([0 for n in scratch.children(spark, f"{table.path}/manifests") if not n.isdecimal()]) == 2
    held = [(v, b) for v in scratch.children(spark, f"{table.path}/data") for b in scratch.children(spark, f"{table.path}/data/{v}") if b.startswith("_bucket")]
    assert len(held) == len({b for _, b in held}) and table.read(spark, schema).count() == 10


def test_a_batch_without_its_manifest_is_not_there(spark, tmp_path):
    table = Totals(str(tmp_path / "t"), ("k",), {"n": "sum"}, buckets=2)
    frame = spark.createDataFrame([("a", 1)], "k string, n long")
    table.merge(frame, 0)
    table.merge(frame, 1)
    os.remove(tmp_path / "t/manifests/1/_SUCCESS")
    assert rows(table.read(spark, frame.schema)) == [("a", 1)]
    table.merge(frame, 1)
    assert rows(table.read(spark, frame.schema)) == [("a", 2)]


def test_parts_of_halves_merge(spark, sf_dir):
    half = [[message(f"P{i % 3}", bot=i % 4 == 0, new=90 + i * k, at=NOON + 100 * i) for i in range(9)] for k in (1, 5)]
    for report in e.REPORTS.values():
        both = e.partial(as_edits(spark, *half[0]), report).unionByName(e.partial(as_edits(spark, *half[1]), report))
        whole = e.summary(as_edits(spark, *half[0], *half[1]), report)
        assert rows(e.finish(e.merge(both, report), report)) == rows(whole)


def test_late_groups_are_counted(spark, tmp_path):
    topic = str(tmp_path / "topic")
    hour = 3600
    for times in ([0, 1], [3 * hour], [4 * hour], [2, 4 * hour + 1], [9 * hour]):
        publish(spark, topic, *[message(at=NOON + t) for t in times])
    result = e.hourly_bots(stream(spark, topic), watermark="1 hour")
    query = run.start(result, "parquet", "append", path=str(tmp_path / "out"))
    run.finish(query)
    found = rows(run.batches(query).where("messages > 0"))
    assert found == [(0, 2, 0), (1, 1, 0), (2, 1, 0), (3, 2, 1), (4, 1, 0)]
    written = spark.read.parquet(str(tmp_path / "out")).agg(F.sum("edit_count")).first()[0]
    assert written == 2 + 1 + 2  # without the late one, and without the hour that is still open


def topic_files(spark, path):
    return [n for n in scratch.children(spark, path) if n.startswith("part-")]


@pytest.mark.parametrize("n", [0, 2, 40])
def test_a_delivery_has_so_many_files(spark, tmp_path, n):
    """Also with fewer messages than files, or with none."""
    sent = spark.range(n).select(F.col("id").cast("string").alias("value"))
    for done in (1, 2):
        topics.publish(sent, path=str(tmp_path / "t"), files=5)
        assert len(topic_files(spark, str(tmp_path / "t"))) == 5 * done
    assert topics.read_topic(spark, path=str(tmp_path / "t"), stream=False).count() == 2 * n


def test_deliveries_of_many_files_are_batches(spark, tmp_path, monkeypatch):
    """Every delivery is one batch, whatever its files; no task writes a whole one."""
    days = "timestamp'2024-01-01 00:00:00' + make_dt_interval(pmod(id * id, 27), 0, 0, id)"
    made = spark.range(900).selectExpr(
        "id as event_id", f"{days} as ts", "id % 7 as user_id", "'view' as event_type", "double(id % 90) as value", """'{"k": 3}' as props"""
    )
    made.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setitem(tables.FILE_BYTES, "events", 300)
    files = tables.files_per_delivery(spark, str(tmp_path))
    topic = str(tmp_path / "topic")
    tables.deliver(spark, str(tmp_path), topic)
    assert files > 1 and len(topic_files(spark, topic)) == files * tables.DELIVERIES
    want = {r[0]: r[1] for r in made.groupBy(tables.delivery()).count().collect()}
    late = plans.edits_late_groups(spark, str(tmp_path))
    assert dict(rows(late, "batch", "messages")) == want
    sent = topics.read_topic(spark, path=topic, stream=False)
    assert sent.count() == 900 and sent.groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0] < max(want.values())
    assert rows(plans.edits_per_page_kept(spark, str(tmp_path))) == rows(plans.edits_per_page(spark, str(tmp_path)))


def test_lines_delivered_in_many_files(spark, tmp_path, monkeypatch):
    made = [(i, f"the word{i % 3} of {i}\n\nand" if i % 4 else None) for i in range(100)]
    spark.createDataFrame(made, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setitem(tables.FILE_BYTES, "documents", 100)
    files = tables.files_per_delivery(spark, str(tmp_path), "documents", 8)
    before = {n for n in scratch.children(spark, scratch.shared_root(spark)) if n.startswith("topic-")}
    found = rows(plans.clean_lines_totals_stream(spark, str(tmp_path)))
    [topic] = {n for n in scratch.children(spark, scratch.shared_root(spark)) if n.startswith("topic-")} - before
    assert files > 1 and len(topic_files(spark, f"{scratch.shared_root(spark)}/{topic}")) == 8 * files
    table = text.clean_lines_summary(spark, str(tmp_path))
    written = text.clean_lines(spark, str(tmp_path)).count()
    assert found == sorted([*rows(table), ("check", "lines in the output", written)], key=repr)


def test_an_empty_topic_has_empty_answers(spark, tmp_path):
    (tmp_path / "topic").mkdir()
    found = fanout.drain(stream(spark, str(tmp_path / "topic")), answers(), str(tmp_path / "out"))
    assert all(rows(frame) == [] for frame in found.values())
    assert e.parse(as_topic(spark)).count() == 0


def test_counters_keep_their_bounds(spark, tmp_path):
    """A key with a third of the rows, a long tail, and keys that come late."""
    keys = [["hot"] * 40 + [f"t{n * 40 + i}" for i in range(60)] + [f"w{i % 4}" for i in range(20 * (n > 2))] for n in range(6)]
    schema = spark.createDataFrame([], "k string").schema
    answer = Heavy(lambda rows: rows.groupBy("k").agg(F.count("*").alias("n")), ("k",), counters=8)
    for n, batch in enumerate(keys):
        frame = spark.createDataFrame([(k,) for k in batch], schema)
        answer.take(frame, n, str(tmp_path / "h"))
        answer.take(frame, n, str(tmp_path / "h"))
    found = {r["k"]: r for r in answer.read(spark, str(tmp_path / "h"), schema).where("not whole").collect()}
    [rest] = answer.read(spark, str(tmp_path / "h"), schema).where("whole").collect()
    exact = Counter(k for batch in keys for k in batch)
    assert rest["at_most"] <= sum(exact.values()) // 9 and len(found) <= 8
    for k, n in exact.items():
        low, high = (found[k]["at_least"], found[k]["at_most"]) if k in found else (0, rest["at_most"])
        assert low <= n <= high
    assert found["hot"]["at_least"] > 100
    assert len([n for n in scratch.children(spark, str(tmp_path / "h")) if n.isdecimal()]) == 2


def test_few_keys_are_counted_exactly(spark, tmp_path):
    schema = spark.createDataFrame([], "k string").schema
    answer = Heavy(lambda rows: rows.groupBy("k").agg(F.count("*").alias("n")), ("k",), counters=3)
    assert rows(answer.read(spark, str(tmp_path / "h"), schema)) == []
    for n in range(3):
        answer.take(spark.createDataFrame([("a",), (None,), ("a",)], schema), n, str(tmp_path / "h"))
    answer.take(spark.createDataFrame([], schema), 3, str(tmp_path / "h"))
    found = answer.read(spark, str(tmp_path / "h"), schema).where("not whole").drop("whole")
    assert rows(found) == [("a", 6, 6), (None, 3, 3)]
