"""Edit jobs on small literal messages, as tables."""

from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from millrace.operators import edits as e
from millrace.plans import edits as plans

NOON = 1769947200  # 2026-02-01 12:00:00 UTC


def message(title="P", user="u", at=NOON, kind="edit", wiki="fr", namespace=0, bot=False, old=100, new=100, **more):
    return json.dumps(
        {"title": title, "user": user, "timestamp": at, "type": kind, "wiki": wiki, "namespace": namespace, "bot": bot,
         "minor": False, "length": {"old": old, "new": new}, **more}
    )


def topic(spark, *messages):
    values = [(m.encode() if m is not None else None,) for m in messages]
    return spark.createDataFrame(values, "value binary")


def edits(spark, *messages):
    return e.parse(topic(spark, *messages))


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc).astimezone().replace(tzinfo=None)


def test_parse(spark):
    [row] = edits(spark, message(new=250, comment="é \"quoted\"", unknown=1)).collect()
    assert (row.title, row.wiki, row.bot, row.comment, row.length.new, row.size_diff) == ("P", "fr", False, 'é "quoted"', 250, 150)
    assert row.event_time == utc(2026, 2, 1, 12)


BAD = ["{bad", "", None, "[]", "7", "{}"]


def test_rejects(spark):
    messages = topic(spark, *BAD, message(), message(namespace="zero"))
    assert rows(e.rejects(messages)) == sorted(((m,) for m in BAD), key=repr)
    kept = e.parse(messages)
    assert rows(kept, "wiki", "namespace") == [("fr", 0), ("fr", None)]
    everything = e.parse(messages, keep_rejects=True)
    assert everything.columns == kept.columns
    assert everything.count() == len(BAD) + 2
    assert everything.where("wiki is null").count() == len(BAD)


def test_each_message_is_parsed_once(spark, sf_dir):
    for query in (plans.edits_per_wiki, plans.edits_rejects, plans.edits_filtered):
        assert plan(query(spark, sf_dir)).count("from_json(") == 1


def test_repeated_hour(spark):
    # Both are 02:30 on the clock in Paris, one hour apart.
    result = edits(spark, message(at=1761438600), message(at=1761442200))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        assert result.select(F.unix_timestamp("event_time")).distinct().count() == 2
        assert e.hourly_bots(result).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_select_edits(spark):
    result = edits(spark, message("a"), message("b", wiki="en"), message("c", namespace=1), message("d", kind="log"))
    assert rows(e.select_edits(result, "fr", 0, "edit"), "title") == [("a",)]
    assert rows(e.select_edits(result, kind="edit"), "title") == [("a",), ("b",), ("c",)]
    assert rows(e.select_edits(result), "title") == [("a",), ("b",), ("c",), ("d",)]


def test_sign_buckets(spark):
    result = edits(spark, message(new=105), message(new=97), message(), message(new=None), message(new=90))
    assert rows(e.size_types(result)) == [
        ("fr", "addition", 1, 5.0, 5), ("fr", "removal", 2, 6.5, 10), ("fr", "same size", 2, 0.0, 0)
    ]
    assert rows(e.size_types(result, name_unknown=True), "change", "edits") == [
        ("addition", 1), ("removal", 2), ("same size", 1), ("unknown", 1)
    ]


def test_sliding(spark):
    result = e.sliding(edits(spark, message(at=NOON + 420, new=130), message(at=NOON + 420, new=80), message(at=NOON + 420, new=None)))
    counted = ("fr", 3, 30, 20)
    assert rows(result) == [
        (utc(2026, 2, 1, 12, 0), utc(2026, 2, 1, 12, 10), *counted),
        (utc(2026, 2, 1, 12, 5), utc(2026, 2, 1, 12, 15), *counted),
    ]


def test_missing_time_is_in_totals_only(spark):
    result = edits(spark, message(at=None), message())
    assert rows(e.per_wiki(result), "wiki", "edits") == [("fr", 2)]
    assert rows(e.tumbling(result), "edits") == [(1,)]
    assert e.sliding(result).count() == 2


def test_tumbling(spark):
    result = e.tumbling(edits(spark, message(new=101), message(at=NOON + 299, new=102), message(at=NOON + 300), message(bot=True)))
    assert rows(result, "window_start", "bot", "edits", "mean_size_diff") == [
        (utc(2026, 2, 1, 12, 0), False, 2, 1.5),
        (utc(2026, 2, 1, 12, 0), True, 1, 0.0),
        (utc(2026, 2, 1, 12, 5), False, 1, 0.0),
    ]


def test_bot_percentage(spark):
    [row] = e.per_wiki(edits(spark, message(bot=True), message(), message(at=NOON + 60))).collect()
    assert (row.edits, row.bot_percent) == (3, 33.3)
    assert (row.earliest_edit, row.latest_edit) == (utc(2026, 2, 1, 12, 0), utc(2026, 2, 1, 12, 1))


def test_biggest_pages_in_either_direction(spark):
    result = edits(spark, message("up", new=150), message("down", new=0), message("down", new=90), message("flat"))
    assert [tuple(r) for r in e.biggest_pages(e.per_page(result), 2).collect()] == [("fr", "down", 2, -110), ("fr", "up", 1, 50)]


def test_users_and_shares(spark):
    result = edits(spark, message(user="x"), message(user="x"), message(user="y", new=101), message(user="z", wiki=None))
    assert [tuple(r) for r in e.most_active(e.per_user(result), 1).collect()] == [("fr", "x", False, 2)]
    shares = {(r.wiki, r.user): r.share for r in e.user_shares(result).collect()}
    assert shares == {("fr", "x"): pytest.approx(2 / 3), ("fr", "y"): pytest.approx(1 / 3), (None, "z"): 1.0}
    assert rows(e.change_shares(edits(spark, message(), message(new=101))), "change", "share") == [
        ("addition", 0.5), ("same size", 0.5)
    ]


def test_user_shares_reads_the_edits_once(spark, sf_dir):
    result = plans.active_user_shares(spark, sf_dir)
    result.collect()
    assert "ReusedExchange" in plan(result)
