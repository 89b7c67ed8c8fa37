"""Registered edit and service-log queries, each with the SQL that must give the same rows.

Names ending in ``_stream`` answer the same question from a stream of messages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.stopwords import ENGLISH
from millrace.operators import edits as e
from millrace.operators import numbering, service
from millrace.operators import words as w
from millrace.plans import text
from millrace.plans.sql import SPACE, half_up, quoted
from millrace.sources import scratch, tables, topics
from millrace.streaming import fanout, heavy, run


def _edits(spark, sf):
    return e.parse(tables.edit_messages(spark, sf))


def _stream(spark, sf):
    return e.parse(tables.edit_messages(spark, sf, stream=True))


def _flat(edits: DataFrame) -> DataFrame:
    """Sizes as plain columns."""
    return edits.select(
        *[name for name in edits.columns if name != "length"],
        F.col("length.old").alias("old_length"),
        F.col("length.new").alias("new_length"),
    )


def edits_parse(spark, sf):
    return _flat(_edits(spark, sf))


def edits_rejects(spark, sf):
    return e.rejects(tables.edit_messages(spark, sf, damaged=True))


def edits_accepted(spark, sf):
    """What is left of a topic with damaged messages, and what parsing keeps when rejects stay."""
    messages = tables.edit_messages(spark, sf, damaged=True)
    kept = e.parse(messages, keep_rejects=True)
    return kept.groupBy("wiki").agg(F.count("*").alias("edits"))


def edits_filtered(spark, sf):
    return _flat(e.select_edits(_edits(spark, sf), wiki="view", namespace=0, kind="edit"))


def edits_per_wiki(spark, sf):
    return e.per_wiki(_edits(spark, sf))


def edits_hourly_bots(spark, sf):
    return e.hourly_bots(_edits(spark, sf))


def edits_tumbling(spark, sf):
    return e.tumbling(_edits(spark, sf))


def edits_sliding(spark, sf):
    return e.sliding(_edits(spark, sf))


def edit_size_types(spark, sf):
    return e.size_types(_edits(spark, sf))


def edits_per_page(spark, sf):
    return e.per_page(_edits(spark, sf))


def biggest_pages(spark, sf):
    return e.biggest_pages(e.per_page(_edits(spark, sf)))


def edits_per_user(spark, sf):
    return e.per_user(_edits(spark, sf))


def active_users(spark, sf):
    return e.most_active(e.per_user(_edits(spark, sf)))


def edit_shares(spark, sf):
    return e.change_shares(_edits(spark, sf))


def active_user_shares(spark, sf):
    return e.user_shares(_edits(spark, sf))


def edits_publish_roundtrip(spark, sf):
    """Edits of type "edit" published as JSON messages and read back as a table."""
    topic = scratch.new_path(spark, "topic")
    edits = tables.as_edits(tables.table(spark, sf, "events"))
    topics.publish(topics.as_json(e.select_edits(edits, kind="edit")), path=topic)
    return _flat(e.parse(topics.read_topic(spark, path=topic, stream=False)))


def edits_stream_scan(spark, sf):
    return run.run_to_files(_flat(_stream(spark, sf)))


def edits_per_wiki_stream(spark, sf):
    return run.run_to_results(e.per_wiki(_stream(spark, sf)))


def edits_hourly_bots_stream(spark, sf):
    return run.run_to_results(e.hourly_bots(_stream(spark, sf)))


def edits_tumbling_stream(spark, sf):
    return run.run_to_results(e.tumbling(_stream(spark, sf)))


def edits_sliding_stream(spark, sf):
    return run.run_to_results(e.sliding(_stream(spark, sf)))


def edits_tumbling_append(spark, sf):
    """Windows that can no longer change, each written once; the last open ones are not."""
    return run.run_to_files(e.tumbling(_stream(spark, sf), watermark="10 minutes"))


def edits_hourly_append(spark, sf):
    """As ``edits_tumbling_append``, by the hour: state is dropped with the window."""
    return run.run_to_files(e.hourly_bots(_stream(spark, sf), watermark="10 minutes"))


def edits_sliding_append(spark, sf):
    """As ``edits_tumbling_append``, for windows that overlap."""
    return run.run_to_files(e.sliding(_stream(spark, sf), watermark="10 minutes"))


def edit_size_types_stream(spark, sf):
    return run.run_to_results(e.size_types(_stream(spark, sf)))


def biggest_pages_stream(spark, sf):
    return run.run_to_memory(e.biggest_pages(e.per_page(_stream(spark, sf))))


def active_users_stream(spark, sf):
    return run.run_to_memory(e.most_active(e.per_user(_stream(spark, sf))))


def stream_clean_lines(spark, sf):
    """Document lines as a stream, cleaned and appended to text files."""
    lines = w.text_lines(tables.documents(spark, sf, stream=True), "text").select(F.col("line").alias("value"))
    return run.run_to_files(w.clean_lines(lines), file_format="text")


def stream_resume(spark, sf):
    """Two runs over one topic; more messages arrive in between and only those are read again."""
    topic, out, checkpoint = (scratch.new_path(spark, name) for name in ("topic", "lines", "checkpoint"))
    lines = w.text_lines(tables.documents(spark, sf), "text", ["lang"]).withColumnRenamed("line", "value")
    english = F.col("lang") == "en"
    for delivery in (lines.where(english), lines.where(~english)):
        topics.publish(delivery, path=topic)
        cleaned = w.clean_lines(topics.read_topic(spark, path=topic))
        rows = run.run_to_files(cleaned, out, checkpoint, "text")
    return rows


def _delivered(spark, sf):
    """Edits of a topic in ten deliveries, some messages late; a stream of one delivery per micro-batch."""
    topic = scratch.new_path(spark, "topic")
    tables.deliver(spark, sf, topic)
    return e.parse(topics.read_topic(spark, path=topic, max_files_per_trigger=tables.files_per_delivery(spark, sf)))


LATENESS = "1 hour"


def edits_hourly_late(spark, sf):
    """Closed hours over ten batches; edits that come after their hour was closed are left out."""
    return run.run_to_files(e.hourly_bots(_delivered(spark, sf), watermark=LATENESS))


def edits_tumbling_late(spark, sf):
    """As ``edits_hourly_late``, for windows of five minutes."""
    return run.run_to_files(e.tumbling(_delivered(spark, sf), watermark=LATENESS))


def edits_sliding_late(spark, sf):
    """As ``edits_hourly_late``; a late edit may miss one of its windows and be in time for the other."""
    return run.run_to_files(e.sliding(_delivered(spark, sf), watermark=LATENESS))


def edits_late_groups(spark, sf):
    """Messages per batch, and groups of an hour and a flag that came too late for their window."""
    query = run.start(
        e.hourly_bots(_delivered(spark, sf), watermark=LATENESS), "parquet", "append", path=scratch.new_path(spark, "rows")
    )
    run.finish(query)
    return run.batches(query).where("messages > 0")


ANSWERS = ("per_wiki", "tumbling", "sliding", "size_types", "per_page", "per_user")


def _long(answer, report, name):
    """Figures as rows: question, group, figure and value; times as seconds."""
    def text(c):
        seconds = answer.schema[c].dataType.typeName() == "timestamp"
        return F.coalesce((F.unix_timestamp(c) if seconds else F.col(c)).cast("string"), F.lit("null"))

    def number(c):
        return (F.unix_timestamp(c) if answer.schema[c].dataType.typeName() == "timestamp" else F.col(c)).cast("double")

    group = F.concat_ws("|", *[text(key) for key in report.group])
    figures = F.array(*[F.struct(F.lit(f).alias("figure"), number(f).alias("value")) for f in report.figures])
    return answer.select(F.lit(name).alias("question"), group.alias("part_of"), F.inline(figures))


def edits_answers_stream(spark, sf):
    """Six reports from one reading of the topic, merged over ten batches."""
    edits = _delivered(spark, sf)
    reports = {name: e.REPORTS[name] for name in ANSWERS}
    answers = {name: e.kept(report, buckets=4) for name, report in reports.items()}
    found = fanout.drain(edits, answers, scratch.new_path(spark, "answers"))
    return reduce(DataFrame.unionByName, [_long(found[name], reports[name], name) for name in ANSWERS])


def _kept_after_restart(spark, sf, name):
    """A report kept over the deliveries, which come in two parts with a new query for each."""
    topic, path = scratch.new_path(spark, "topic"), scratch.new_path(spark, "answers")
    answers = {name: e.kept(e.REPORTS[name], buckets=4)}
    for part in (range(3), range(3, tables.DELIVERIES)):
        tables.deliver(spark, sf, topic, part)
        files = 2 * tables.files_per_delivery(spark, sf)
        edits = e.parse(topics.read_topic(spark, path=topic, max_files_per_trigger=files))
        found = fanout.drain(edits, answers, path)
    return found[name]


def edits_per_page_kept(spark, sf):
    return _kept_after_restart(spark, sf, "per_page")


def edits_per_user_kept(spark, sf):
    return _kept_after_restart(spark, sf, "per_user")


def heavy_users_stream(spark, sf):
    """The most active users from counters of fixed size, held against the exact totals of the same reading."""
    edits = _delivered(spark, sf)
    report = e.REPORTS["per_user"]
    answers = {
        "heavy": heavy.Heavy(lambda rows: e.partial(rows, report), report.keys, counters=40),
        "exact": e.kept(report, buckets=4),
    }
    found = fanout.drain(edits, answers, scratch.new_path(spark, "answers"))
    counters = found["heavy"].where("not whole")
    lacking = found["heavy"].where("whole").select("at_most").scalar()
    top = e.most_active(found["exact"], 10)
    same = [top[key].eqNullSafe(counters[key]) for key in report.keys]
    told = top.join(counters, reduce(Column.__and__, same), "left").select(*[top[key] for key in report.keys], "edits", "at_least", "at_most")
    within = (F.coalesce("at_least", F.lit(0)) <= F.col("edits")) & (F.col("edits") <= F.coalesce("at_most", lacking))
    return told.select(*report.keys, "edits", within.alias("within_bounds"))


def clean_lines_totals_stream(spark, sf):
    """Messages read, lines written and top words of a topic of lines in eight deliveries, beside the cleaned lines.

    A delivery is one micro-batch, of so many files that none is large.
    """
    topic = scratch.new_path(spark, "topic")
    lines = w.text_lines(tables.documents(spark, sf), "text", ["doc_id"]).withColumnRenamed("line", "value")
    files = tables.files_per_delivery(spark, sf, "documents", 8)
    for n in range(8):
        topics.publish(lines.where(F.pmod("doc_id", F.lit(8)) == n), path=topic, files=files)
    answers = {
        "lines": fanout.Appended(w.clean_lines),
        "totals": fanout.Kept(w.line_items, ("item",), {"n": "sum"}, w.lines_report, buckets=4),
    }
    stream = topics.read_topic(spark, path=topic, max_files_per_trigger=files)
    found = fanout.drain(stream, answers, scratch.new_path(spark, "answers"))
    written = found["lines"].agg(F.lit("check").alias("kind"), F.lit("lines in the output").alias("item"), F.count("*").alias("n"))
    return found["totals"].unionByName(written)


def service_availability(spark, sf):
    return service.availability(tables.requests(spark, sf))


def usage_with_total(spark, sf):
    return service.usage_with_total(tables.usage(spark, sf))


def usage_with_total_placed(spark, sf):
    """The report with the place of each row: namespaces and names in order, the total last."""
    return numbering.number_rows(usage_with_total(spark, sf), "place", ["is_total", "namespace", "name"])


QUERIES = {
    f.__name__: f
    for f in (
        edits_parse,
        edits_rejects,
        edits_accepted,
        edits_filtered,
        edits_per_wiki,
        edits_hourly_bots,
        edits_tumbling,
        edits_sliding,
        edit_size_types,
        edits_per_page,
        biggest_pages,
        edits_per_user,
        active_users,
        edit_shares,
        active_user_shares,
        edits_publish_roundtrip,
        edits_stream_scan,
        edits_per_wiki_stream,
        edits_hourly_bots_stream,
        edits_tumbling_stream,
        edits_sliding_stream,
        edits_tumbling_append,
        edits_hourly_append,
        edits_sliding_append,
        edit_size_types_stream,
        biggest_pages_stream,
        active_users_stream,
        stream_clean_lines,
        stream_resume,
        edits_hourly_late,
        edits_tumbling_late,
        edits_sliding_late,
        edits_late_groups,
        edits_answers_stream,
        edits_per_page_kept,
        edits_per_user_kept,
        heavy_users_stream,
        clean_lines_totals_stream,
        service_availability,
        usage_with_total,
        usage_with_total_placed,
    )
}

# --- SQL ------------------------------------------------------------------------------------

_EDITS = r"""WITH pages AS (
    SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k, CAST(round(value) AS INTEGER) - 50 AS diff
    FROM events),
edits AS (
    SELECT CAST(k AS VARCHAR) AS title, CAST(user_id AS VARCHAR) AS user, epoch_us(ts) // 1000000 AS timestamp,
           CASE WHEN value < 5 THEN 'new' ELSE 'edit' END AS type, event_type AS wiki, k // 25 AS namespace,
           user_id % 5 = 0 AS bot, value < 20 AS minor, props AS comment, date_trunc('second', ts) AS event_time,
           diff AS size_diff, 100 AS old_length, diff + 100 AS new_length
    FROM pages),
sized AS (
    SELECT *, CASE WHEN size_diff > 0 THEN 'addition' WHEN size_diff < 0 THEN 'removal' ELSE 'same size' END AS change
    FROM edits),
users AS (SELECT wiki, "user", bot, count(*) AS edits FROM edits GROUP BY ALL),
page_totals AS (SELECT wiki, title, count(*) AS edits, CAST(sum(size_diff) AS BIGINT) AS net_size_diff
                FROM edits GROUP BY ALL)
"""
_ALL = "SELECT * FROM edits"
_TUMBLING = (
    f"""SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
        time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end, wiki, bot,
        count(*) AS edits, {half_up("sum(size_diff)", "count(size_diff)", 1)} AS mean_size_diff
    FROM edits GROUP BY ALL"""
)
_HOURLY = (
    _EDITS
    + """SELECT date_trunc('hour', event_time) AS window_start,
        date_trunc('hour', event_time) + INTERVAL '1 hour' AS window_end, bot, count(*) AS edit_count
    FROM edits GROUP BY ALL"""
)
_SLIDING = (
    _EDITS
    + """, opened AS (
        SELECT time_bucket(INTERVAL '5 minutes', event_time) - i * INTERVAL '5 minutes' AS window_start, edits.*
        FROM edits, range(2) r(i))
    SELECT window_start, window_start + INTERVAL '10 minutes' AS window_end, wiki, count(*) AS edits,
        CAST(sum(CASE WHEN size_diff > 0 THEN size_diff ELSE 0 END) AS BIGINT) AS bytes_added,
        CAST(sum(CASE WHEN size_diff < 0 THEN -size_diff ELSE 0 END) AS BIGINT) AS bytes_removed
    FROM opened GROUP BY window_start, wiki"""
)
_PER_WIKI = (
    _EDITS
    + """SELECT wiki, count(*) AS edits, min(event_time) AS earliest_edit, max(event_time) AS latest_edit,
        round(avg(CAST(bot AS INTEGER)) * 100, 1) AS bot_percent FROM edits GROUP BY wiki"""
)
_SIZES = (
    _EDITS
    + f"""SELECT wiki, change, count(*) AS edits,
        {half_up("sum(abs(size_diff))", "count(size_diff)", 1)} AS mean_bytes, max(abs(size_diff)) AS largest_bytes
        FROM sized GROUP BY wiki, change"""
)
_PAGES = _EDITS + "SELECT * FROM page_totals ORDER BY abs(net_size_diff) DESC NULLS LAST, wiki, title LIMIT 10"
_USERS = _EDITS + 'SELECT * FROM users ORDER BY edits DESC, wiki, "user", bot LIMIT 10'
_CLEAN = rf"""WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
listed AS (
    SELECT list_filter(
        list_transform(regexp_split_to_array(lower(line), '[{SPACE}]+'),
                       lambda x: regexp_replace(x, '[^\p{{L}}\p{{N}}_]', '', 'g')),
        lambda x: x <> '' AND NOT list_contains([{quoted(ENGLISH)}], x)) AS words
    FROM lines)
SELECT array_to_string(words, ' ') AS value FROM listed WHERE len(words) > 0"""



def _closed(windows):
    """The windows that end before the watermark."""
    at = "SELECT date_trunc('second', max(ts)) FROM events"
    return f"SELECT * FROM ({windows}) WHERE window_end <= ({at}) - INTERVAL '10 minutes'"


# Events with the delivery they come with, and the end of event time that each batch drops late ones by: the largest
# seen two deliveries before.
_DELIVERED = """, delivered AS (
        SELECT event_type AS wiki, user_id % 5 = 0 AS bot, date_trunc('second', ts) AS event_time, diff AS size_diff,
               least(CAST(floor((day(ts) - 1) / 3.0) AS INTEGER)
                   + CASE WHEN event_id % 97 = 0 THEN 3 WHEN event_id % 11 = 0 THEN 1 ELSE 0 END, 9) AS batch
        FROM pages),
    marks AS (
        SELECT b.batch, max(d.event_time) - INTERVAL '1 hour' AS mark
        FROM (SELECT DISTINCT batch FROM delivered) b LEFT JOIN delivered d ON d.batch <= b.batch - 2 GROUP BY b.batch),
    spread AS (
        SELECT d.*, m.mark, time_bucket(INTERVAL '{step}', event_time) - i * INTERVAL '{step}' AS window_start,
               time_bucket(INTERVAL '{step}', event_time) - i * INTERVAL '{step}' + INTERVAL '{width}' AS window_end
        FROM delivered d JOIN marks m USING (batch), range({windows}) r(i))"""
_IN_TIME = """FROM spread WHERE (mark IS NULL OR window_end > mark)
        AND window_end <= (SELECT max(event_time) FROM edits) - INTERVAL '1 hour'"""


def _late(step: str, width: str, windows: int) -> str:
    return _EDITS + _DELIVERED.format(step=step, width=width, windows=windows)


def _long_sql(question: str, source: str, group: str, **figures: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{question}' AS question, {group} AS part_of, '{figure}' AS figure, CAST({value} AS DOUBLE) AS value FROM ({source})"
        for figure, value in figures.items()
    )


def _body(sql: str) -> str:
    """A question without the views it shares with the others."""
    return sql.removeprefix(_EDITS)


_WINDOW = "concat_ws('|', CAST(epoch(window_start) AS BIGINT), CAST(epoch(window_end) AS BIGINT), {})"

_USAGE = r"""WITH u AS (
            SELECT event_type AS namespace, 'pod-' || regexp_extract(props, '(\d+)', 1) AS name,
                   CAST(round(value) AS BIGINT) AS cpu, CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS memory
            FROM events)
        SELECT namespace, name, CAST(grouping(name) AS INTEGER) AS is_total,
               CAST(sum(cpu) AS BIGINT) AS cpu_millicores, CAST(sum(memory) AS BIGINT) AS memory_mib
        FROM u GROUP BY GROUPING SETS ((namespace, name), ())"""

ORACLE = {
    "edits_parse": _EDITS + _ALL,
    "edits_rejects": "SELECT left(props, length(props) - 1) AS raw FROM events WHERE event_type = 'error'",
    "edits_accepted": """SELECT nullif(event_type, 'error') AS wiki, count(*) AS edits FROM events GROUP BY ALL""",
    "edits_filtered": _EDITS + _ALL + " WHERE wiki = 'view' AND namespace = 0 AND type = 'edit'",
    "edits_per_wiki": _PER_WIKI,
    "edits_hourly_bots": _HOURLY,
    "edits_tumbling": _EDITS + _TUMBLING,
    "edits_sliding": _SLIDING,
    "edit_size_types": _SIZES,
    "edits_per_page": _EDITS + "SELECT * FROM page_totals",
    "biggest_pages": _PAGES,
    "edits_per_user": _EDITS + "SELECT * FROM users",
    "active_users": _USERS,
    "edit_shares": _EDITS
    + """SELECT wiki, change, count(*) AS edits,
        CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY wiki) AS share
        FROM sized GROUP BY wiki, change""",
    "active_user_shares": _EDITS
    + """SELECT t.wiki, t."user", t.bot, t.edits, a.wiki_edits, CAST(t.edits AS DOUBLE) / a.wiki_edits AS share
        FROM (SELECT * FROM users ORDER BY edits DESC, wiki, "user", bot LIMIT 10) t
        JOIN (SELECT wiki, count(*) AS wiki_edits FROM edits GROUP BY wiki) a USING (wiki)""",
    "edits_publish_roundtrip": _EDITS + _ALL + " WHERE type = 'edit'",
    "edits_stream_scan": _EDITS + _ALL,
    "edits_per_wiki_stream": _PER_WIKI,
    "edits_hourly_bots_stream": _HOURLY,
    "edits_tumbling_stream": _EDITS + _TUMBLING,
    "edits_sliding_stream": _SLIDING,
    "edits_tumbling_append": _closed(_EDITS + _TUMBLING),
    "edits_hourly_append": _closed(_HOURLY),
    "edits_sliding_append": _closed(_SLIDING),
    "edit_size_types_stream": _SIZES,
    "biggest_pages_stream": _PAGES,
    "active_users_stream": _USERS,
    "edits_hourly_late": _late("1 hour", "1 hour", 1)
    + f"SELECT window_start, window_end, bot, count(*) AS edit_count {_IN_TIME} GROUP BY ALL",
    "edits_tumbling_late": _late("5 minutes", "5 minutes", 1)
    + f"""SELECT window_start, window_end, wiki, bot, count(*) AS edits,
        {half_up("sum(size_diff)", "count(size_diff)", 1)} AS mean_size_diff {_IN_TIME} GROUP BY ALL""",
    "edits_sliding_late": _late("5 minutes", "10 minutes", 2)
    + f"""SELECT window_start, window_end, wiki, count(*) AS edits, CAST(sum(greatest(size_diff, 0)) AS BIGINT) AS bytes_added,
        CAST(sum(greatest(-size_diff, 0)) AS BIGINT) AS bytes_removed {_IN_TIME} GROUP BY ALL""",
    "edits_late_groups": _late("1 hour", "1 hour", 1)
    + """SELECT CAST(batch AS BIGINT) AS batch, count(*) AS messages,
        count(DISTINCT CASE WHEN window_end <= mark THEN concat_ws('|', window_start, bot) END) AS late FROM spread GROUP BY batch""",
    "edits_answers_stream": _EDITS
    + " UNION ALL ".join(
        [
            _long_sql("per_wiki", _body(_PER_WIKI), "wiki", edits="edits", earliest_edit="epoch(earliest_edit)",
                      latest_edit="epoch(latest_edit)", bot_percent="bot_percent"),
            _long_sql("tumbling", _TUMBLING, _WINDOW.format("wiki, bot"), edits="edits", mean_size_diff="mean_size_diff"),
            _long_sql("sliding", _body(_SLIDING).replace(", opened AS", "WITH opened AS", 1), _WINDOW.format("wiki"), edits="edits",
                      bytes_added="bytes_added", bytes_removed="bytes_removed"),
            _long_sql("size_types", _body(_SIZES), "concat_ws('|', wiki, change)", edits="edits", mean_bytes="mean_bytes",
                      largest_bytes="largest_bytes"),
            _long_sql("per_page", "SELECT * FROM page_totals", "concat_ws('|', wiki, title)", edits="edits", net_size_diff="net_size_diff"),
            _long_sql("per_user", "SELECT * FROM users", "concat_ws('|', wiki, \"user\", bot)", edits="edits"),
        ]
    ),
    "heavy_users_stream": _EDITS
    + 'SELECT *, true AS within_bounds FROM (SELECT * FROM users ORDER BY edits DESC, wiki, "user", bot LIMIT 10)',
    "edits_per_page_kept": _EDITS + "SELECT * FROM page_totals",
    "edits_per_user_kept": _EDITS + "SELECT * FROM users",
    "clean_lines_totals_stream": f"""SELECT kind, item, n FROM ({text.ORACLE["clean_lines_summary"]})
        UNION ALL SELECT 'check', 'lines in the output', (SELECT count(*) FROM ({_CLEAN}))""",
    "stream_clean_lines": _CLEAN,
    "stream_resume": _CLEAN,
    "service_availability": r"""WITH r AS (
            SELECT event_type = 'error' AS failed,
                   CASE WHEN event_type <> 'error' THEN 'pod-' || regexp_extract(props, '(\d+)', 1) END AS pod,
                   CASE WHEN event_type = 'error' THEN NULL WHEN ts < '2024-01-16' THEN '1' ELSE '2' END AS version
            FROM events)
        SELECT 'samples' AS kind, 'all' AS label, count(*) AS n FROM r
        UNION ALL SELECT 'failures', 'all', count(*) FILTER (failed) FROM r
        UNION ALL SELECT 'version', version, count(*) FROM r WHERE version IS NOT NULL GROUP BY version
        UNION ALL SELECT 'pod', pod, count(*) FROM r WHERE pod IS NOT NULL GROUP BY pod""",
    "usage_with_total": _USAGE,
    "usage_with_total_placed": "SELECT *, row_number() OVER (ORDER BY is_total, namespace NULLS FIRST, name NULLS FIRST) AS place FROM ("
    + _USAGE
    + ")",
}
