"""Tables by month, damaged CSV, fingerprints of results, books read in small splits."""

from __future__ import annotations

from pathlib import Path

import pytest
from helpers import plan, rows
from hypothesis import HealthCheck, given, settings as example_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import fingerprints as fp
from millrace.operators import words as w
from millrace.plans import text
from millrace.session import settings
from millrace.sources import files, partitioned, scratch

TIMED = "id int, at timestamp_ntz"


def timed(spark, *days):
    return spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, at string").select("id", F.col("at").cast("timestamp_ntz"))


def month_files(path) -> dict[str, set[str]]:
    return {p.name: {f.name for f in p.glob("*.parquet")} for p in Path(path).glob("stored_month=*")}


def test_a_period_reads_its_months_only(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = timed(spark, "2024-01-31 23:59:59", "2024-02-01", "2024-02-15", "2024-03-01", None, "2025-02-01")
    partitioned.write_months(frame, path, "at")
    assert set(month_files(path)) == {f"stored_month={m}" for m in ("202401", "202402", "202403", "202502", "__HIVE_DEFAULT_PARTITION__")}
    found = partitioned.read_period(spark, path, frame.schema, "at", "2024-02-01", "2024-03-01")
    assert rows(found, "id") == [(1,), (2,)] and found.columns == ["id", "at"]
    filters = plan(found).split("PartitionFilters: ")[1].split("]")[0]
    assert "202402" in filters and "202403" in filters
    scanned = found.inputFiles()
    assert rows(partitioned.read_period(spark, path, frame.schema, "at", "2023-01-01", "2026-01-01"), "id") == [(0,), (1,), (2,), (3,), (5,)]
    assert scanned


def test_a_month_is_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = timed(spark, "2024-01-10", "2024-02-10", "2024-02-11", "2024-03-10")
    partitioned.write_months(frame, path, "at")
    before = month_files(path)
    partitioned.write_months(timed(spark, "2024-02-20"), path, "at")
    after = month_files(path)
    assert {m for m in before if before[m] != after[m]} == {"stored_month=202402"}
    found = partitioned.read_period(spark, path, frame.schema, "at", "2024-01-01", "2025-01-01")
    assert rows(found.select(F.date_format("at", "MM-dd"))) == [("01-10",), ("02-20",), ("03-10",)]


DAMAGE = [
    ("1,Queens,Astoria", True),
    ("2,N/A,N/A", True),
    ('3,"Bronx, North","say ""hi"""', True),
    ('4,"two\nlines",Z', True),
    ("5,,", True),
    ("x6,Queens,Astoria", False),
    ("7,Queens", False),
    ("8,Queens,Astoria,more", False),
    ("99999999999,Queens,Astoria", False),
]


def test_damaged_records_are_set_apart(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Borough,Zone\n" + "\n".join(r for r, _ in DAMAGE) + "\n")
    good, damaged = files.read_csv_checked(spark, str(tmp_path / "z.csv"), files.ZONE_SCHEMA, multi_line=True)
    assert rows(good) == [
        (1, "Queens", "Astoria"), (2, "N/A", "N/A"), (3, "Bronx, North", 'say "hi"'),
        (4, "two\nlines", "Z"), (5, None, None),
    ]
    assert [r[0] for r in rows(damaged, "raw")] == sorted((r for r, fits in DAMAGE if not fits), key=repr)
    assert all(r["file"].endswith("z.csv") for r in damaged.collect())


def test_a_csv_without_records(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Borough,Zone\n")
    good, damaged = files.read_csv_checked(spark, str(tmp_path / "z.csv"), files.ZONE_SCHEMA)
    assert rows(good) == rows(damaged) == []


ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from(["", "~", "1:", "a", "b"]))), max_size=6)


@example_settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, ROWS)
def test_fingerprints_tell_multisets_apart(spark, a, b):
    left, right = (spark.createDataFrame(x, "n int, s string") for x in (a, b))
    same = sorted(a, key=repr) == sorted(b, key=repr)
    assert (rows(fp.fingerprint(left)) == rows(fp.fingerprint(right))) == same
    assert rows(fp.differences(left, right)) == rows(w.multiset_difference(left, right))


def test_fingerprints_ignore_order_and_move_no_rows(spark):
    frame = spark.range(3000).select((F.col("id") % 1000).alias("a"), F.col("id").cast("string").alias("b"))
    turned = frame.orderBy(F.desc("a")).select("b", "a").repartition(3)
    assert rows(fp.fingerprint(frame)) == rows(fp.fingerprint(turned))
    assert plan(fp.fingerprint(frame)).count("Exchange") == 1 and "HashAggregate" in plan(fp.fingerprint(frame))
    doubled = frame.unionByName(frame.where("a = 1"))
    assert rows(fp.fingerprint(frame)) != rows(fp.fingerprint(doubled))
    assert rows(fp.differences(frame, doubled, 4)) == [(0, 3)]


def test_lines_of_a_book_read_in_small_splits(spark, tmp_path):
    inside = [f"line {i} of the book" for i in range(3000)]
    framed = ["Title", "*** START OF IT ***", *inside, "*** END OF IT ***", "licence"]
    (tmp_path / "a.txt").write_text("\n".join(framed) + "\n")
    (tmp_path / "b.txt").write_text("no marks\nhere")
    with settings(spark, spark__sql__files__maxPartitionBytes="4k", spark__sql__files__openCostInBytes="1k"):
        lines = files.read_numbered_lines(spark, str(tmp_path))
        found = w.number_lines(w.strip_boilerplate_lines(lines)).select(F.regexp_extract("file", "([ab]).txt", 1).alias("f"), "block", "line_no", "value").collect()
    book = [r["value"] for r in sorted((r for r in found if r["f"] == "a"), key=lambda r: r["line_no"])]
    assert book == inside and len({r["block"] for r in found if r["f"] == "a"}) > 5
    assert sorted((r["line_no"], r["value"]) for r in found if r["f"] == "b") == [(0, "no marks"), (1, "here")]


def test_books_share_files(spark, tmp_path):
    """Files do not grow with the books; splits cut through books, and each is cut by its own markers."""
    long = "\n".join(f"line {i}\tof it\r" for i in range(4000))
    texts = {n: ("de", "\n\tx\n\n") if n % 9 == 0 else ("en", f"a{n}\n*** END early\nb") if n % 9 == 1 else ("fr", f"c\n{n}") for n in range(300)}
    texts |= {400: ("en", long), 401: ("de", None), 402: ("en", None), None: ("en", "no number")}
    books = spark.createDataFrame([(n, *row) for n, row in texts.items()], "doc_id long, lang string, text string")
    books.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    before = {n for n in scratch.children(spark, scratch.shared_root(spark)) if n.startswith("books-")}
    found = text.strip_boilerplate_files(spark, str(tmp_path))
    want = []
    for n, (lang, body) in texts.items():
        lines = [""] if body is None else body.split("\n")
        if lang != "de":
            lines = [] if body is None else lines[: next((i for i, x in enumerate(lines) if x.startswith("*** END")), None)]
        want += [(n, i, x) for i, x in enumerate(lines)]
    assert rows(found) == sorted(want, key=repr)
    [made] = {n for n in scratch.children(spark, scratch.shared_root(spark)) if n.startswith("books-")} - before
    assert len(scratch.children(spark, f"{scratch.shared_root(spark)}/{made}")) <= 20
    with settings(spark, spark__sql__files__openCostInBytes="16k", spark__sql__files__minPartitionNum="200"):
        lines = files.book_lines(files.read_numbered_lines(spark, f"{scratch.shared_root(spark)}/{made}", "\n"))
        assert lines.where("book = '400'").select("block").distinct().count() > 1


def test_settings_come_back(spark):
    key, new = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes.test"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), settings(spark, spark__sql__shuffle__partitions="7", **{new.replace(".", "__"): "x"}):
        assert spark.conf.get(key) == "7" and spark.conf.get(new) == "x"
        raise ValueError
    assert spark.conf.get(key) == before and spark.conf.get(new, None) is None
