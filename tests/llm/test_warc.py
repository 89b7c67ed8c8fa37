from __future__ import annotations

import hashlib

import compare
import edge
import pytest

from millrace.llm import warc
from millrace.llm.queries import ORACLE, QUERIES

PAGES = "page_id long, url string, html string"
BIG = "<html>" + "x" * 200 + "</html>"


def pages(spark):
    rows = [(n, f"http://h.example/{n}?a=b%20c\nd é", t) for n, t in enumerate(edge.TEXTS)]
    rows += [(50, None, BIG), (40, "u", BIG), (60, "", BIG), (None, "n", BIG), (40, "u2", BIG), (70, "u", "short"), (71, "u", "short")]
    return spark.createDataFrame(rows, PAGES)


def expected(rows):
    least = {}
    for page_id, _, html in rows:
        if page_id is not None:
            least[html or ""] = min(page_id, least.get(html or "", page_id))
    out = []
    for page_id, url, html in rows:
        body = (html or "").encode()
        again = len(body) >= 100 and least.get(html or "", page_id) != page_id
        out.append(
            (
                page_id,
                url,
                None if again else body,
                len(body),
                hashlib.sha256(body).hexdigest(),
                "revisit" if again else "response",
                least[html or ""] if again else None,
            )
        )
    return sorted(out, key=repr)


def read_back(frame):
    return sorted(((*r[:2], None if r[2] is None else bytes(r[2]), *r[3:]) for r in frame.collect()), key=repr)


def test_round_trip(spark):
    frame = pages(spark)
    index = warc.write(frame)
    rows = [tuple(r) for r in frame.collect()]
    assert read_back(warc.read(index)) == expected(rows)
    assert index.count() == len(rows)


def test_clashing_columns_change_nothing(spark):
    frame = pages(spark)
    clashing = frame
    names = [*edge.CLASHES, *"bundle frame place record_type refers_to payload payload_digest payload_bytes digest first raw offset".split()]
    for name in names:
        clashing = clashing.withColumn(name, clashing.url)
    assert read_back(warc.read(warc.write(clashing))) == read_back(warc.read(warc.write(frame)))


def test_single_records_by_their_places(spark):
    frame = pages(spark).coalesce(1)
    index = warc.write(frame, frame_bytes=3000, bundle_bytes=2000)
    assert index.select("bundle").distinct().count() > 1
    assert index.agg({"frame": "max"}).first()[0] > 0
    some = index.where("page_id in (11, 5, 60) or page_id is null")
    rows = [tuple(r) for r in frame.collect()]
    assert read_back(warc.fetch(some)) == [r for r in expected(rows) if r[0] in (11, 5, 60, None)]


def test_bundle_is_plain_zstandard(tmp_path):
    import zstandard

    path = tmp_path / "a.zst"
    bundle = warc.Bundle(path.open("wb"))
    records = [warc.make_record(n, "u", b"p" * n * 1000, "d", False, None) for n in range(900)]
    places = [bundle.add(r) for r in records]
    bundle.close()
    with path.open("rb") as file:
        assert zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read() == b"".join(records)
    with warc.BundleReader(str(path)) as reader:
        for record, (frame, start, length) in zip(records, places, strict=True):
            assert reader.frame(frame)[start : start + length] == record


def test_damage_is_noticed(tmp_path):
    record = warc.make_record(1, "u", b"payload", hashlib.sha256(b"other").hexdigest(), False, None)
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record)
    (tmp_path / "b").write_bytes(b"no bundle at all")
    with pytest.raises(ValueError, match="seek table"):
        warc.BundleReader(str(tmp_path / "b"))


def test_nothing(spark):
    index = warc.write(edge.empty(spark, PAGES))
    assert index.count() == 0
    assert warc.read(index).count() == 0


def test_query(spark, sf_dir):
    assert compare.differences(QUERIES["op1_warc"](spark, sf_dir), compare.connect(sf_dir), ORACLE["op1_warc"]) == ""
