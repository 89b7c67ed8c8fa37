"""Word jobs on small literal texts and against plain Python."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from helpers import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import text as t
from millrace.functions.stopwords import ENGLISH, FRENCH
from millrace.operators import words as w
from millrace.sources import files


def frame(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def python_words(texts, stop):
    found = (re.sub(r"[^\w]", "", token.lower()) for text in texts for line in text.split("\n") for token in line.split(" "))
    return Counter(word for word in found if word and word not in stop)


def python_clean_line(text, stop):
    found = (re.sub(r"[^\w]", "", token.lower()) for token in text.split())
    return " ".join(word for word in found if word and word not in stop)


def test_stop_word_lists():
    assert len(ENGLISH) == len(set(ENGLISH)) and len(FRENCH) == len(set(FRENCH))
    assert {"the", "upon", "said"} <= set(ENGLISH) and {"été", "qu", "encore"} <= set(FRENCH)


def test_token_class(spark):
    tokens = frame(spark, "_foo_ été Œuvre— l’homme ½ x²").select(F.explode(t.clean_tokens(F.col("value"))))
    assert [row[0] for row in tokens.collect()] == ["_foo_", "été", "œuvre", "lhomme", "½", "x²"]


def test_empty_tokens(spark):
    lines = frame(spark, " x  y ")
    assert dict(rows(w.word_count_raw(lines))) == {"": 3, "x": 1, "y": 1}
    assert dict(rows(w.word_count(lines))) == {"x": 1, "y": 1}


def test_lines_and_documents_give_the_same_counts(spark):
    text = "One two\n\nthree  One\n"
    as_document, as_lines = frame(spark, text), frame(spark, *text.split("\n"))
    for count in (w.word_count_raw, w.word_count_lower, w.word_count, w.word_count_late_clean):
        assert rows(count(as_document)) == rows(count(as_lines))


def test_tab_joins_or_splits(spark):
    lines = frame(spark, "foo\tbar")
    assert rows(w.word_count(lines)) == [("foobar", 1)]
    assert rows(w.clean_lines(lines)) == [("foo bar",)]


def test_stop_words_hidden_by_punctuation(spark):
    lines = frame(spark, "“I and, fogg, fogg")
    assert rows(w.word_count(lines)) == [("fogg", 2)]
    assert rows(w.without_stop_words(w.word_count_lower(lines), ENGLISH)) == [("and,", 1), ("fogg", 1), ("fogg,", 1), ("“i", 1)]


def test_stop_words_as_list_or_table(spark):
    counts = w.word_count(frame(spark, "red blue red green"), stop_words=())
    table = spark.createDataFrame([("red",), ("red",), ("grey",)], "word string")
    assert rows(w.without_stop_words(counts, table)) == rows(w.without_stop_words(counts, ["red", "grey"]))


def test_french_apostrophes(spark):
    lines = frame(spark, "l'homme l’ami").select(t.split_apostrophes(F.col("value")).alias("value"))
    assert dict(rows(w.word_count(lines, stop_words=FRENCH))) == {"homme": 1, "ami": 1}


def test_order_and_ties(spark):
    counts = w.word_count(frame(spark, "b b a a c z Z éa"), stop_words=())
    assert [r.word for r in w.alphabetical(counts).collect()] == ["a", "b", "c", "z", "éa"]
    assert [tuple(r) for r in w.most_frequent(counts, 3).collect()] == [("a", 2), ("b", 2), ("z", 2)]


def test_lines_end_in_either_form(spark):
    texts = spark.createDataFrame([("a b\r\nc\n\r\nd\re",)], "value string")
    assert [r.line for r in w.text_lines(texts, "value").collect()] == ["a b", "c", "", "d\re"]
    assert rows(w.word_count_raw(texts), "word") == [("",), ("a",), ("b",), ("c",), ("d\re",)]


def test_summary_of_nothing(spark):
    none = spark.createDataFrame([], "value string")
    assert rows(w.clean_lines_summary(none)) == [("total", "lines written", 0), ("total", "messages", 0)]
    only = spark.createDataFrame([("the and of",)], "value string")
    assert rows(w.clean_lines_summary(only)) == [("total", "lines written", 0), ("total", "messages", 1)]


def test_shared_words_in_one_pass(spark):
    texts = spark.createDataFrame(
        [("en", "Fogg fix fogg the"), ("fr", "fix Fogg fix les"), ("de", "fogg"), (None, "fix")], "lang string, text string"
    )
    stops = {"en": ["the"], "fr": ["les"]}
    assert rows(w.shared_by_language(texts, stops)) == [("fix", 1, 2), ("fogg", 2, 1)]
    assert rows(w.shared_by_language(texts, stops, ["fogg"])) == [("fogg", 2, 1)]


def test_shared_words(spark):
    english = w.word_count(frame(spark, "fogg fogg fix house"))
    french = w.word_count(frame(spark, "fogg maison fix fix"), stop_words=FRENCH)
    assert rows(w.shared_words(english, french)) == [("fix", 1, 2), ("fogg", 2, 1)]
    assert rows(w.shared_words(english, french, ["fogg"])) == [("fogg", 2, 1)]


def test_mean_by_key(spark):
    ages = spark.createDataFrame(
        [("Brooke", 20), ("Denny", 31), ("Jules", 30), ("TD", 35), ("Brooke", 25)], "name string, age int"
    )
    means = {name: mean for name, mean in rows(w.mean_by_key(ages, "name", "age"), "name", "mean")}
    assert means == {"Brooke": 22.5, "Denny": 31.0, "Jules": 30.0, "TD": 35.0}


def test_language_stats(spark):
    documents = spark.createDataFrame(
        [("en", "The  cat\n\nsat"), ("en", "cat"), ("fr", "le chat")], "lang string, text string"
    )
    stats = w.language_stats(documents, {"en": ENGLISH, "fr": FRENCH})
    assert rows(stats, "lang", "lines", "tokens", "distinct_words") == [("en", 4, 4, 2), ("fr", 1, 2, 1)]


MARKED = "header\n*** START OF IT\na\nb\n*** END OF IT\nfooter\n*** END"


@pytest.mark.parametrize(
    "text, marked, body",
    [
        (MARKED, True, "a\nb"),
        ("*** START\n\n*** END", True, ""),
        ("*** START\n*** END", True, None),
        ("*** END\na\n*** START\nb", True, None),
        ("x *** START\na\n*** END", False, "x *** START\na\n*** END"),
        ("no markers", False, "no markers"),
    ],
)
def test_strip_boilerplate(spark, text, marked, body):
    result = w.strip_boilerplate(frame(spark, text), "value")
    assert rows(result, "marked", "body") == [(marked, body)]


def test_strip_boilerplate_by_line(spark, tmp_path):
    (tmp_path / "marked.txt").write_text(MARKED)
    (tmp_path / "plain.txt").write_text("x\ny")
    long_body = [f"line {i}" for i in range(2000)]
    (tmp_path / "long.txt").write_text("\n".join(["h", "*** START", *long_body, "*** END", "f"]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    # Files are cut into many splits, so the position has to hold across tasks.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = files.read_numbered_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        kept = rows(w.strip_boilerplate_lines(lines), "value")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert Counter(kept) == Counter((line,) for line in ["a", "b", "x", "y", *long_body])


def test_multiset_difference(spark):
    first = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "word string, n int")
    second = spark.createDataFrame([("a", 1), ("c", 3)], "word string, n int")
    assert rows(w.multiset_difference(first, second)) == [(2, 1)]
    assert rows(w.multiset_difference(first, first)) == [(0, 0)]
    assert rows(w.multiset_difference(first.limit(0), second.limit(0))) == [(0, 0)]


def test_clean_lines(spark):
    lines = frame(spark, "Hello, the World", "the and", "Fogg 0!", "", "a fish　\x1dbowl")
    assert rows(w.clean_lines(lines)) == [("fish bowl",), ("fogg 0",), ("hello world",)]


def test_clean_lines_summary(spark):
    lines = frame(spark, "Fogg fogg fix", "the and", "", "zeta zeta")
    assert [tuple(r) for r in w.clean_lines_summary(lines, k=2).collect()] == [
        ("total", "messages", 4),
        ("total", "lines written", 2),
        ("word", "fogg", 2),
        ("word", "zeta", 2),
    ]


TEXTS = st.lists(
    st.text(alphabet=st.sampled_from("aBé’'_ \n\t½²Œß.,— ́ñ中9the"), max_size=40), min_size=1, max_size=8
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=TEXTS)
def test_agrees_with_python(spark, texts):
    counted = dict(rows(w.word_count(frame(spark, *texts))))
    assert counted == dict(python_words(texts, ENGLISH))
    cleaned = [text for (text,) in rows(w.clean_lines(frame(spark, *texts)))]
    expected = [python_clean_line(text, ENGLISH) for text in texts]
    assert Counter(cleaned) == Counter(line for line in expected if line)


def test_word_count_shuffles_once(spark, tmp_path):
    frame(spark, "a b").write.text(str(tmp_path / "lines"))
    lines = files.read_lines(spark, str(tmp_path / "lines"))
    assert plan(w.word_count(lines)).count("Exchange hashpartitioning") == 1
    assert plan(w.word_count_late_clean(lines)).count("Exchange hashpartitioning") == 3


def test_text_is_cleaned_once_per_row(spark, tmp_path):
    frame(spark, "a b").write.text(str(tmp_path / "lines"))
    lines = files.read_lines(spark, str(tmp_path / "lines"))
    for job in (w.word_count, w.clean_lines, w.clean_lines_summary):
        assert plan(job(lines)).count("regexp_replace") == 1
