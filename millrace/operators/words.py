"""Word counts and text comparison.

Rows may be lines or whole documents: every tokeniser treats a line break as a separator.
Counting shuffles once, on the word, after a map-side count, so a word that makes up a
third of the text reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import text as t
from millrace.functions.stopwords import ENGLISH


def text_lines(rows: DataFrame, text: str = "value", keys: Sequence[str] = ()) -> DataFrame:
    """One row per line, with its position in the text."""
    return rows.select(*keys, F.posexplode(t.lines(F.col(text))).alias("line_no", "line"))


def _count(rows: DataFrame, tokens: Column) -> DataFrame:
    return rows.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def word_count_raw(rows: DataFrame, text: str = "value") -> DataFrame:
    """Count of space-separated tokens as written."""
    return _count(rows, t.raw_tokens(F.col(text)))


def word_count_lower(rows: DataFrame, text: str = "value") -> DataFrame:
    """Count of space-separated tokens in lower case."""
    return _count(rows, t.raw_tokens(F.lower(F.col(text))))


def without_stop_words(counts: DataFrame, stop_words: Iterable[str] | DataFrame) -> DataFrame:
    """Drop stop words from a word count.

    A list becomes a hash-set test. A table (column ``word``) is anti-joined: it meets one row
    per distinct word, and the planner broadcasts it only if its size allows.
    """
    if isinstance(stop_words, DataFrame):
        return counts.join(stop_words.select("word"), "word", "left_anti")
    return counts.where(~F.col("word").isin(list(stop_words)))


def words(
    rows: DataFrame, text: str = "value", stop_words: Iterable[str] = ENGLISH, keys: Sequence[str] = ()
) -> DataFrame:
    """One row per cleaned word, stop words dropped."""
    exploded = rows.select(*keys, F.explode(t.clean_tokens(F.col(text))).alias("word"))
    return exploded.where(~F.col("word").isin(["", *stop_words]))


def word_count(
    rows: DataFrame, text: str = "value", stop_words: Iterable[str] = ENGLISH, keys: Sequence[str] = ()
) -> DataFrame:
    """Clean, filter, then count: one shuffle. Unsorted; see ``alphabetical`` and ``most_frequent``."""
    return words(rows, text, stop_words, keys).groupBy(*keys, "word").agg(F.count("*").alias("n"))


def word_count_late_clean(
    rows: DataFrame, text: str = "value", stop_words: Iterable[str] = ENGLISH
) -> DataFrame:
    """Count first and clean afterwards: three shuffles, same answer as ``word_count``.

    Kept to be compared with it; use ``word_count``.
    """
    total = F.sum("n").alias("n")
    lowered = word_count_raw(rows, text).groupBy(F.lower("word").alias("word")).agg(total)
    cleaned = lowered.groupBy(t.clean_token(F.col("word")).alias("word")).agg(total)
    return cleaned.where(~F.col("word").isin(["", *stop_words]))


def alphabetical(counts: DataFrame) -> DataFrame:
    return counts.orderBy("word")


def most_frequent(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent words; equal counts in word order."""
    return counts.orderBy(F.desc("n"), "word").limit(k)


def shared_words(
    first: DataFrame, second: DataFrame, names: Iterable[str] | None = None, labels: tuple[str, str] = ("en", "fr")
) -> DataFrame:
    """Words counted in both texts, optionally only the given names, with both counts."""
    joined = first.withColumnRenamed("n", f"n_{labels[0]}").join(
        second.withColumnRenamed("n", f"n_{labels[1]}"), "word"
    )
    return joined if names is None else joined.where(F.col("word").isin(list(names)))


def shared_by_language(
    documents: DataFrame,
    stop_words: Mapping[str, Iterable[str]],
    names: Iterable[str] | None = None,
    text: str = "text",
    language: str = "lang",
) -> DataFrame:
    """Words that the texts of two languages share, with the count in each (``n_<language>``), in one pass.

    Every word meets its counts in one grouping, so that the texts are read and shuffled once.
    """
    listed = documents.where(F.col(language).isin(list(stop_words)))
    exploded = listed.select(language, F.explode(t.clean_tokens(F.col(text))).alias("word")).where("word <> ''")
    if names is not None:
        exploded = exploded.where(F.col("word").isin(list(names)))
    counts = {
        lang: F.count_if((F.col(language) == lang) & ~F.col("word").isin(list(words))).alias(f"n_{lang}")
        for lang, words in stop_words.items()
    }
    both = exploded.groupBy("word").agg(*counts.values())
    return both.where(" and ".join(f"n_{lang} > 0" for lang in stop_words))


def mean_by_key(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Sum, count and mean per key."""
    totals = rows.groupBy(key).agg(F.sum(value).alias("total"), F.count(value).alias("n"))
    return totals.withColumn("mean", F.try_divide("total", "n"))


def language_stats(
    documents: DataFrame, stop_words: Mapping[str, Iterable[str]], text: str = "text", language: str = "lang"
) -> DataFrame:
    """Lines, white-space tokens and distinct cleaned words per language, from one pass over the text.

    The size of a text rides on its first word. Grouping on (language, word) first means no task
    holds the vocabulary of a language.
    """
    body = F.col(text)
    # Sizes are computed in a step of their own, below the explode: beside it they would be
    # worked out again for every word.
    sized = documents.select(
        language,
        text,
        t.line_count(body).alias("lines"),
        F.size(t.white_space_tokens(body)).alias("tokens"),
    )
    exploded = sized.select(language, "lines", "tokens", F.posexplode(t.clean_tokens(body)).alias("pos", "word"))

    def once(size: str) -> Column:
        return F.sum(F.when(F.col("pos") == 0, F.col(size)).otherwise(0))

    vocabulary = exploded.groupBy(language, "word").agg(once("lines").alias("lines"), once("tokens").alias("tokens"))
    counted = F.col("word") != ""
    for lang, listed in stop_words.items():
        counted = counted & ~((F.col(language) == lang) & F.col("word").isin(list(listed)))
    return vocabulary.groupBy(language).agg(
        F.sum("lines").alias("lines"), F.sum("tokens").alias("tokens"), F.count_if(counted).alias("distinct_words")
    )


def strip_boilerplate(documents: DataFrame, text: str = "text") -> DataFrame:
    """Replace each text by the lines between its markers (column ``body``).

    A text without both markers is kept whole and flagged ``marked = false``; a marked text
    with no line in between gets a null body.
    """
    marked = t.has_markers(F.col(text))
    body = F.when(marked, t.between_markers(F.col(text))).otherwise(F.col(text))
    return documents.select("*", marked.alias("marked"), body.alias("body"))


def strip_boilerplate_lines(lines: DataFrame, text: str = "value", book: Sequence[str] = ("file",)) -> DataFrame:
    """The same for files read line by line (see ``sources.files.read_numbered_lines``).

    Marker positions are found with one small aggregate per book, then each line is compared
    with those of its book. Lines of a book without both markers are all kept. ``book`` names the columns that tell
    books apart, none of them null: a file is one book unless they say more.
    """
    position = F.struct("block", "seq")
    line = F.col(text)
    markers = lines.groupBy(*book).agg(
        F.min(F.when(F.startswith(line, F.lit(t.START_MARKER)), position)).alias("start"),
        F.min(F.when(F.startswith(line, F.lit(t.END_MARKER)), position)).alias("end"),
    )
    inside = (position > F.col("start")) & (position < F.col("end"))
    unmarked = F.col("start").isNull() | F.col("end").isNull()
    return lines.join(markers, list(book)).where(unmarked | inside).drop("start", "end")


def number_lines(lines: DataFrame, book: Sequence[str] = ("file",)) -> DataFrame:
    """Lines of books with their number in the book, from 0 (``line_no``), in the order of block and sequence."""
    order = Window.partitionBy(*book).orderBy("block", "seq")
    return lines.withColumn("line_no", F.row_number().over(order) - 1)


def multiset_difference(first: DataFrame, second: DataFrame) -> DataFrame:
    """How many rows each side has that the other lacks, duplicates counted; one row.

    Both sides are weighed in a single grouping instead of two set differences.
    """
    columns = first.columns
    signed = first.withColumn("side", F.lit(1)).unionByName(second.select(*columns).withColumn("side", F.lit(-1)))
    balance = signed.groupBy(*columns).agg(F.sum("side").alias("d"))
    return balance.agg(
        F.coalesce(F.sum(F.greatest(F.col("d"), F.lit(0))), F.lit(0)).alias("only_first"),
        F.coalesce(F.sum(F.greatest(-F.col("d"), F.lit(0))), F.lit(0)).alias("only_second"),
    )


def clean_lines(lines: DataFrame, line: str = "value", stop_words: Iterable[str] = ENGLISH) -> DataFrame:
    """Cleaned lines, one per message that has a word left; works on a stream."""
    cleaned = F.array(t.clean_line(F.col(line), stop_words))
    # A where() on the cleaned column would be pushed below it and clean every line twice;
    # exploding a list of no or one line does not.
    return lines.select(F.explode(F.filter(cleaned, lambda text: text != "")).alias("value"))


# Words are never empty and never start with a space, so the marks of a message cannot collide with them.
READ, WRITTEN = " messages", " lines written"


def line_items(lines: DataFrame, line: str = "value", stop_words: Iterable[str] = ENGLISH) -> DataFrame:
    """Words of the cleaned lines with their counts (``item``, ``n``), beside marks for messages read and lines written.

    Counts of several batches can be added up.
    """
    found = lines.select(t.clean_line_words(F.col(line), stop_words).alias("words"))
    marks = F.when(F.size("words") > 0, F.array(F.lit(READ), F.lit(WRITTEN))).otherwise(F.array(F.lit(READ)))
    return found.select(F.explode(F.concat(marks, "words")).alias("item")).groupBy("item").agg(F.count("*").alias("n"))


def lines_report(items: DataFrame, k: int = 10) -> DataFrame:
    """Messages read, lines written and the k most frequent words; both totals are there even if nothing was read."""
    is_mark = F.startswith(F.col("item"), F.lit(" "))
    always = items.sparkSession.createDataFrame([(READ, 0), (WRITTEN, 0)], "item string, n long")
    totals = items.where(is_mark).unionByName(always).groupBy("item").agg(F.sum("n").alias("n"))
    words = items.where(~is_mark).orderBy(F.desc("n"), "item").limit(k)
    return totals.unionByName(words).select(
        F.when(is_mark, "total").otherwise("word").alias("kind"), F.trim("item").alias("item"), "n"
    )


def clean_lines_summary(
    lines: DataFrame, line: str = "value", stop_words: Iterable[str] = ENGLISH, k: int = 10
) -> DataFrame:
    """Messages read, lines written and the k most frequent words, from one pass and one shuffle.

    Every message yields its words plus one or two marker rows; all are counted together. Both totals
    are always reported, as 0 where nothing was read or written.
    """
    found = lines.select(t.clean_line_words(F.col(line), stop_words).alias("words"))
    # Words are never empty and never start with a space, so markers cannot collide with them.
    markers = F.when(F.size("words") > 0, F.array(F.lit(" messages"), F.lit(" lines written"))).otherwise(
        F.array(F.lit(" messages"))
    )
    always = lines.sparkSession.createDataFrame([(" messages", 0), (" lines written", 0)], "item string, one long")
    counts = (
        found.select(F.explode(F.concat(markers, "words")).alias("item"), F.lit(1).cast("long").alias("one"))
        .unionByName(always)
        .groupBy("item")
        .agg(F.sum("one").alias("n"))
    )
    is_marker = F.startswith(F.col("item"), F.lit(" "))
    # Markers first, then words by count: the first k + 2 rows are the answer.
    report = counts.orderBy(F.desc(is_marker), F.desc("n"), "item").limit(k + 2)
    return report.select(
        F.when(is_marker, "total").otherwise("word").alias("kind"), F.trim("item").alias("item"), "n"
    )
