"""Quality rules with a hashed n-gram log-likelihood ratio, all in DataFrame expressions.

Words and neighbouring words are hashed into ``CELLS`` cells. The raw multinomial is counted over
all documents, the trusted one over all documents labelled good. A document's score
is its mean log ratio of the two over its n-grams. Documents below a threshold go. Of the histogram
edges, those with the least mean error of both classes of labelled documents form a range; the
threshold is a third of the way up in it, nearer the bad ones. It is set on a fifth of
the labelled documents, which the trusted ones leave out: its own documents score higher than
others like them.

Null and empty texts have no words and fail the base rules. Repeated rows are judged alike. Labels
with null ids or values count for nothing; a document labelled more than once is good if its labels
agree. Without held-out labels of both classes every document that passes the base rules is kept. Columns are taken by name
and results have fixed names, so further columns do not matter. Empty tables give empty results. Long texts are
counted whole: the hashes of their words, pairs and windows lie in memory as arrays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import common

CELLS = 1 << 16
BINS_PER_NAT = 200
HALF_BINS = 4000
HELD_OUT = 5  # one in so many labelled documents sets the threshold
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent
SYMBOLS = "#*$%&|<>"
BROADCAST_IDS = 2_000_000  # trusted ids that every task may hold, about 100 MB


def _pairs(n: Column, width: int) -> Column:
    """Start positions (from 1) of the windows of so many words."""
    return F.when(n >= width, F.sequence(F.lit(1), n - (width - 1))).otherwise(F.array().cast("array<int>"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that it refers to more than once; the value is worked out one time."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def _replaced(text: Column, characters: str, by: str) -> Column:
    """Each of a few characters replaced; much faster than `translate`, which looks up every character of a text."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def hashes(text: Column) -> Column:
    """Hashes of a text's words, in order; words as in ``common.words``."""
    spaced = _replaced(F.coalesce(text, F.lit("")), common.SPACES[1:], common.SPACES[0])
    return F.transform(F.array_remove(F.split(spaced, " "), ""), lambda w: F.xxhash64(w))


def cells(h: Column) -> Column:
    """Cells of a document's words and word pairs."""
    single = F.transform(h, lambda x: F.pmod(x, F.lit(CELLS)).cast("int"))
    double = F.transform(
        _pairs(F.size(h), 2), lambda i: F.pmod(F.xxhash64(F.element_at(h, i), F.element_at(h, i + 1)), F.lit(CELLS)).cast("int")
    )
    return F.concat(single, double)


def repeat_words(h: Column) -> Column:
    """Words inside a window of three that the text holds at least twice.

    Window hashes are sorted with their positions; equal neighbours are repeated. Each repeated
    position covers three words, less what the next one covers again.
    """
    windows = F.transform(
        _pairs(F.size(h), 3), lambda i: F.xxhash64(F.element_at(h, i), F.element_at(h, i + 1), F.element_at(h, i + 2))
    )
    none = F.struct(F.lit(None).cast("long").alias("w"), F.lit(None).cast("int").alias("i"))

    def covered(marked: Column) -> Column:
        # Each entry beside the one before and the one after it.
        after = F.slice(marked, F.lit(2), F.size(marked))
        beside = F.arrays_zip(
            marked.alias("own"), F.concat(F.array(none), marked).alias("before"), F.concat(after, F.array(none)).alias("after")
        )
        repeated = F.filter(
            beside,
            lambda x: F.coalesce(x["own"]["w"] == x["before"]["w"], F.lit(False)) | F.coalesce(x["own"]["w"] == x["after"]["w"], F.lit(False)),
        )
        return F.aggregate(
            F.sort_array(F.transform(repeated, lambda x: x["own"]["i"])),
            F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
            lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n")),
            lambda s: s["n"],
        )

    def counted(w: Column) -> Column:
        marked = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) < F.size(w), _once(marked, covered)).otherwise(0)

    return _once(windows, counted).cast("long")


def base(docs: DataFrame, text: str = "text") -> dict[str, Column]:
    """The base counts as columns over ``words``-hashes ``h`` and the text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.trim(x, F.lit(common.SPACES)) != "")
    return {
        "n_words": F.size("h").cast("long"),
        "word_chars": F.length(_replaced(whole, common.SPACES, "")).cast("long"),
        "n_symbols": (F.length(whole) - F.length(_replaced(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _once(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(F.col("h")),
    }


def label_table(labels: DataFrame) -> DataFrame:
    """One row per labelled document: ``doc_id`` and ``good``."""
    known = labels.where("doc_id is not null and quality is not null")
    return known.groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))


def held_out() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0


def weights(docs: DataFrame, labels: DataFrame, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """One row ``w``: the log ratio of every cell, from all documents and the trusted ones.

    The ids of the trusted documents are counted first. Up to ``broadcast_ids`` of them are handed to all tasks, and no text
    moves; more are joined with the texts by a shuffle.
    """
    good = labels.where(F.col("good") & ~held_out()).select(F.col("doc_id").cast("long").alias("trusted_id"))
    good = common.stored(good, "quality-trusted")
    if good.count() <= broadcast_ids:
        good = F.broadcast(good)
    joined = docs.join(good, docs["doc_id"] == good["trusted_id"], "left").withColumn("h", hashes(F.col("text")))
    flagged = joined.select(F.col("trusted_id").isNotNull().cast("long").alias("t"), F.explode(cells(F.col("h"))).alias("cell"))
    counted = flagged.groupBy("cell").agg(F.count("*").alias("raw"), F.sum("t").alias("trusted"))
    every = docs.sparkSession.range(CELLS).select(F.col("id").cast("int").alias("cell"))
    dense = every.join(counted, "cell", "left").select(
        "cell", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("trusted", F.lit(0)).alias("trusted")
    )
    listed = dense.agg(
        F.sort_array(F.collect_list(F.struct("cell", "raw", "trusted"))).alias("c"), F.sum("raw").alias("r"), F.sum("trusted").alias("t")
    )
    ratio = F.transform(
        "c",
        lambda x: F.log((x["trusted"] + 1) / (F.col("t") + CELLS)) - F.log((x["raw"] + 1) / (F.col("r") + CELLS)),
    )
    # Without trusted documents there is nothing to tell apart.
    return listed.select(F.when(F.col("t") > 0, ratio).otherwise(F.transform("c", lambda x: F.lit(0.0))).alias("w"))


def scored(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, the base counts, ``base_failed`` and ``score`` of every document, stored."""
    rows = docs.select("doc_id", F.col(text).cast("string").alias("text"))
    ratios = common.stored(weights(rows, labels), "quality-weights")
    rows = rows.withColumn("h", hashes(F.col("text")))
    # A lambda may not hold a subquery, but may refer to its column; as there is one reference, the
    # optimiser puts the subquery in its place and no row carries the ratios.
    rows = rows.withColumn("w", ratios.scalar())
    total = F.aggregate(cells(F.col("h")), F.lit(0.0), lambda s, c: s + F.element_at("w", c + 1))
    rows = rows.withColumn("total", total).drop("w")
    grams = F.size("h") + F.greatest(F.size("h") - 1, F.lit(0))
    counted = rows.withColumns(base(rows)).withColumn("score", F.when(F.size("h") > 0, F.col("total") / grams).otherwise(0.0)).drop("total")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return common.stored(counted.drop("h", "text").withColumn("base_failed", failed), "quality-scores")


def threshold(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """One row ``threshold``: scores below it are dropped; null to keep all.

    From a histogram of the held-out labelled documents that pass the base rules, of a fixed number of bins.
    """
    known = rows.where(~F.col("base_failed")).select("doc_id", "score").join(labels.where(held_out()), "doc_id")
    bins = known.select(
        F.greatest(F.lit(-HALF_BINS), F.least(F.lit(HALF_BINS), F.floor(F.col("score") * BINS_PER_NAT))).cast("int").alias("bin"),
        F.col("good").cast("long").alias("good"),
    )
    counted = bins.groupBy("bin").agg(F.sum("good").alias("g"), F.sum(1 - F.col("good")).alias("b"))
    table = counted.agg(
        F.sort_array(F.collect_list(F.struct("bin", "g", "b"))).alias("t"), F.sum("g").alias("all_good"), F.sum("b").alias("all_bad")
    )
    # Without both classes there is nothing to tell apart.
    table = table.where("all_good > 0 and all_bad > 0")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("int")

    def step(s: Column, x: Column) -> Column:
        g, b = s["g"] + x["g"], s["b"] + x["b"]
        # Of dropping all bins up to x; of equal errors the lower edge, which drops less, stays.
        error = g / F.col("all_good") + (F.col("all_bad") - b) / F.col("all_bad")
        better = error < s["error"]
        return F.struct(
            g.alias("g"),
            b.alias("b"),
            F.when(better, error).otherwise(s["error"]).alias("error"),
            F.when(better, x["bin"] + 1).otherwise(s["low"]).alias("low"),
            F.when(~better, F.coalesce(s["high"], x["bin"])).alias("high"),
        )

    start = F.struct(zero.alias("g"), zero.alias("b"), F.lit(1.0).alias("error"), none.alias("low"), none.alias("high"))
    walk = F.aggregate("t", start, step)
    found = table.select(walk.alias("w")).select("w.low", F.coalesce("w.high", "w.low").alias("high"))
    edge = F.col("low") + F.floor((F.col("high") - F.col("low")) / 3)
    return found.select((edge / F.lit(float(BINS_PER_NAT))).alias("threshold"))


def judge(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, base counts, ``base_failed``, ``score`` and ``kept``."""
    common.small_batches(docs.sparkSession)
    known = label_table(labels)
    rows = scored(docs, known, text)
    edge = threshold(rows, known).scalar()
    return rows.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= edge, F.lit(True)))
