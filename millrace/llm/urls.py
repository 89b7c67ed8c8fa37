"""URL filter: rules first, then two character language models, all in DataFrame expressions.

One variable-order Markov model is counted from urls that the rules accept and one from urls they
reject. A character's probability mixes the orders 0 to ``ORDER``: each order's estimate falls back
on the next lower one with weight ``BACKOFF``. N-grams are counted as they are, however many there are: the longest ones
once over all urls, the shorter ones and the contexts from those counts. For each longest n-gram the difference of both
models' log-probabilities is worked out once; a url's characters are then joined with these numbers. They are
whole billionths, so that their sum does not depend on its order. A url's score is the
difference of its log-likelihoods per character; the threshold is calibrated on a fifth of the
ruled urls, which the models have not seen, by the mean of both error rates.

Null urls and urls without ``://`` have an empty host and path and fit no rule; an empty or null url
scores 0. Without ruled urls of both kinds all scores are 0 and the threshold is 0: allow. Repeated
rows, further columns and an empty table need no care: each row is judged by its url alone. A long url is cut into
n-grams whole, one row each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import common

ORDER = 3
BACKOFF = 2.0
BINS_PER_NAT = 100
HALF_BINS = 1000  # scores beyond +-10 share the outermost bins
HELD_OUT = 5  # one in so many ruled urls calibrates the threshold

START = "\x02"
UNITS = 1_000_000_000  # of a score, per nat


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path, as in ``example.org/es/``; the verdict is allow or block."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


# Fixed values of the task.
RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[\s\S]*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[\s\S]*?://[^/?#]*([^?#]*)", 1)


def ruled(urls: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``ruling``: the longest rule that fits, and its verdict."""
    rows = urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    rule, ruling = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):  # the last put on top is asked first
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule = F.when(fits, F.lit(r.text)).otherwise(rule)
        ruling = F.when(fits, F.lit(r.verdict)).otherwise(ruling)
    return rows.withColumns({"rule": rule, "ruling": ruling})


def grams(url: Column) -> Column:
    """Per character the n-gram that it ends, with ``START`` before the url."""
    padded = F.concat(F.lit(START * ORDER), F.coalesce(url, F.lit("")))
    return F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{ORDER + 1}}}))"), F.lit(1))


def counted(rows: DataFrame) -> DataFrame:
    """``gram`` with its counts among the urls of the two models, ``a`` accepted and ``r`` rejected, for all grams of all urls."""
    learned = F.col("ruling").isNotNull() & ~F.col("held_out")
    seen = rows.select(
        (learned & (F.col("ruling") == "allow")).cast("long").alias("a"),
        (learned & (F.col("ruling") == "block")).cast("long").alias("r"),
        F.explode(grams(F.col("u"))).alias("gram"),
    )
    return seen.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))


def log_ratios(counts: DataFrame) -> DataFrame:
    """``gram`` and ``d``: the difference of its last character's log-probabilities under both models, in units.

    The probabilities of n-grams of one order need their counts, those of their contexts, and the
    probabilities of the order below: two joins by order, each the smaller the shorter the n-grams.
    """
    sums = [F.sum("a").alias("a"), F.sum("r").alias("r")]
    lower: DataFrame | None = None
    for k in range(ORDER + 1):
        own = counts.groupBy(F.expr(f"right(gram, {k + 1})").alias("g")).agg(*sums)
        context = own.groupBy(F.expr(f"left(g, {k})").alias("before")).agg(F.sum("a").alias("of_a"), F.sum("r").alias("of_r"))
        own = own.withColumn("before", F.expr(f"left(g, {k})")).join(context, "before")
        if lower is None:
            own = own.withColumns({"low_a": F.lit(1.0 / 256), "low_r": F.lit(1.0 / 256)})
        else:
            own = own.withColumn("shorter", F.expr(f"right(g, {k})")).join(lower, "shorter")
        share = {s: (F.col(s) + BACKOFF * F.col(f"low_{s}")) / (F.col(f"of_{s}") + BACKOFF) for s in "ar"}
        if k < ORDER:
            lower = own.select(F.col("g").alias("shorter"), share["a"].alias("low_a"), share["r"].alias("low_r"))
        else:
            units = F.round((F.log(share["a"]) - F.log(share["r"])) * UNITS).cast("long")
            return own.select(F.col("g").alias("gram"), units.alias("d"))


def scored(rows: DataFrame, ratios: DataFrame) -> DataFrame:
    """The rows, which have an ``id``, with ``score``: the difference of the log-likelihoods per character under both models."""
    exploded = rows.select("id", F.explode(grams(F.col("u"))).alias("gram"))
    summed = exploded.join(ratios, "gram").groupBy("id").agg(F.sum("d").alias("d"), F.count("*").alias("n"))
    score = F.coalesce(F.col("d") / F.col("n") / UNITS, F.lit(0.0))
    return rows.join(summed, "id", "left").withColumn("score", score).drop("d", "n", "id", "u")


def threshold(scored: DataFrame) -> DataFrame:
    """One row ``threshold``: the bin edge with the least mean error on the ruled, held-out urls.

    Works on a histogram of a fixed number of bins. Of equal edges the one nearest 0 is taken.
    """
    bins = scored.select(
        F.greatest(F.lit(-HALF_BINS), F.least(F.lit(HALF_BINS), F.floor(F.col("score") * BINS_PER_NAT))).cast("int").alias("bin"),
        F.col("ruling"),
    )
    counted = bins.groupBy("bin").agg(
        F.sum((F.col("ruling") == "allow").cast("long")).alias("a"), F.sum((F.col("ruling") == "block").cast("long")).alias("b")
    )
    every = scored.sparkSession.range(-HALF_BINS, HALF_BINS + 1).select(F.col("id").cast("int").alias("bin"))
    table = every.join(counted, "bin", "left").agg(
        F.sort_array(F.collect_list(F.struct("bin", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b")))).alias("t")
    )
    zero = F.lit(0).cast("long")
    sums = F.expr("aggregate(t, struct(0L as a, 0L as b), (s, x) -> struct(s.a + x.a as a, s.b + x.b as b))")
    # A url is blocked below the edge: accepted ones below it and rejected ones from it on are errors.
    walk = F.aggregate(
        "t",
        F.struct(zero.alias("a"), zero.alias("b"), F.lit(0).alias("edge"), F.lit(2.0).alias("error")),
        lambda s, x: F.struct(
            (s["a"] + x["a"]).alias("a"),
            (s["b"] + x["b"]).alias("b"),
            F.when(_better(s, x), x["bin"]).otherwise(s["edge"]).alias("edge"),
            F.when(_better(s, x), _error(s)).otherwise(s["error"]).alias("error"),
        ),
    )
    both = table.select("t", sums.alias("all"))
    return both.select(
        F.when((F.col("all.a") > 0) & (F.col("all.b") > 0), walk["edge"] / F.lit(float(BINS_PER_NAT))).otherwise(0.0).alias("threshold")
    )


def _error(s: Column) -> Column:
    return s["a"] / F.col("all.a") + (F.col("all.b") - s["b"]) / F.col("all.b")


def _better(s: Column, x: Column) -> Column:
    return (_error(s) < s["error"]) | ((_error(s) == s["error"]) & (F.abs(x["bin"]) < F.abs(s["edge"])))


def judge(urls: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """``keep``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of every row."""
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    rows = ruled(urls.select(*kept, F.col(url).cast("string").alias("u")), rules, "u")
    held_out = F.pmod(F.xxhash64("u"), F.lit(HELD_OUT)) == 0
    # Stored, so that ids stay what they are.
    rows = common.stored(rows.withColumns({"held_out": held_out, "id": F.monotonically_increasing_id()}), "url-rows")
    ratios = common.stored(log_ratios(common.stored(counted(rows), "url-grams")), "url-model")
    known = common.stored(scored(rows, ratios), "url-scores")
    edge = threshold(known.where(F.col("ruling").isNotNull() & F.col("held_out"))).scalar()
    own = F.when(F.col("score") >= edge, "allow").otherwise("block")
    return known.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        "host",
        "path",
        "rule",
        F.coalesce("ruling", own).alias("verdict"),
        "score",
    )
