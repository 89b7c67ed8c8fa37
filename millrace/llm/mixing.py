"""Mixing sources to target weights: whole copies of every document, then a subset that fits the rest.

Each source gets as many whole passes as its target holds (0, 1 or 2). For the rest of the budget
documents are counted by exact length: every length gives its share, rounded down, then longer
lengths give one document more while it fits, and a bounded-knapsack program over the lengths left
fills all that remains, which is no more than the longest document: to the last word where that can be
done, else to the nearest sum below or above. The documents of a length are chosen by a seeded hash.

Lengths are the only thing a source is reduced to: the program for a source sees one row per
distinct length. The choice within a length goes by ranges of the hash, so that a length with a
third of all rows is ranked in ``RANGES`` groups and not in one.

Null texts have size 0, a null source is a source like others (last in order), null ids and repeated
rows are documents of their own; rows that agree in id and text are told apart at random, which
leaves the result the same. Documents of size 0 take part in whole passes only. An empty table
gives an empty result; a table without words gives targets of 0. Further columns do not matter. Of a long text only
its size is used, which the program's memory grows with.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import common

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = (3, 2)  # all targets together: so many halves of all words
MOST = 2  # a source's target, in times of its size
RANGES = 1 << 10
SEED = 20240101


def _name(source: Column) -> Column:
    """A source's name without nulls."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("-"))


def measured(docs: DataFrame, text: str = "text", seed: int = SEED) -> DataFrame:
    """Adds ``size``, ``name``, ``draw`` (the seeded hash) and ``range`` (its upper bits)."""
    rows = docs.withColumns(
        {
            "size": common.word_count(F.col(text)),
            "name": _name(F.col("source")),
            "draw": F.xxhash64(F.lit(seed), "doc_id", F.col(text)),
        }
    )
    return rows.withColumn("range", F.shiftrightunsigned("draw", 64 - (RANGES.bit_length() - 1)).cast("int"))


def targets(lengths: DataFrame) -> DataFrame:
    """``name``, ``source_size`` and ``target`` of every source, from counts by length.

    Sources are taken in order of size over weight: one is capped when the level, with all before it
    capped, exceeds its cap; the level at the first one that is not capped holds for the rest. Works
    on one row per source.
    """
    sources = lengths.groupBy("source", "name").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weighed = sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), turn + 1).cast("long"))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "name")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    whole, part = SHARE
    placed = weighed.select(
        "*",
        (whole * F.sum("source_size").over(every) - part * MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(rest).alias("weights_left"),
    )
    capped = F.col("left") * F.col("weight").cast("double") > part * MOST * F.col("source_size") * F.col("weights_left").cast("double")
    flagged = placed.withColumn("capped", capped)
    first_free = F.min_by(F.struct("left", "weights_left"), F.when(~F.col("capped"), F.col("source_size") / F.col("weight"))).over(every)
    levelled = flagged.withColumn("level", first_free)
    target = F.when(F.col("capped"), (MOST * F.col("source_size")).cast("double")).otherwise(
        F.col("weight") * F.col("level.left") / (part * F.col("level.weights_left"))
    )
    return levelled.select("name", "source_size", target.alias("target"))


def _ones(bits: int) -> np.ndarray:
    """Places of the ones of a number."""
    held = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
    some = np.flatnonzero(held)
    row, bit = np.nonzero(np.unpackbits(held[some, None], axis=1, bitorder="little"))
    return 8 * some[row] + bit


def fit(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length to take so that their words come as near to the budget as they can."""
    total = sum(s * n for s, n in zip(sizes, counts, strict=True))
    if budget >= total:
        return list(counts)
    take = [n * budget // total if s else 0 for s, n in zip(sizes, counts, strict=True)]
    left = budget - sum(s * t for s, t in zip(sizes, take, strict=True))
    order = sorted((i for i, s in enumerate(sizes) if s), key=lambda i: -sizes[i])
    for i in order:
        if left <= sizes[order[0]]:
            break  # the program does the rest; one pass gets here, as every share lost less than one document
        if sizes[i] <= left and take[i] < counts[i]:
            take[i] += 1
            left -= sizes[i]
    fitting = [i for i in order if sizes[i] <= left and take[i] < counts[i]]
    # A sum beyond the rest may be nearer than any below: of fitting lengths, or one document of the next longer length.
    most = left + (sizes[fitting[0]] if fitting else 0)
    longer = min((i for i in order if sizes[i] > left and take[i] < counts[i]), key=lambda i: sizes[i], default=None)
    unit = math.gcd(*[sizes[i] for i in fitting]) or 1
    goal = (left + (unit - 1) // 2) // unit * unit  # no sum of fitting lengths is nearer
    mask, reached, steps = (1 << (most + 1)) - 1, 1, []
    first = np.zeros(most + 1, np.int32)  # the step that reached a sum
    for i in fitting:
        spare, times = min(counts[i] - take[i], most // sizes[i]), 1
        while spare > 0 and not reached >> goal & 1:
            part = min(times, spare)  # 1, 2, 4, ... and a last part make up any number to spare
            fresh = (reached << (part * sizes[i])) & mask & ~reached
            if fresh:
                first[_ones(fresh)] = len(steps)
                steps.append((i, part))
                reached |= fresh
            spare, times = spare - part, times * 2
        if reached >> goal & 1:
            break
    below = (reached & ((1 << (left + 1)) - 1)).bit_length() - 1
    beyond = reached >> (left + 1)
    above = left + (beyond & -beyond).bit_length() if beyond else None
    if longer is not None and (above is None or sizes[longer] < above) and sizes[longer] - left < left - below:
        take[longer] += 1
        return take
    at = above if above is not None and above - left < left - below else below
    while at:  # what a step added to was reached by steps before it
        i, part = steps[first[at]]
        take[i] += part
        at -= part * sizes[i]
    return take


def plan(rows: DataFrame) -> DataFrame:
    """Per source, length and hash range: whole ``passes``, documents to take, and those taken in earlier ranges."""
    ranges = common.stored(rows.groupBy("source", "name", "size", "range").agg(F.count("*").alias("n")), "mix-counts")
    lengths = ranges.groupBy("source", "name", "size").agg(F.sum("n").alias("n"))
    goals = common.stored(targets(lengths), "mix-targets")
    passes = F.when(F.col("source_size") > 0, F.least(F.lit(MOST), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("int")
    goals = goals.withColumn("passes", passes)
    goals = goals.withColumn("budget", F.floor(F.col("target") - F.col("passes") * F.col("source_size") + 0.5).cast("long"))

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        take = fit(group["size"].tolist(), group["n"].tolist(), int(group["budget"].iloc[0]))
        return group[["name", "size"]].assign(take=take)

    budgets = lengths.join(goals.select("name", "budget"), "name").select("name", "size", "n", "budget")
    taken = budgets.groupBy("name").applyInPandas(choose, "name string, size long, take long")
    along = Window.partitionBy("name", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counted = ranges.withColumn("earlier", F.coalesce(F.sum("n").over(along), F.lit(0)))
    return (
        counted.join(taken, ["name", "size"])
        .join(goals, "name")
        .select("name", "size", "range", "earlier", "take", "passes", "source_size", "target")
    )


def _mixed(docs: DataFrame, keep: Sequence[str], text: str, seed: int) -> DataFrame:
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    narrow = docs.select("doc_id", "source", F.col(text).cast("string").alias("text"), *kept)
    rows = measured(narrow, "text", seed).drop("text")
    chosen = common.stored(plan(rows.select("source", "name", "size", "range")), "mix-plan")
    joined = rows.join(chosen, ["name", "size", "range"])
    turn = F.row_number().over(Window.partitionBy("name", "size", "range").orderBy("draw", "doc_id"))
    return joined.withColumn("copies", F.col("passes") + (turn <= F.col("take") - F.col("earlier")).cast("int"))


def mix(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", seed: int = SEED) -> DataFrame:
    """One row per document: ``keep``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` words."""
    return _mixed(docs, keep, text, seed).select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def repeated(docs: DataFrame, text: str = "text", seed: int = SEED) -> DataFrame:
    """The documents, unchanged, each as often as the mix takes it."""
    mixed = _mixed(docs, docs.columns, text, seed).where("copies > 0")
    each = mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
