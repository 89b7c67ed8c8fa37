"""A forest over MinHash signatures: sorted orders, neighbours by longest common prefix, depth by region.

A signature holds ``TREES * DEPTH`` minima of 16 bits. Tree t is the order of all signatures that starts
at minimum ``DEPTH * t``; all orders are sorted at once, by a range partition and a sort within the ranges.
A region is a run of one order whose first minima agree: the first ``DEPTH`` of them, and one more, up to
``2 * DEPTH``, wherever a run has more than ``Bounds.region`` rows. The rows of a region are each other's
neighbours by longest common prefix, and so candidates; those still too many at the greatest depth are taken
in windows of the order. Near rows of a region are tied to one of them, and the regions of a run by those rows.

Candidates are compared by a sketch, one bit of each minimum, and the size of their sets. A pair of similarity 0.8
agrees in 115 of 128 bits with a deviation of 3.4; ``MOST_DIFFERENT`` is almost nine deviations from that, and unrelated
pairs pass once in ten thousand. A region gives ties that connect its near pairs, never all of its pairs.

Greater depth parts pairs that agree in the first ``DEPTH`` minima only, and the end of a range may cut a
region. No such pair is given up: the runs concerned are written down, and where one holds several of the components
found so far, its rows of about the same size meet in pairs of blocks, by their sketches. Runs of equal members in several
trees are taken once. Rows that move for such a run grow with the square of its rows of one size band over ``Bounds.block``; no texts move.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import common
from millrace.llm.graph import components

TREES, DEPTH = 32, 4
HASHES = TREES * DEPTH
MOST_DIFFERENT = 43  # bits of a sketch
LEAST_RATIO = (4, 5)  # of the sizes of two sets of similarity 0.8
BAND = 1.26  # sizes of a ratio of 0.8 or more are in one band or in neighbouring ones


@dataclass(frozen=True)
class Bounds:
    """How many rows are taken at one time; results are the same with any."""

    region: int = 256
    small: int = 8  # regions up to this size are compared together, by shifting the whole order
    held: int = 4096  # rows of one run that a task holds before it takes them as crowded
    block: int = 1024


BOUNDS = Bounds()

_PLACED = "tree int, first long, next long, rep long, low long, high long, size long"
_FOUND = "a long, b long, run long, low long, high long, size long"
_NAMES = [part.split()[0] for part in _FOUND.split(", ")]


def placed(classes: DataFrame, size: str | None) -> DataFrame:
    """Each class once per tree: its place in the order (two numbers of ``DEPTH`` minima each), sketch and size."""
    rows = classes.select("rep", "sig", (F.col(size) if size else F.lit(0)).cast("long").alias("size"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            minima = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype="<u2").reshape(n, HASHES)
            first = minima.astype(">u2").view(">u8").astype(np.uint64)
            sketch = np.packbits((minima & 1).astype(np.uint8), axis=1).view(np.uint64)
            columns = [
                np.tile(np.arange(TREES, dtype=np.int32), n),
                first.ravel().view(np.int64),
                np.roll(first, -1, axis=1).ravel().view(np.int64),
                *[np.repeat(x, TREES) for x in (batch.column("rep").to_numpy(), sketch[:, 0].view(np.int64), sketch[:, 1].view(np.int64))],
                np.repeat(batch.column("size").to_numpy(), TREES),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[part.split()[0] for part in _PLACED.split(", ")])

    return rows.mapInArrow(work, _PLACED)


def near(one: dict[str, np.ndarray], other: dict[str, np.ndarray]) -> np.ndarray:
    """Whether rows may be similar, by sketch and size; arrays are paired as numpy does."""
    different = sum(np.bitwise_count((one[half] ^ other[half]).view(np.uint64)) for half in ("low", "high"))
    num, den = LEAST_RATIO
    fits = np.minimum(one["size"], other["size"]) * den >= np.maximum(one["size"], other["size"]) * num
    return (different <= MOST_DIFFERENT) & fits


def taken(rows: dict[str, np.ndarray], at) -> dict[str, np.ndarray]:
    return {name: column[at] for name, column in rows.items()}


def labels(linked: np.ndarray) -> np.ndarray:
    """The least member of each row's component in a symmetric matrix of links."""
    n = len(linked)
    own = np.arange(n)
    while True:
        least = np.minimum(own, np.where(linked, own[None, :], n).min(axis=1, initial=n))
        least = least[least]
        if (least == own).all():
            return own
        own = least


def _groups(change: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the rows that begin a group: each row's group, the groups' starts and their sizes."""
    starts = np.flatnonzero(change)
    return np.cumsum(change) - 1, starts, np.diff(np.append(starts, len(change)))


def _begins(*columns: np.ndarray) -> np.ndarray:
    change = np.ones(len(columns[0]), dtype=bool)
    change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return change


def regions(rows: dict[str, np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group of each row at the least depth that leaves no more than ``most`` rows, the groups' starts and sizes."""
    change = _begins(rows["tree"], rows["first"])
    group, starts, sizes = _groups(change)
    for deeper in range(1, DEPTH + 1):
        crowded = sizes[group] > most
        if not crowded.any():
            break
        change |= crowded & _begins(rows["next"].view(np.uint64) >> np.uint64(16 * (DEPTH - deeper)))
        group, starts, sizes = _groups(change)
    return group, starts, sizes


def hubs(rows: dict[str, np.ndarray], most: int) -> np.ndarray:
    """For the rows of one run, the place of a row that each is tied to: regions first, then the rows they are tied to, in windows."""
    group = regions(rows, most)[0]
    own, active = np.arange(len(group)), np.arange(len(group))
    # A region is one window, or several where it is crowded at the greatest depth.
    windows = [w for g in np.split(active, np.flatnonzero(np.diff(group)) + 1) for w in np.split(g, range(most, len(g), most))]
    while True:
        for at in windows:
            window = taken(rows, at)
            own[at] = at[labels(near({n: c[:, None] for n, c in window.items()}, {n: c[None, :] for n, c in window.items()}))]
        before, active = len(active), active[own[active] == active]
        if len(windows) == 1 or len(active) == before:
            break
        windows = np.split(active, range(most, len(active), most))
    while (own[own] != own).any():
        own = own[own]
    return own


def ties(rows: dict[str, np.ndarray], bounds: Bounds) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``rep`` that connect the near pairs of every region of a sorted stretch of orders, the lesser first."""
    run, starts, sizes = _groups(_begins(rows["tree"], rows["first"]))
    rep, found = rows["rep"], [np.zeros((2, 0), np.int64)]
    few = sizes[run] <= bounds.small
    for k in range(1, min(bounds.small, len(run))):
        at = np.flatnonzero((run[k:] == run[:-k]) & few[k:])
        at = at[near(taken(rows, at), taken(rows, at + k))]
        found.append(np.sort([rep[at], rep[at + k]], axis=0))
    for g in np.flatnonzero(sizes > bounds.small).tolist():
        part = taken(rows, slice(starts[g], starts[g] + sizes[g]))
        own, least = hubs(part, bounds.region), part["rep"].copy()
        # The least member stands for the others, so that it is the same one in most trees.
        np.minimum.at(least, own, part["rep"])
        some = least[own] != part["rep"]
        found.append(np.stack([least[own][some], part["rep"][some]]))
    return tuple(np.concatenate(found, axis=1))


def _run_ids(rows: dict[str, np.ndarray]) -> np.ndarray:
    """One number per tree and first minima; should two runs have the same, they are compared as one."""
    with np.errstate(over="ignore"):
        return (rows["first"].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + rows["tree"].astype(np.uint64)).view(np.int64)


def _found(rows: dict[str, np.ndarray], cut: list[tuple], bounds: Bounds) -> pa.RecordBatch:
    """Ties (``a``, ``b``), and the members of runs that are crowded or begin or end outside of these rows (``run``)."""
    a, b = ties(rows, bounds)
    run, _, sizes = _groups(_begins(rows["tree"], rows["first"]))
    open_runs = np.logical_or.reduce([(rows["tree"] == tree) & (rows["first"] == first) for tree, first in cut] + [sizes[run] > bounds.region])
    members = taken(rows, np.flatnonzero(open_runs))
    blank, none = np.zeros(len(a), np.int64), np.zeros(len(members["rep"]), np.int64)
    is_tie = np.repeat([True, False], [len(a), len(none)])
    columns = [
        pa.array(np.concatenate([a, members["rep"]])),
        pa.array(np.concatenate([b, none]), mask=~is_tie),
        pa.array(np.concatenate([blank, _run_ids(members)]), mask=is_tie),
        *[pa.array(np.concatenate([blank, members[name]]), mask=is_tie) for name in ("low", "high", "size")],
    ]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def walk(batches: Iterator[pa.RecordBatch], bounds: Bounds = BOUNDS) -> Iterator[pa.RecordBatch]:
    """Go along a sorted range; the last run of a batch waits for the next one, unless it is crowded already."""
    held, cut = None, None
    for batch in batches:
        rows = {name: batch.column(name).to_numpy() for name in batch.schema.names}
        if not batch.num_rows:
            continue
        if held:
            rows = {name: np.concatenate([held[name], column]) for name, column in rows.items()}
        cut = cut or (rows["tree"][0], rows["first"][0])
        last = np.flatnonzero(_begins(rows["tree"], rows["first"]))[-1]
        if len(rows["tree"]) - last > bounds.held:
            yield _found(rows, [cut, (rows["tree"][-1], rows["first"][-1])], bounds)
            held, cut = None, (rows["tree"][-1], rows["first"][-1])
        else:
            if last:
                yield _found(taken(rows, slice(0, last)), [cut], bounds)
            held = taken(rows, slice(last, None))
    if held:
        yield _found(held, [(held["tree"][-1], held["first"][-1])], bounds)


def across(members: DataFrame, roots: DataFrame, block: int) -> DataFrame:
    """Ties between components that share a crowded or cut run: all rows of neighbouring sizes meet there, in blocks."""
    rows = members.join(roots.withColumnRenamed("node", "a"), "a", "left").withColumn("root", F.coalesce("root", "a"))
    band = F.floor(F.log(F.greatest(F.col("size"), F.lit(1)).cast("double")) / float(np.log(BAND))).cast("int")
    banded = rows.withColumn("band", F.explode(F.array(band, band + 1)))
    groups = banded.groupBy("run", "band").agg(
        F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most"), F.bit_xor(F.xxhash64("a")).alias("of")
    )
    # Runs with the same members need to be looked at once.
    wanted = groups.where("least <> most").dropDuplicates(["n", "least", "most", "of"])
    blocks = F.ceil(F.col("n") / block).cast("int")
    dealt = banded.join(wanted.select("run", "band", blocks.alias("blocks")), ["run", "band"])
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    keyed = dealt.select("run", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "root", "low", "high", "size")

    def work(table: pa.Table) -> pa.Table:
        rows = {name: table.column(name).to_numpy() for name in ("root", "low", "high", "size")}
        found = set()
        for at in range(len(rows["root"])):
            some = np.flatnonzero(near(taken(rows, at), rows) & (rows["root"] > rows["root"][at]))
            found.update((int(rows["root"][at]), int(b)) for b in np.unique(rows["root"][some]))
        a, b = zip(*sorted(found), strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return keyed.groupBy("run", "band", "i", "j").applyInArrow(work, "a long, b long").distinct()


def clusters(classes: DataFrame, size: str | None = None, bounds: Bounds = BOUNDS) -> DataFrame:
    """``node`` and ``root`` of the classes (``rep``, ``sig``) that may be similar to another one.

    ``size`` names the column of the sets' sizes, by which pairs that cannot be similar are told; without it all are taken
    to be of one size. ``sig`` and ``rep`` are not null and ``rep`` is unique; without classes there are no rows.
    """
    order = ["tree", "first", "next", "rep"]  # the last one lets a place that many classes share spread over ranges
    sorted_orders = placed(classes, size).repartitionByRange(*order).sortWithinPartitions(*order)
    found = common.stored(sorted_orders.mapInArrow(partial(walk, bounds=bounds), _FOUND), "forest")
    # A row of several trees is tied to the least of its partners, and that one to the others.
    tied = found.where("run is null").groupBy("b").agg(F.collect_set("a").alias("others"))
    each = tied.select(F.array_min("others").alias("a"), F.explode(F.array_union("others", F.array("b"))).alias("b"))
    roots = components(each.where("a <> b").distinct())
    more = common.stored(across(found.where("run is not null").drop("b"), roots, bounds.block), "forest-across")
    if more.isEmpty():
        return roots
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
