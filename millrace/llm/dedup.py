"""Near duplicates: an LSH forest of MinHash signatures, confirmed on whole shingle sets.

A document's set holds the 64-bit hashes of its word shingles. Documents with equal sets form a
class, and only a class's representative (its least id) goes on. ``forest.py`` sorts the signatures in
``TREES`` orders and takes neighbours by longest common prefix, at a depth that adapts to how crowded a region
is; its ties, and those between components that share a crowded region, make clusters: all pairs
that agree in the first ``DEPTH`` minima of an order, and in enough of a sketch, lie within one cluster.

Within a cluster the pairs that share a region are taken by the longest prefix that any tree's order
gives them in common (up to four times ``DEPTH``), from deep to shallow. A pair
is confirmed on the whole sets, unless it is known to be connected. Clusters beyond
``BLOCK`` members are dealt out in pairs of blocks, so that every pair of members still meets, in
tasks of at most two blocks. A pair of similarity 0.8 shares no region with a probability of
(1 - 0.8 ** 4) ** 32 = 5e-8.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Null and empty texts have an empty set and
are linked with nothing. Repeated rows fall into one class; rows that share an id but not the text are
one document with the links of all its texts. Rows with a null id take the component
of their class, which is null when no row of it has an id; they are kept in that case only. Further
columns do not matter; an empty table gives an empty result. A text is hashed whole, however long: its words and
the hashes of its shingles lie in memory at one time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import common, forest
from millrace.llm.forest import DEPTH, HASHES, TREES
from millrace.llm.graph import components

WORDS = 5
SIMILARITY = (4, 5)  # at least 4/5
REMEMBERED = 400_000  # word hashes of a worker
BLOCK = 256
BROADCAST_IDS = 1_000_000  # ids of cluster members that every task may hold, about 100 MB
# Of 128 minima a pair of similarity 0.8 shares 102 with a deviation of 4.5: seven deviations less.
LEAST_SHARED = 70

_MIX = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(7)
_FACTORS = (_RNG.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_ADDENDS = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)[:, None]


class Shingler:
    """Sorted 64-bit hashes of the distinct shingles of a text."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        own, width = self._hashes(words), min(self.width, len(words))
        mixed = np.full(len(own) - width + 1, np.uint64(width))
        for k in range(width):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + own[k : len(own) - width + 1 + k]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
        return np.unique(mixed ^ (mixed >> np.uint64(29)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima of HASHES linear maps of the shingles, each reduced to 16 bits."""
    least = np.full(HASHES, np.uint32(2**32 - 1))
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(least, (short[at : at + 1024] * _FACTORS + _ADDENDS).min(axis=1), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


_MEASURED = "doc_id long, text_hash long, n_shingles long, set_id binary, sig binary"


def measured(docs: DataFrame, text: str = "text", width: int = WORDS) -> DataFrame:
    """Per document the size and a digest of its set and its signature (both null for an empty set), stored."""
    common.small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    names = [part.split()[0] for part in _MEASURED.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            sizes, ids, signatures = [], [], []
            for whole in batch.column("text").to_pylist():
                own = shingler(whole)
                sizes.append(len(own))
                ids.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                signatures.append(signature(own).tobytes() if len(own) else None)
            made = [pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=names)

    return common.stored(rows.mapInArrow(work, _MEASURED), "dedup-sets")


def clusters(classes: DataFrame, size: str | None = None) -> DataFrame:
    """``node`` and ``root`` of the representatives that may be similar to another, by the forest."""
    return forest.clusters(classes, size)


def _depths(same: np.ndarray) -> np.ndarray:
    """For pairs, whose equal minima are the rows of ``same``, the longest common prefix among the trees' orders."""
    doubled = np.concatenate([same, same], axis=1)
    depths = np.zeros(len(same), dtype=np.int16)
    for tree in range(TREES):
        start = tree * DEPTH
        order = doubled[:, start : start + 4 * DEPTH]  # deeper than that the order of pairs hardly matters
        np.maximum(depths, np.logical_and.accumulate(order, axis=1).sum(axis=1, dtype=np.int16), out=depths)
    return depths


def links(sets: list[np.ndarray], sig: np.ndarray, side: np.ndarray | None) -> list[tuple[int, int]]:
    """Confirmed links that connect what is connected; with ``side`` only between rows of different sides."""
    n, (num, den) = len(sets), SIMILARITY
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    shared = np.stack([(row == sig).sum(axis=1, dtype=np.int16) for row in sig])
    sizes = np.array([len(s) for s in sets])
    fits = np.minimum(sizes[:, None], sizes[None, :]) * den >= np.maximum(sizes[:, None], sizes[None, :]) * num
    wanted = np.triu((shared >= LEAST_SHARED) & fits, 1)
    if side is not None:
        wanted &= side[:, None] != side[None, :]
    first, second = np.nonzero(wanted)
    depths = np.concatenate(
        [np.zeros(0, np.int16)]
        + [_depths(sig[first[at : at + 8192]] == sig[second[at : at + 8192]]) for at in range(0, len(first), 8192)]
    )
    region = depths >= DEPTH
    first, second, depths = first[region], second[region], depths[region]
    order = np.lexsort((-shared[first, second], -depths))
    found = []
    for a, b in zip(first[order].tolist(), second[order].tolist(), strict=True):
        ra, rb = find(a), find(b)
        if ra == rb:
            continue
        both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            root[max(ra, rb)] = min(ra, rb)
            found.append((a, b))
    return found


def confirmed(docs: DataFrame, members: DataFrame, text: str, width: int, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """Links (``a``, ``b``) between representatives, confirmed on whole texts.

    Only members of clusters have their texts moved, as long as their ids, which are counted, are no more than
    ``broadcast_ids``; with more all texts meet the ids in a shuffle.
    """
    sizes = members.groupBy("root").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = members.join(sizes, "root").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    keyed = dealt.select("node", "set_hash", "root", "sig", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col(text).cast("string").alias("text"))
    # A representative's text is met once before it is dealt to the pairs of blocks of its cluster.
    wanted = members.select("node", "set_hash").distinct()
    if members.count() <= broadcast_ids:
        wanted = F.broadcast(wanted)
    own = texts.withColumn("set_hash", F.xxhash64("text")).join(wanted, ["node", "set_hash"]).dropDuplicates(["node", "set_hash"])
    rows = keyed.join(own, ["node", "set_hash"])

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("node", "ascending"), ("set_hash", "ascending")])
        shingler = Shingler(width)
        sets = [shingler(t) for t in table.column("text").to_pylist()]
        sig = np.stack([np.frombuffer(s, dtype=np.uint16) for s in table.column("sig").to_pylist()])
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        found = links(sets, sig, None if i == j else table.column("own").to_numpy())
        nodes = table.column("node").to_numpy()
        a, b = [nodes[x] for x, _ in found], [nodes[y] for _, y in found]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("root", "i", "j").applyInArrow(work, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", width: int = WORDS) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` and ``kept``."""
    sets = measured(docs, text, width)
    some = sets.where("set_id is not null")
    least = some.where("doc_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    # The row of the representative has the class's signature; it is met by its own id, not by the class.
    own = some.select(F.col("set_id").alias("s"), F.col("doc_id").alias("d"), "sig", "n_shingles", F.col("text_hash").alias("set_hash"))
    met = least.join(own, (F.col("set_id") == F.col("s")) & (F.col("rep") == F.col("d"))).select("set_id", "rep", "sig", "n_shingles", "set_hash")
    classes = common.stored(met.dropDuplicates(["set_id"]), "dedup-classes")
    roots = clusters(classes, "n_shingles")
    members = common.stored(
        roots.join(classes.withColumnRenamed("rep", "node"), "node").select("node", "root", "sig", "set_hash"), "dedup-members"
    )
    found = components(confirmed(docs, members, text, width)).select(F.col("node").alias("rep"), F.col("root").alias("least"))
    component = classes.join(found, "rep", "left").select(
        F.col("set_id").alias("of"), F.coalesce("least", "rep").alias("of_class")
    )
    rows = sets.join(component, F.col("set_id") == F.col("of"), "left")
    component_id = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("of_class"))
    return rows.select("doc_id", "text_hash", "n_shingles", component_id.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def deduplicated(docs: DataFrame, text: str = "text", width: int = WORDS) -> DataFrame:
    """The documents with one row per group; of rows that repeat an id and text one stays, with it any of a null id."""
    kept = near_duplicates(docs, text, width).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    own = common.numbered(docs)
    doc_id, whole = (F.col(f"col_{docs.columns.index(c)}") for c in ("doc_id", text))
    rows = own.withColumns({"row_id": doc_id, "row_hash": F.xxhash64(whole.cast("string"))})
    same = F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_hash") == F.col("kept_hash"))
    met = rows.join(kept.distinct(), same, "left_semi").dropDuplicates(["row_id", "row_hash"])
    return met.drop("row_id", "row_hash").toDF(*docs.columns)
