"""Hard negatives: for an anchor and each of its positives, the best-scored rows of other labels within a window.

Scores are integer inner products of quantised vectors. Rows are stored once and dealt into blocks. Every
block is a set of candidate lists, one per dimension, sorted by that component. The threshold algorithm walks them for
each anchor: it reads a list from its top where the anchor's component is positive and from its
bottom where it is negative, scores every row it meets, and knows from the components last read what a
row not yet met can score at most. It stops when that threshold is strictly below the k-th score of every
window, or below a window that is not full. A first walk finds the positives, whose scores set
the windows of the second one; the blocks' results are merged by rank. Anchors meet all rows in blocks
of both, so a task holds ``ROWS`` rows and ``ANCHORS`` anchors at most, about.

Rows with a null label, a null vector, or any null or non-finite component take no part. A vector meets vectors of its
own length only. An id that is repeated is one anchor (its least label and vector); rows with the anchor's own id are
never its positives or negatives, other repeated rows count each. Rows with a null id are candidates, after others of
equal score. Quantised components are whole numbers of 64 bits, larger ones count as the largest; a score beyond 64
bits is ranked exactly, but reported, and its window set, as the largest. Fewer rows than asked for, or none, give fewer rows. Further
columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import common

SCALE = 256
ROWS = 8192
ANCHORS = 4096
FIRST_STEP = 16  # entries read from each list at first; the depth doubles from there

FOUND = "anchor_id long, positive_score long, row_id long, score long"
FOUND_ARROW = pa.schema([(name, pa.int64()) for name in ("anchor_id", "positive_score", "row_id", "score")])
WIDEST = 2**63 - 1


def participants(vectors: DataFrame, scale: int) -> DataFrame:
    """``row_id``, ``label``, ``q`` (the quantised vector) and ``place``, a number of the stored row."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    q = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    kept = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    kept = kept.select(F.col("vec_id").cast("long").alias("row_id"), F.col("label").cast("long").alias("label"), q.alias("q"))
    return common.stored(kept.withColumn("place", F.monotonically_increasing_id()), "rows")


class SortedLists:
    """The rows of a block under one list per dimension."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.rising = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T)
        self.falling = self.rising[:, ::-1]

    def walk(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, object]]:
        """Rows met so far, the scores of all of these, and what a row not met can score at most (None: all are met)."""
        n = len(self.x)
        used = np.flatnonzero(anchor != 0)
        up, down = used[anchor[used] > 0], used[anchor[used] < 0]
        met, scores = np.zeros(n, dtype=bool), np.zeros(n, dtype=self.x.dtype)
        depth, end = 0, min(FIRST_STEP, n)
        while len(used) and end < n:
            before = met.copy()
            met[self.falling[up, depth:end]] = True
            met[self.rising[down, depth:end]] = True
            fresh = np.flatnonzero(met & ~before)
            scores[fresh] = self.x[fresh] @ anchor
            top = (self.x[self.falling[up, end - 1], up] * anchor[up]).sum() + (self.x[self.rising[down, end - 1], down] * anchor[down]).sum()
            if met.all():
                break
            yield met, scores, top
            depth, end = end, min(2 * end, n)
        rest = np.flatnonzero(~met)
        scores[rest] = self.x[rest] @ anchor
        yield np.ones(n, dtype=bool), scores, None


def best(lists: SortedLists, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple], ids: np.ndarray, no_id: np.ndarray, k: int):
    """The first k allowed rows of each window (least and largest score, both included) and all scores."""
    for met, scores, top in lists.walk(anchor):
        candidates = np.flatnonzero(met & allowed)
        own = scores[candidates]
        inside = [candidates[(own >= low) & (own <= high)] for low, high in windows]
        if top is None or all(top < (np.partition(scores[w], -k)[-k] if len(w) >= k else low) for w, (low, _) in zip(inside, windows)):
            break
    return [w[np.lexsort((ids[w], no_id[w], -scores[w]))[:k]] for w in inside], scores


def _vectors(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and whole-number vectors of the rows of each length."""
    column = table["q"].combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat, starts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()[:-1]
    found = []
    for length in np.unique(lengths):
        place = np.flatnonzero(lengths == length)
        found.append((place, flat[starts[place][:, None] + np.arange(length)[None, :]].astype(np.int64).reshape(len(place), length)))
    return found


def _suited(rows: np.ndarray, anchors: np.ndarray) -> type:
    """The fastest kind of number in which all scores are exact."""
    largest = [max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0 for x in (rows, anchors)]
    bound = rows.shape[1] * largest[0] * largest[1]
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else object


def _search(anchors: pa.Table, rows: pa.Table, k: int, same_label: bool, low: int, high: int) -> pa.Table:
    """The first k rows of a block for each window of each anchor."""
    label, ids = rows["label"].to_numpy(), rows["row_id"].fill_null(WIDEST).to_numpy()
    no_id = rows["row_id"].is_null().to_numpy()
    anchor_label, anchor_id = anchors["label"].to_numpy(), anchors["anchor_id"].to_numpy()
    scores_of = anchors["positive_scores"].to_pylist()
    by_length = {x.shape[1]: (place, x) for place, x in _vectors(rows)}
    out: list[list] = [[], [], [], []]
    for asked, vectors in _vectors(anchors):
        if vectors.shape[1] not in by_length:
            continue
        place, x = by_length[vectors.shape[1]]
        kind = _suited(x, vectors)
        lists, vectors = SortedLists(x.astype(kind)), vectors.astype(kind)
        for i, vector in zip(asked, vectors):
            same = label[place] == anchor_label[i]
            allowed = (same if same_label else ~same) & (no_id[place] | (ids[place] != anchor_id[i]))
            # Whole-number bounds of low * positive <= 100 * score <= high * positive.
            windows = [(-(-low * p // 100), high * p // 100) for p in scores_of[i]] if not same_label else [(-np.inf, np.inf)]
            firsts, scores = best(lists, vector, allowed, windows, ids[place], no_id[place], k)
            for positive, first in zip(scores_of[i] or [None], firsts):
                out[0] += [int(anchor_id[i])] * len(first)
                out[1] += [positive] * len(first)
                out[2] += [None if no_id[place[r]] else int(ids[place[r]]) for r in first]
                out[3] += [max(-WIDEST, min(WIDEST, int(scores[r]))) for r in first]
    return pa.Table.from_arrays([pa.array(column, pa.int64()) for column in out], schema=FOUND_ARROW)


def _found(anchors: DataFrame, rows: DataFrame, chunks: int, blocks: int, key: list[str], k: int, **search) -> DataFrame:
    """The first k rows over all blocks for each of ``key``, with their ``rank``."""
    left = anchors.withColumn("chunk", F.pmod(F.xxhash64("anchor_id"), F.lit(chunks)).cast("int"))
    left = left.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = rows.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(blocks)).cast("int")).drop("place")
    right = right.select("*", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))

    def search_block(a: pa.Table, r: pa.Table) -> pa.Table:
        return _search(a, r, k, **search)

    found = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInArrow(search_block, FOUND)
    order = Window.partitionBy(*key).orderBy(F.desc("score"), F.asc_nulls_last("row_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = SCALE,
    rows_a_block: int = ROWS, anchors_a_chunk: int = ANCHORS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are the rows whose vec_id ``every`` divides; their positives the first ``positives`` rows of the same label;
    a positive's negatives the first ``negatives`` rows of other labels that score ``low`` to ``high`` per cent of it.
    ``positive_rank`` tells the positives of an anchor apart.
    """
    rows = participants(vectors, scale)
    is_anchor = F.col("row_id") % every == 0
    n, asking = rows.agg(F.count("*"), F.count_if(is_anchor)).first()
    blocks, chunks = max(1, -(-n // rows_a_block)), max(1, -(-asking // anchors_a_chunk))
    anchors = rows.where(is_anchor).groupBy(F.col("row_id").alias("anchor_id")).agg(F.min(F.struct("label", "q")).alias("least"))
    anchors = common.stored(anchors.select("anchor_id", "least.label", "least.q"), "anchors")

    unknown = F.array().cast("array<long>").alias("positive_scores")
    near = _found(anchors.select("*", unknown), rows, chunks, blocks, ["anchor_id"], positives, same_label=True, low=low, high=high)
    near = near.select("anchor_id", F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("positive_rank"))
    near = common.stored(near, "positives")

    # At most `positives` scores per anchor are collected.
    windows = near.groupBy("anchor_id").agg(F.collect_set("positive_score").alias("positive_scores"))
    key = ["anchor_id", "positive_score"]
    far = _found(anchors.join(windows, "anchor_id"), rows, chunks, blocks, key, negatives, same_label=False, low=low, high=high)
    far = far.select(*key, "rank", F.col("row_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return near.join(far, key).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank"
    )
