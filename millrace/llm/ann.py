"""Nearest neighbours by learned partitions.

On a bounded sample the exact neighbour graph is cut into balanced parts, by recursive bisection
with the graph's second eigenvector and exchanges of vertices that lower the cut. A small
classifier learns the parts of each sampled vector's neighbours. It then places every row in its
most probable part and sends each query to several; within them candidates are ranked by exact
cosines. How many parts are asked is measured: the least number that finds ``RECALL`` of the sample's
own neighbours. Parts are read in blocks of about ``BLOCK`` rows, so that neither a part with a third of
all rows nor one vector's many copies make a large task.

Vectors that are null, zero or hold null, NaN or infinite components take no part, nor do vectors
of another length than the most frequent one (of equal frequencies the greater length). A repeated id is one query (its
least vector); candidates keep all rows but those with the query's own id. Rows with a null id are
candidates, after others at equal nearness. Fewer candidates than asked for, or none, give fewer
rows. Further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import common

SAMPLE = 4096
PER_PART = 128  # sampled vectors
NEIGHBOURS = 10
HIDDEN = 128
ROUNDS = 25
RECALL = 0.95
LEAST_CANDIDATES = 64
BLOCK = 4096
TIE = 1e-9  # wider than the rounding of a matrix product


@dataclass
class Router:
    """A network of one hidden layer; without layers everything is in part 0."""

    layers: list[np.ndarray]
    parts: int
    probes: int

    def scores(self, unit: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.zeros((len(unit), 1))
        w1, b1, w2, b2 = self.layers
        return np.maximum(unit @ w1 + b1, 0) @ w2 + b2


def units(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that huge components do not overflow in the norm.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def neighbours(unit: np.ndarray, k: int) -> np.ndarray:
    near = unit @ unit.T
    np.fill_diagonal(near, -np.inf)
    k = min(k, len(unit) - 1)
    return np.argpartition(-near, k - 1, axis=1)[:, :k]


def bisect(graph: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Two halves of a weighted graph: split at the median of the second eigenvector, then exchange vertices."""
    n = len(graph)
    root = np.sqrt(np.maximum(graph.sum(1), 1e-9))
    lead, x = root / np.linalg.norm(root), rng.normal(size=n).astype(graph.dtype)
    for _ in range(60):
        x -= lead * (lead @ x)
        x = 0.5 * (x + (graph @ (x / root)) / root)
        x /= max(np.linalg.norm(x), 1e-12)
    side = np.zeros(n, dtype=bool)
    side[np.argsort(x / root, kind="stable")[n // 2 :]] = True
    for _ in range(20):
        to_right = graph @ side.astype(graph.dtype)
        gain = np.where(side, graph.sum(1) - 2 * to_right, 2 * to_right - graph.sum(1))
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right), max(1, n // 50))
        better = (gain[left[:m]] + gain[right[:m]]) > 2 * graph[left[:m], right[:m]]
        if not better.any():
            break
        before = graph[np.ix_(side, ~side)].sum()
        trial = side.copy()
        trial[left[:m][better]], trial[right[:m][better]] = True, False
        if graph[np.ix_(trial, ~trial)].sum() >= before:
            break
        side = trial
    return side


def partition(near: np.ndarray, parts: int) -> np.ndarray:
    """Balanced parts (a power of two) of the neighbour graph."""
    n = len(near)
    graph = np.zeros((n, n), dtype=np.float32)
    graph[np.repeat(np.arange(n), near.shape[1]), near.ravel()] = 1
    graph = graph + graph.T
    part, rng = np.zeros(n, dtype=np.int64), np.random.default_rng(0)
    while part.max() + 1 < parts:
        finer = np.empty_like(part)
        for p in range(part.max() + 1):
            own = np.flatnonzero(part == p)
            finer[own] = 2 * p + bisect(graph[np.ix_(own, own)], rng)
        part = finer
    return part


def learn(unit: np.ndarray, near: np.ndarray, part: np.ndarray, parts: int) -> list[np.ndarray]:
    """The classifier: trained with Adam on the share of each part among a vector and its neighbours."""
    rng, n, d = np.random.default_rng(1), *unit.shape
    goal = np.zeros((n, parts))
    np.add.at(goal, (np.arange(n), part), 1.0)
    for column in near.T:
        np.add.at(goal, (np.arange(n), part[column]), 1.0)
    goal /= goal.sum(1, keepdims=True)
    w = [rng.normal(size=(d, HIDDEN)) * np.sqrt(2.0), np.zeros(HIDDEN), rng.normal(size=(HIDDEN, parts)) / np.sqrt(HIDDEN), np.zeros(parts)]
    m, v, t = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w], 0
    for epoch in range(ROUNDS):
        rate = 0.003 * (1 - epoch / ROUNDS)
        order = rng.permutation(n)
        for at in range(0, n, 128):
            x, y = unit[order[at : at + 128]], goal[order[at : at + 128]]
            hidden = np.maximum(x @ w[0] + w[1], 0)
            out = hidden @ w[2] + w[3]
            share = np.exp(out - out.max(1, keepdims=True))
            error = (share / share.sum(1, keepdims=True) - y) / len(x)
            back = (error @ w[2].T) * (hidden > 0)
            t += 1
            for i, g in enumerate((x.T @ back, back.sum(0), hidden.T @ error, error.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] -= rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return w


def fit(vectors: np.ndarray, k: int) -> Router:
    """Learn the parts from a sample. Fewer than two times ``PER_PART`` vectors are one part."""
    parts = 1 << int(np.log2(max(1, len(vectors) // PER_PART)))
    if parts < 2:
        return Router([], 1, 1)
    unit = units(vectors)
    near = neighbours(unit, NEIGHBOURS)
    part = partition(near, parts)
    # The probes are counted on vectors that the classifier has not seen.
    seen = np.arange(len(unit)) % 8 != 0
    inner = neighbours(unit[seen], NEIGHBOURS)
    trial = Router(learn(unit[seen], inner, part[seen], parts), parts, parts)
    placed = trial.scores(unit).argmax(1)
    asked = np.flatnonzero(~seen)
    order = np.argsort(-trial.scores(unit[asked]), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(parts), order.shape).copy(), 1)
    exact = unit[asked] @ unit[seen].T
    top = np.argpartition(-exact, k - 1, axis=1)[:, :k]
    at = np.take_along_axis(rank, placed[seen][top], 1)
    probes = next((p for p in range(1, parts) if (at < p).mean() >= RECALL), parts)
    return Router(trial.layers, parts, probes)


def usable(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id`` and ``v`` (array of double) of the rows that take part."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    common_size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (common_size["n"] if common_size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=np.float64) for x in column.to_pylist()]) if len(column) else np.zeros((0, 1))


def placed(rows: DataFrame, router: Router) -> DataFrame:
    """Adds ``part``, the most probable one."""
    schema = T.StructType([*rows.schema.fields]).add("part", T.IntegerType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = router.scores(units(_matrix(batch.column("v")))).argmax(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], names=schema.names)

    return rows.mapInArrow(work, schema)


def routed(queries: DataFrame, router: Router, sizes: dict[int, int]) -> DataFrame:
    """A row per query and part to ask: the most probable ones, more while they hold too few rows."""
    schema = T.StructType([*queries.schema.fields]).add("part", T.IntegerType())
    held = np.array([sizes.get(p, 0) for p in range(router.parts)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-router.scores(units(_matrix(batch.column("v")))), axis=1, kind="stable")
            before = np.cumsum(held[order], axis=1) - held[order]
            ask = (np.arange(router.parts) < router.probes) | (before < LEAST_CANDIDATES)
            row, at = np.nonzero(ask & (held[order] > 0))
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(order[row, at], pa.int32())], names=schema.names)

    return queries.mapInArrow(work, schema)


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines with one query, summed in one order for every row: equal vectors get equal values."""
    dots = (vectors * query).sum(axis=1)
    return dots / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum()))


def search(vectors: DataFrame, every: int, k: int = 5, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The ``k`` nearest rows of each row whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    common.small_batches(spark)
    rows = usable(vectors, vector, key)
    drawn = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(SAMPLE).select("v").toLocalIterator()
    sample = np.array([r["v"] for r in drawn], dtype=np.float64)
    router = fit(sample, k) if len(sample) else Router([], 1, 1)
    index = common.stored(placed(rows, router), "ann-index")
    sizes = {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}
    queries = rows.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    asked = common.stored(routed(queries, router, sizes), "ann-queries")
    # Blocks of a part's rows, and of its queries: a task holds one of each.
    per_part = {r["part"]: r["count"] for r in asked.groupBy("part").count().collect()}

    def blocks(counts: dict[int, int]):
        number = F.lit(1)
        for part, n in counts.items():
            if n > BLOCK:
                number = F.when(F.col("part") == part, F.lit(-(-n // BLOCK))).otherwise(number)
        return number

    own, other = blocks(sizes), blocks(per_part)
    index = index.withColumn("block", F.pmod(F.xxhash64("vec_id", "v", F.monotonically_increasing_id()), own).cast("int"))
    index = index.withColumn("ask", F.explode(F.sequence(F.lit(0), other - 1)))
    asked = asked.withColumn("ask", F.pmod(F.xxhash64("query_id"), other).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), own - 1)))

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int | None, float]] = []
        if left.num_rows and right.num_rows:
            ids = right.column("vec_id").to_pandas(types_mapper=lambda _: pd.Int64Dtype())
            missing = ids.isna().to_numpy()
            ids = ids.fillna(0).to_numpy(dtype=np.int64)
            x = _matrix(right.column("v").combine_chunks())
            ux = units(x)
            query_ids = left.column("query_id").to_numpy()
            q = _matrix(left.column("v").combine_chunks())
            for at in range(0, len(q), 512):
                near = units(q[at : at + 512]) @ ux.T
                for row, query, query_id in zip(near, q[at : at + 512], query_ids[at : at + 512].tolist(), strict=True):
                    row[(ids == query_id) & ~missing] = -np.inf
                    edge = np.partition(row, len(row) - min(k, len(row)))[len(row) - min(k, len(row))]
                    some = np.flatnonzero((row >= edge - TIE) & (row > -np.inf))
                    exact = cosines(query, x[some])
                    for i in np.lexsort((ids[some], missing[some], -exact))[:k]:
                        out.append((query_id, None if missing[some[i]] else int(ids[some[i]]), float(exact[i])))
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_id", "vec_id", "score"])

    keys = ["part", "block", "ask"]
    found = asked.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(nearest, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
