from __future__ import annotations

import random

import edge
import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import dedup, forest


def families(groups: dict[int, int], size: int = 200, changes: int = 12, seed: int = 3) -> list[tuple[int, bytes, int]]:
    """Signatures of near copies: ``groups`` counts families by their number of members."""
    pick = np.random.default_rng(seed)
    out = []
    for members, count in groups.items():
        for _ in range(count):
            base = pick.integers(0, 2**63, size, dtype=np.uint64)
            for _ in range(members):
                own = base.copy()
                own[pick.integers(0, size, pick.integers(0, changes + 1))] = pick.integers(0, 2**63, dtype=np.uint64)
                own = np.unique(own)
                out.append((len(out), dedup.signature(own).tobytes(), len(own)))
    return out


def wanted(rows: list[tuple]) -> list[tuple]:
    """Components of the pairs that share the first minima of some order and are near by sketch and size, pair by pair."""
    sig = np.stack([np.frombuffer(s, np.uint16) for _, s, _ in rows])
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shares = (sig[i] == sig[j]).reshape(forest.TREES, forest.DEPTH).all(axis=1).any()
            bits = ((sig[i] ^ sig[j]) & 1).sum()
            low, high = sorted((rows[i][2], rows[j][2]))
            if shares and bits <= forest.MOST_DIFFERENT and 5 * low >= 4 * high:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(i, find(i)) for i in range(len(rows)) if sum(find(k) == find(i) for k in range(len(rows))) > 1]


def found(spark, rows, **bounds):
    return edge.rows(forest.clusters(spark.createDataFrame(rows, "rep long, sig binary, size long"), "size", forest.Bounds(**bounds)))


@pytest.mark.parametrize("region, held", [(256, 4096), (8, 4096), (4, 6)])
def test_all_pairs_of_a_region_are_tied(spark, region, held):
    """Whether regions are taken whole, cut deeper, or beyond what a task holds."""
    rows = families({1: 20, 2: 10, 5: 4, 40: 2, 90: 1}, changes=30)
    assert found(spark, rows, region=region, small=min(region, 8) // 2, held=held, block=16) == sorted(wanted(rows), key=repr)


def test_depth_follows_the_crowd():
    first = np.array([1, 2, 2, 3, 3, 3, 3, 3], dtype=np.int64)
    following = np.array([0, 0, 9 << 48, 0, 0, 1 << 48, 1 << 48, (1 << 48) + 1], dtype=np.int64)
    group, starts, sizes = forest.regions({"tree": np.zeros(8, np.int32), "first": first, "next": following}, 3)
    assert group.tolist() == [0, 1, 1, 2, 2, 3, 3, 3]
    assert starts.tolist() == [0, 1, 3, 5] and sizes.tolist() == [1, 2, 2, 3]


def test_a_pair_parted_by_depth_meets_all_the_same(spark):
    """Two families that agree in few minima of one order, in a run too crowded to be taken whole."""
    pick = np.random.default_rng(1)
    base = pick.integers(0, 2**16, forest.HASHES, dtype=np.uint16)
    rows = []
    for n in range(24):
        own = base.copy()
        # Every order but the first differs in one of its first minima; the first one differs right after them.
        own[np.arange(forest.DEPTH + n % 4, forest.HASHES, forest.DEPTH)] = pick.integers(0, 2**15, forest.TREES - 1, dtype=np.uint16) * 2 + base[forest.DEPTH + n % 4 :: forest.DEPTH] % 2
        rows.append((n, own.tobytes(), 100))
    assert found(spark, rows, region=4, block=5) == sorted(wanted(rows), key=repr) == sorted([(n, 0) for n in range(24)], key=repr)


def test_batches_of_any_length_give_the_same():
    rows = families({1: 5, 3: 6, 30: 2})
    pick = random.Random(2)
    sig = np.stack([np.frombuffer(s, "<u2") for _, s, _ in rows])
    first = sig.astype(">u2").view(">u8").astype(np.uint64).view(np.int64)[:, 0]
    sketch = np.packbits((sig & 1).astype(np.uint8), axis=1).view(np.int64)
    order = np.lexsort((np.arange(len(rows)), first))
    columns = {
        "tree": np.zeros(len(rows), np.int32), "first": first, "next": np.zeros(len(rows), np.int64), "rep": np.arange(len(rows)),
        "low": np.ascontiguousarray(sketch[:, 0]), "high": np.ascontiguousarray(sketch[:, 1]), "size": np.array([n for _, _, n in rows]),
    }
    whole = pa.RecordBatch.from_pydict({name: column[order] for name, column in columns.items()})
    cuts = sorted(pick.sample(range(1, len(rows)), 12))
    parts = [whole.slice(a, b - a) for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]

    def result(batches):
        table = pa.Table.from_batches(list(forest.walk(iter(batches)))).to_pylist()
        return sorted(map(repr, table))

    assert result(parts) == result([whole])
    assert list(forest.walk(iter([]))) == []


def test_no_classes(spark):
    assert forest.clusters(edge.empty(spark, "rep long, sig binary, size long"), "size").count() == 0
