from __future__ import annotations

import random

import pytest

from millrace.llm import common
from millrace.llm.graph import components


def roots(spark, edges):
    return {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}


def wanted(edges):
    root = {}
    for a, b in edges:
        if a is not None and b is not None:
            root.setdefault(a, a), root.setdefault(b, b)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in edges:
        if a is not None and b is not None:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: find(i) for i in root}


def shapes():
    pick = random.Random(5)
    yield "chain", [(i, i + 1) for i in range(300)]
    yield "star", [(7, i) for i in range(-400, 400)]
    yield "two stars that meet", [(1000, i) for i in range(200)] + [(2000, i) for i in range(199, 400)]
    yield "clique", [(i, j) for i in range(30) for j in range(i)]
    yield "sparse", [(pick.randrange(2000), pick.randrange(2000)) for _ in range(1100)]
    yield "odd", [(1, 1), (2, None), (None, None), (3, 4), (4, 3), (3, 4), (2**63 - 1, -(2**63)), (5, -(2**63))]
    yield "none", []


@pytest.mark.parametrize("edges", [pytest.param(e, id=n) for n, e in shapes()])
def test_components_of_shapes(spark, edges):
    assert roots(spark, edges) == wanted(edges)


def test_edges_that_are_settled_are_not_met_again(spark, monkeypatch):
    """Rows of all rounds together stay near those of the first, also on a long chain with ordered numbers."""
    kept, real = [], common.stored

    def stored(frame, label):
        out = real(frame, label)
        if label == "links":
            kept.append(out.count())
        return out

    monkeypatch.setattr(common, "stored", stored)
    edges = [(i, i + 1) for i in range(2000)] + [(-1, -i) for i in range(2, 2000)]
    assert roots(spark, edges) == wanted(edges)
    assert kept[0] == len(edges) and kept[-1] == 0
    assert sum(kept) < 2.5 * len(edges)
    assert len(kept) < 20
