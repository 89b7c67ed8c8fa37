from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import edge
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import mixing


def goals(sizes: dict) -> dict:
    """Targets by resharing the excess again and again, in fractions."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    whole, capped = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        left = whole - sum(2 * sizes[s] for s in capped)
        heavy = sum(weight[s] for s in names if s not in capped)
        target = {s: Fraction(2 * sizes[s]) if s in capped else Fraction(left * weight[s], heavy) for s in names}
        above = {s for s in names if target[s] > 2 * sizes[s]}
        if not above:
            return target
        capped |= above


def check(frame):
    docs = [tuple(r) for r in frame.select("doc_id", "text", "source").collect()]
    found = mixing.mix(frame, keep=("doc_id", "source")).collect()
    size = Counter()
    for _, text, source in docs:
        size[source] += len(re.findall("[^\x20\x09-\x0D]+", text or ""))
    wanted = Counter((i, s, len(re.findall("[^\x20\x09-\x0D]+", t or ""))) for i, t, s in docs)
    assert Counter((r.doc_id, r.source, r.size) for r in found) == wanted
    taken = defaultdict(int)
    for r in found:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        assert r.source_size == size[r.source]
        taken[r.source] += r.taken
    target = goals(size) if docs else {}
    for r in found:
        assert r.target == float(target[r.source])
    return target, taken, found


def test_documents_with_everything(spark):
    check(edge.documents(spark, clash=True))


def test_targets_are_met_to_the_word_where_lengths_allow(spark):
    pick = random.Random(2)
    rows = [(n, " ".join(["w"] * pick.randint(0, 60)), pick.choice(["a", "a", "a", "b", "c", "é", None, ""])) for n in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target, taken, first = check(frame)
    assert all(abs(taken[s] - target[s]) <= 2 for s in target)
    again = mixing.mix(frame.repartition(7), keep=("doc_id", "source")).collect()
    assert sorted(tuple(r) for r in again if r.source) == sorted(tuple(r) for r in first if r.source)


def test_one_length_and_one_source(spark):
    frame = spark.createDataFrame([(n, "a b c", "s") for n in range(999)], "doc_id long, text string, source string")
    target, taken, found = check(frame)
    assert abs(taken["s"] - target["s"]) <= 2
    assert {r.copies for r in found} == {1, 2}


def test_no_words_and_no_rows(spark):
    assert {r.taken for r in check(spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string"))[2]} == {0}
    assert check(edge.empty(spark))[2] == []


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 12), min_size=1, max_size=8), st.integers(0, 2000))
def test_fit_is_near(lengths, budget):
    sizes, counts = list(lengths), list(lengths.values())
    take = mixing.fit(sizes, counts, budget)
    assert all(0 <= t <= n for t, n in zip(take, counts, strict=True))
    words = sum(s * t for s, t in zip(sizes, take, strict=True))
    assert words == sum(s * n for s, n in lengths.items()) or abs(budget - words) < max(sizes)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=9, unique=True), st.integers(0, 200))
def test_single_documents_are_fitted_best(sizes, budget):
    """With one document of each length and a budget below half of all, nothing is taken before the program runs."""
    sums = {0}
    for s in sizes:
        sums |= {x + s for x in sums}
    words = sum(s * t for s, t in zip(sizes, mixing.fit(sizes, [1] * len(sizes), budget), strict=True))
    best = min(abs(x - budget) for x in sums)
    if budget <= max(sizes) or budget >= sum(sizes):
        assert abs(words - budget) == best if budget < sum(sizes) else words == sum(sizes)


def test_a_long_document_leaves_no_gap():
    sizes, counts = [*range(75, 125), 500_000], [2000] * 50 + [1]
    take = mixing.fit(sizes, counts, 5_200_000)
    assert all(0 <= t <= n for t, n in zip(take, counts, strict=True))
    assert sum(s * t for s, t in zip(sizes, take, strict=True)) == 5_200_000


def test_a_longer_document_competes():
    assert mixing.fit([200_000, 300_000], [1, 1], 190_000) == [1, 0]
    assert mixing.fit([200_000, 300_000], [1, 1], 90_000) == [0, 0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 400_000), min_size=1, max_size=8, unique=True), st.integers(0, 400_000))
def test_long_documents_are_fitted_best(sizes, budget):
    sums = {0}
    for s in sizes:
        sums |= {x + s for x in sums}
    if budget <= max(sizes):
        words = sum(s * t for s, t in zip(sizes, mixing.fit(sizes, [1] * len(sizes), budget), strict=True))
        assert abs(words - budget) == min(abs(x - budget) for x in sums)
