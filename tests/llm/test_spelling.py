"""Spelling variants against a plain count and all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import edge
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import spelling
from millrace.llm.common import table
from millrace.llm.queries import QUERIES

LOWER = {i: i + 32 for i in range(65, 91)}
COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def counted(docs) -> dict[str, int]:
    found: Counter = Counter()
    for doc_id, text in docs.select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(words: dict[str, int], near: dict[str, set[str]]) -> dict[str, tuple]:
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda x: (-words[x], x), default=None)
        if top is not None and words[top] >= 5 * words[w]:
            form[w] = top

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (w, n, len(near[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items()}


def all_pairs(words) -> dict[str, set[str]]:
    return {a: {b for b in words if one_edit(a, b)} for a in words}


def found(frame) -> dict[str, tuple]:
    got = [tuple(r) for r in frame.select(*COLUMNS).collect()]
    assert len(got) == len({r[0] for r in got})
    return {r[0]: r for r in got}


def random_words(rng: random.Random, n: int) -> list[str]:
    """Words in families of near ones, some with a common first or last half, some much longer than others."""
    words = {"banana", "bananas", "cabana", "àéîõüÿ", "àéîõü÷", "x" * 3000, "x" * 3001, "x" * 2999 + "y", "abcdef", "bcdefa"}
    while len(words) < n:
        w = "".join(rng.choice("abé") for _ in range(rng.randint(6, 9)))
        w = rng.choice(["prefix", "", ""]) + w + rng.choice(["suffix", "", ""])
        words.add(w)
        at = rng.randrange(len(w))
        words.add(w[:at] + rng.choice("abé") + w[at + 1 :])
        words.add(w[:at] + rng.choice("abé") + w[at:])
    return sorted(words)


@pytest.mark.parametrize("deal", [8, 4096])
def test_near_words_equal_all_pairs(spark, deal):
    rng = random.Random(3)
    words = {w: rng.choice([5, 5, 6, 30, 30, 900]) for w in random_words(rng, 250)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    near = all_pairs(words)
    got = {r["word"]: r for r in spelling.near_words(frame, deal).collect()}
    assert {w: r["n_near"] for w, r in got.items()} == {w: len(x) for w, x in near.items()}
    top = {w: min(x, key=lambda y: (-words[y], y), default=None) for w, x in near.items()}
    assert {w: r["best"] and tuple(r["best"]) for w, r in got.items()} == {w: t and (t, words[t]) for w, t in top.items()}


def test_large_halves_are_cut_into_blocks(spark):
    words = [("shared" + a + b + c, 5) for a in "abcde" for b in "abcde" for c in "abcde"]
    dealt = spelling.deals(spark.createDataFrame(words, "word string, n long"), 16)
    sizes = [r["count"] for r in dealt.where("asks").groupBy("deal").count().collect()]
    assert max(sizes) <= 32 and sum(sizes) > len(words)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=2, max_size=6), min_size=1, max_size=40, unique=True))
def test_bitsets_equal_all_pairs(words):
    for length in {len(w) for w in words}:
        asked = [w for w in words if len(w) == length]
        for longer, matcher in ((0, spelling.replaced), (1, spelling.lengthened)):
            indexed = [w for w in words if len(w) == length + longer]
            if indexed:
                index = spelling.PositionIndex(spelling._codes(indexed, length + longer))
                a, b = spelling._hits(matcher(index, spelling._codes(asked, length)))
                assert sorted((asked[x], indexed[y]) for x, y in zip(a, b)) == sorted((x, y) for x in asked for y in indexed if one_edit(x, y))


def test_chains_lead_to_the_last_form(spark):
    steps = [(f"w{i}", f"w{i + 1}") for i in range(13)] + [("a", "w0"), ("b", "a")]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(steps, "word string, form string")).collect()}
    assert got == {w: "w13" for w, _ in steps}


def documents(spark, clash=False):
    rng = random.Random(5)
    docs = edge.documents(spark, clash)
    words = random_words(rng, 40) + ["Banana", "BANANA", "ÀÉÎÕÜ"]
    texts = [" ".join(rng.choices(words, k=60)) + "-it's" for _ in range(30)] + ["banana " * 500]
    more = [(100 + i, t, "en", "a", 0) for i, t in enumerate(texts)] + [(None, texts[0], None, None, None), (100, texts[0], "en", "a", 0)]
    more = spark.createDataFrame(more, edge.DOCUMENTS)
    return docs.unionByName(more, allowMissingColumns=True)


def test_variants_of_small_documents(spark):
    docs = documents(spark)
    words = counted(docs)
    got = found(spelling.variants(docs))
    assert got == expected(words, all_pairs(words)) and any(r[3] for r in got.values())


def test_clashing_columns_change_nothing(spark):
    docs = documents(spark, clash=True)
    for name in ("word", "n", "d", "r", "short", "kind", "half", "form"):
        docs = docs.drop(name).withColumn(name, docs["lang"])
    assert found(spelling.variants(docs)) == found(spelling.variants(documents(spark)))


def test_no_documents(spark):
    assert found(spelling.variants(edge.empty(spark))) == {}
    assert found(spelling.variants(spark.createDataFrame([(1, None, None, None, None)], edge.DOCUMENTS))) == {}


def test_query_equals_all_pairs(spark, sf_dir):
    words = counted(table(spark, sf_dir, "documents"))
    by_cut: dict[tuple, set[str]] = {}
    for w in words:
        for i in range(len(w)):
            by_cut.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    near: dict[str, set[str]] = {w: set() for w in words}
    for (head, tail), group in by_cut.items():
        for a in group:
            near[a] |= {b for b in group if len(b) == len(a)} - {a}
        if head + tail in words:
            near[head + tail] |= group
            for a in group:
                near[a].add(head + tail)
    assert found(QUERIES["op11_spelling"](spark, sf_dir)) == expected(words, near)
