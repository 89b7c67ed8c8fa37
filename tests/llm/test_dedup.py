from __future__ import annotations

import random
import re
from collections import defaultdict

import edge
import numpy as np
import pytest

from millrace.llm import dedup
from millrace.llm.graph import components


def sets_of(docs: list[tuple], width: int) -> list[frozenset]:
    out = []
    for row in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (row[1] or "").encode().lower())
        n = min(width, len(words))
        out.append(frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset())
    return out


def brute(docs: list[tuple], width: int) -> list[tuple]:
    sets = sets_of(docs, width)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, row in enumerate(docs):
        least[find(i)].append(row[0])
    out = []
    for i, row in enumerate(docs):
        ids = [x for x in least[find(i)] if x is not None]
        component = min(ids) if ids else None
        out.append((row[0], len(sets[i]), component, row[0] == component))
    return sorted(out, key=repr)


def result(frame, width):
    found = dedup.near_duplicates(frame, width=width).drop("text_hash")
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return edge.rows(found)


@pytest.mark.parametrize("width", [4, 5])
def test_documents_with_everything(spark, width):
    docs = edge.documents(spark, clash=True)
    assert result(docs, width) == brute([tuple(r) for r in edge.documents(spark).collect()], width)


def test_copies_of_copies(spark, monkeypatch):
    """A large group of near copies around the threshold, dealt out in several blocks, with chains between them."""
    monkeypatch.setattr(dedup, "BLOCK", 32)
    pick = random.Random(5)
    vocabulary = [f"w{n}" for n in range(3000)]
    docs, n = [], 0
    for size, group in ((120, 150), (60, 30), (400, 8)):
        base = pick.choices(vocabulary, k=size)
        for _ in range(group):
            words = list(base if pick.random() < 0.5 or not docs else docs[-1][1].split())
            for _ in range(pick.randint(0, max(1, size // 16))):
                words[pick.randrange(len(words))] = pick.choice(vocabulary)
            docs.append((n * 7 % 100_003, " ".join(words)))
            n += 1
    docs += [(1_000_000 + i, docs[i][1]) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = result(frame, 4)
    assert found == brute(docs, 4)
    assert len({r[2] for r in found}) > 5


def test_signature_agreement_follows_similarity():
    pick = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        size = 1000
        common = pick.integers(0, 2**63, round(size * share), dtype=np.uint64)
        rest = [pick.integers(0, 2**63, (size - len(common)) // 2, dtype=np.uint64) for _ in range(2)]
        a, b = (np.concatenate([common, own]) for own in rest)
        same = (dedup.signature(a) == dedup.signature(b)).mean()
        assert abs(same - share) < 0.16


def test_one_id_with_several_texts(spark):
    first, second = edge.passage(60), edge.passage(60, 3)
    docs = [(1, first), (1, second), (2, first + " end"), (3, second + " end"), (4, edge.passage(60, 8))]
    found = result(spark.createDataFrame(docs, "doc_id long, text string"), 4)
    assert [(r[0], r[2], r[3]) for r in found] == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)]


def test_one_of_each_group_stays(spark):
    docs = edge.documents(spark)
    stay = dedup.deduplicated(docs)
    assert stay.columns == docs.columns
    kept = [r for r in dedup.near_duplicates(docs).collect() if r.kept]
    assert sorted((r.doc_id for r in stay.collect()), key=repr) == sorted({r.doc_id for r in kept}, key=repr)


def test_more_members_than_a_task_may_hold(spark):
    """The way taken beyond the bound finds the same links."""
    docs = spark.createDataFrame([(i, edge.passage(60, i // 3) + " x" * (i % 3)) for i in range(30)], "doc_id long, text string")
    sets = dedup.measured(docs, "text", 4).where("set_id is not null")
    classes = sets.selectExpr("doc_id as rep", "set_id", "sig", "text_hash as set_hash")
    members = dedup.clusters(classes).join(classes.withColumnRenamed("rep", "node"), "node").select("node", "root", "sig", "set_hash")
    found = [edge.rows(dedup.confirmed(docs, members, "text", 4, n)) for n in (0, 1000)]
    assert found[0] == found[1] and found[0]


def test_no_documents(spark):
    assert dedup.near_duplicates(edge.empty(spark)).count() == 0
    assert dedup.deduplicated(edge.empty(spark)).count() == 0


def test_components(spark):
    edges = [(n, n + 1) for n in range(1, 40)] + [(100, 200), (300, 200), (7, 7), (None, 3), (500, None)] + [(1000, 1000 + n) for n in range(60)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: 1 for n in range(1, 41)} | {100: 100, 200: 100, 300: 100} | {n: 1000 for n in range(1000, 1060)}
