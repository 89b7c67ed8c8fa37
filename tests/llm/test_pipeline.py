from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
import edge
import public_tokenizers
import pytest
import test_dedup
import test_mixing
import test_native
import tiktoken

from millrace.llm import bpe, common, secrets
from millrace.llm.queries import RANKS


def test_stages_are_the_operators_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "secret_scans", "source_mix", "bpe_encoding"]


def test_every_stage_against_brute_force(spark, sf_dir):
    """Each stage on what the one before kept, by a plain model of its decision."""
    docs = common.table(spark, sf_dir, "documents")
    results = []
    for name, stage in corpus_pipeline.STAGES:
        results.append(common.stored(stage(spark, docs, sf_dir), name))
        docs = results[-1]
    told, unique, masked, mixed, encoded = results
    source = common.table(spark, sf_dir, "documents")

    # Documents in a language of the labels stay; nothing but texts without letters may go here.
    letters = [r for r in source.collect() if any(map(str.isalpha, r.text or ""))]
    assert told.columns == source.columns
    assert told.count() >= 0.99 * len(letters)

    rows = [(r.doc_id, r.text) for r in told.collect()]
    assert sorted(r.doc_id for r in unique.collect()) == [r[0] for r in sorted(test_dedup.brute(rows, 5)) if r[3]]

    before = {r.doc_id: r.text for r in unique.collect()}
    for row in masked.collect():
        text = before[row.doc_id]
        assert not test_native.base_spans(row.text) or secrets.MASK in row.text
        assert (row.text == text) == (not test_native.all_spans(text))

    assert mixed.columns == source.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    assert max(copies.values()) <= 2
    size, taken = Counter(), Counter()
    for row in masked.collect():
        n = len(re.findall("[^\x20\x09-\x0D]+", row.text or ""))
        size[row.source] += n
        taken[row.source] += n * copies[row.doc_id]
    target = test_mixing.goals(size)
    # Sources hold about ten documents each here, so that few sums can be had.
    assert sum(abs(taken[s] - target[s]) for s in target) <= 0.02 * sum(target.values())

    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={}).encode_ordinary
    wanted = Counter((r.doc_id, tuple(encode(r.text))) for r in mixed.collect())
    assert Counter((r.doc_id, tuple(r.token_ids)) for r in encoded.collect()) == wanted


@pytest.mark.parametrize("clash", [False, True])
def test_stages_on_odd_documents(spark, clash):
    docs = edge.documents(spark, clash)
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, docs, ""), name)
        if name != "bpe_encoding":
            assert out.columns == docs.columns
        docs = out
    assert docs.count() > 0


def test_stages_on_no_documents(spark):
    docs = edge.empty(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, ""), name)
        assert docs.count() == 0


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.count() > 0 and "token_ids" in rows.columns
