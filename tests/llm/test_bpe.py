from __future__ import annotations

import random
import sys

import edge
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import bpe, token_counts
from millrace.llm.queries import RANKS, edits_of

PATH, PATTERN = public_tokenizers.path(RANKS), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(PATH), PATTERN)


@pytest.fixture(scope="module")
def expected():
    ranks = bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def texts():
    pick = random.Random(3)
    made = ["", "a", "  \n\t x", "ab" * 700, "a" * 2049, "é中\U0001f600" * 300, "aaab" * 500]
    for letters, longest in (("etaoinshrdlu", 3000), ("ab", 2000), ("abc \n'stre.0é中", 900)):
        made += ["".join(pick.choices(letters, k=pick.randint(1, longest))) for _ in range(25)]
    return made


def test_same_ids_as_the_library(codec, expected):
    for text, ids in zip(texts(), codec.encode_texts(texts()), strict=True):
        assert ids.tolist() == expected(text)
        assert codec.decode(ids.tolist()) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    own = bpe.codec(PATH, PATTERN)
    ids = next(iter(own.encode_texts([text])))
    assert own.decode(ids.tolist()) == text.encode()


def test_latin_pattern_cuts_as_the_full_one(codec):
    full = regex.compile(PATTERN)
    for point in range(bpe.LATIN_END):
        text = f"a{chr(point)}b1{chr(point)} {chr(point)}{chr(point)} !{chr(point)}  z"
        assert codec.latin.findall(text) == full.findall(text)


def test_remembered_pieces_stay_bounded(expected):
    own = bpe.Codec(bpe.read_ranks(PATH), PATTERN)
    before, bpe.REMEMBERED = bpe.REMEMBERED, 50
    try:
        for text in texts():
            assert next(iter(own.encode_texts([text]))).tolist() == expected(text)
            assert len(own.young) <= 50 and len(own.old) <= 50
    finally:
        bpe.REMEMBERED = before


def test_documents_with_everything(spark, expected, codec):
    docs = edge.documents(spark, clash=True)
    made = bpe.encode(docs, PATH, PATTERN, keep=("doc_id", "text"), decode=True)
    rows = made.collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row.token_ids == expected(row.text or "")
        assert row.n_tokens == len(row.token_ids)
        assert bytes(row.decoded) == (row.text or "").encode()
    again = bpe.decode_ids(made, PATH, PATTERN)
    assert edge.rows(again) == edge.rows(made.select("doc_id", "decoded"))


def test_no_documents(spark):
    assert bpe.encode(edge.empty(spark), PATH, PATTERN).count() == 0
    assert token_counts.build(edge.empty(spark), PATH, PATTERN).count() == 0


# --- counts that follow edits ---


@settings(max_examples=60, deadline=None)
@given(
    st.text(alphabet="ab 're\n.1é", max_size=400),
    st.lists(st.tuples(st.integers(0, 420), st.integers(0, 30), st.text(alphabet="ab 'r\n.1", max_size=40)), max_size=6),
)
def test_tree_follows_edits(text, edits):
    own = bpe.codec(PATH, PATTERN)
    cut = own.cut(text)
    tree = token_counts.TokenTree(*leaves(own, cut))
    for start, size, by in edits:
        start = min(start, len(text))
        end = min(start + size, len(text))
        text, _ = token_counts.edit(tree, text, start, end, by, own)
        chars, tokens = leaves(own, own.cut(text))
        assert tree.chars.tolist() == chars.tolist()
        assert tree.tokens.tolist() == tokens.tolist()
        fresh = token_counts.TokenTree(chars, tokens)
        assert [x.tolist() for x in tree.levels] == [x.tolist() for x in fresh.levels]


def leaves(own, pieces):
    import numpy as np

    ids = own._known(set(pieces))
    return np.array([len(p) for p in pieces], np.int64), np.array([len(ids[p]) // 4 for p in pieces], np.int64)


def test_an_edit_costs_its_surroundings(codec):
    text = edge.passage(5000)
    tree = token_counts.TokenTree(*leaves(codec, codec.cut(text)))
    _, encoded = token_counts.edit(tree, text, 9000, 9010, " new words here", codec)
    assert encoded < 20


def test_edits_of_documents(spark, expected):
    from pyspark.sql import functions as F

    docs = edge.documents(spark).withColumn("edits", edits_of(F.col("doc_id"), F.col("text"), F.col("source")))
    docs = docs.withColumn("edits", F.when(F.col("doc_id") != 4, F.col("edits")))
    trees = token_counts.build(docs, PATH, PATTERN, keep=("doc_id", "edits"))
    after = token_counts.apply_edits(trees, PATH, PATTERN).collect()
    wanted = []
    for row in docs.collect():
        text = row.text or ""
        for one in row.edits or ():
            start, end = min(one.start, len(text)), min(one.end, len(text))
            text = text[:start] + one.text + text[max(start, end) :]
        wanted.append((row.doc_id, text, len(expected(text))))
    assert sorted(((r.doc_id, r.text, r.n_tokens) for r in after), key=repr) == sorted(wanted, key=repr)


def test_odd_edits(spark, expected):
    odd = [(None, 3, "a"), (50, 2, None), (-5, 10**6, "b c"), (0, 0, "")]
    schema = f"doc_id long, text string, edits {token_counts.EDITS}"
    docs = spark.createDataFrame([(1, "hello big world", odd), (2, None, [None]), (3, "x", None)], schema)
    trees = token_counts.build(docs, PATH, PATTERN, keep=("doc_id", "edits"))
    texts_after = {r.doc_id: (r.text, r.n_tokens) for r in token_counts.apply_edits(trees, PATH, PATTERN).collect()}
    assert texts_after == {1: ("b c", len(expected("b c"))), 2: ("", 0), 3: ("x", 1)}


def test_byte_order_of_kept_ids():
    assert sys.byteorder in ("little", "big")
    assert int.from_bytes((70000).to_bytes(4, sys.byteorder), sys.byteorder) == 70000


def test_counts_of_documents_with_clashing_columns(spark):
    names = "pre_chars pre_tokens n_tokens n_chars sums levels at found text_before t0 k1".split()
    found = []
    for clash in (False, True):
        docs = edge.documents(spark, clash)
        for name in names if clash else ():
            docs = docs.withColumn(name, docs.source)
        docs = docs.withColumn("edits", edits_of(docs.doc_id, docs.text, docs.source))
        trees = token_counts.build(docs, PATH, PATTERN, keep=("doc_id", "edits"))
        after = token_counts.apply_edits(trees, PATH, PATTERN, leaves=False).drop("edits")
        found.append(edge.rows(after))
    assert found[0] == found[1] and len(found[0]) == docs.count()
