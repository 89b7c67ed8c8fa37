"""Token counts that follow edits: a segment tree over the pre-tokens of each document.

The tree's leaves are the pre-tokens that the vocabulary's pattern cuts, each with its characters and
its tokens; its nodes hold the sums of both, level by level, ``FANOUT`` children to a node. An edit
descends to the first pre-token it may change, cuts the new text from there until a cut falls on
an old one behind the edit, encodes only the pre-tokens in between and renews the sums above them.

A pre-token depends on the text up to ``CONTEXT`` characters behind its end (the space that a run
leaves to the next word, the letters of a contraction), so those that end at least that far before the edit stay.

Null texts are empty. Edits (start, end, text) apply in order, each to the text the one before left;
null and out-of-range bounds are moved to the nearest place in the text, an end before its start counts
as the start, null replacement text is empty, null edits and null lists change nothing.
Repeated rows and further columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import bpe, common

CONTEXT = 2
FANOUT = 32


class TokenTree:
    """Characters and tokens of a document's pre-tokens, and their sums by level."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars.astype(np.int64), tokens.astype(np.int64)
        self.levels: list[np.ndarray] = []  # from the leaves' parents up, rows of (characters, tokens)
        self._raise(0)

    def _parents(self, below: np.ndarray, first: int) -> np.ndarray:
        return np.add.reduceat(below, np.arange(first * FANOUT, len(below), FANOUT), axis=0)

    def _raise(self, leaf: int) -> None:
        """Renew the sums above the leaves from ``leaf`` on; those to the left of it stay."""
        below, kept, level = np.stack([self.chars, self.tokens], axis=1), leaf, 0
        while len(below) > 1 or level == 0:
            kept //= FANOUT
            old = self.levels[level][:kept] if level < len(self.levels) else np.zeros((0, 2), np.int64)
            new = self._parents(below, len(old)) if len(below) > len(old) * FANOUT else np.zeros((0, 2), np.int64)
            below = np.concatenate([old, new])
            self.levels[level : level + 1] = [below]
            kept, level = len(old), level + 1
        del self.levels[level:]

    @property
    def n_tokens(self) -> int:
        return int(self.levels[-1][:, 1].sum()) if len(self.levels[-1]) else 0

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The first pre-token that ends behind ``place``, and where it starts; the number of leaves if none does."""
        node, start = 0, 0
        for level in [*reversed(self.levels[:-1]), self.chars]:
            sums = level if level is self.chars else level[:, 0]
            end = min(node + FANOUT, len(sums))
            while node < end and start + sums[node] <= place:
                start += int(sums[node])
                node += 1
            if node == end:
                return len(self.chars), start
            if level is not self.chars:
                node *= FANOUT
        return node, start

    def replace(self, first: int, last: int, chars: Sequence[int], tokens: Sequence[int]) -> None:
        """Put new leaves in place of those from ``first`` up to ``last``."""
        new_chars, new_tokens = np.array(chars, np.int64), np.array(tokens, np.int64)
        if len(new_chars) == last - first:
            # The shape stays: only the nodes above the changed leaves change, by the differences.
            by = np.stack([new_chars - self.chars[first:last], new_tokens - self.tokens[first:last]], axis=1)
            self.chars[first:last], self.tokens[first:last] = new_chars, new_tokens
            at = np.arange(first, last)
            for level in self.levels:
                at = at // FANOUT
                np.add.at(level, at, by)
            return
        self.chars = np.concatenate([self.chars[:first], new_chars, self.chars[last:]])
        self.tokens = np.concatenate([self.tokens[:first], new_tokens, self.tokens[last:]])
        self._raise(first)


def edit(tree: TokenTree, text: str, start: int, end: int, by: str, codec: bpe.Codec) -> tuple[str, int]:
    """Replace text[start:end], follow it in the tree; the new text and how many pre-tokens were encoded."""
    changed = text[:start] + by + text[end:]
    shift = len(by) - (end - start)
    # Pre-tokens that end CONTEXT or more before the edit stay.
    first, at = tree.leaf_at(max(0, start - CONTEXT)) if start >= CONTEXT else (0, 0)
    last, old = first, at  # the old pre-token, and its place, that has not been passed yet
    pieces: list[str] = []
    engine = codec.pattern if codec.beyond.search(changed) else codec.latin
    for match in engine.finditer(changed, at):
        here = match.start() - shift
        while last < len(tree.chars) and old < here:
            old += int(tree.chars[last])
            last += 1
        if here >= end and old == here:
            break
        pieces.append(match.group())
    else:
        last = len(tree.chars)
    ids = codec._known(set(pieces))
    tree.replace(first, last, [len(p) for p in pieces], [len(ids[p]) // 4 for p in pieces])
    return changed, len(pieces)


def build(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, ``text``, the leaves (``pre_chars``, ``pre_tokens``: arrays of int) and ``n_tokens``."""
    common.small_batches(docs.sparkSession)
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("text"))
    leaves = T.ArrayType(T.IntegerType())
    schema = T.StructType([*source.schema.fields]).add("pre_chars", leaves).add("pre_tokens", leaves).add("n_tokens", T.LongType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe.codec(path, pattern)
        for batch in batches:
            texts, at = batch.column("text").to_pylist(), 0
            while at < len(texts):
                size, to = 0, at
                while to < len(texts) and size < bpe.GROUP:
                    size += len(texts[to] or "")
                    to += 1
                cut = [own.cut(t or "") for t in texts[at:to]]
                known = {p: len(ids) // 4 for p, ids in own._known(set().union(*cut)).items()}
                ends = pa.array([0, *accumulate(map(len, cut))], pa.int32())
                total = ends[-1].as_py()
                chars = np.fromiter(map(len, chain.from_iterable(cut)), np.int32, total)
                tokens = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int32, total)
                sums = np.concatenate([[0], np.cumsum(tokens, dtype=np.int64)])[ends.to_numpy()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(at, to - at) for c in batch.columns],
                        pa.ListArray.from_arrays(ends, pa.array(chars)),
                        pa.ListArray.from_arrays(ends, pa.array(tokens)),
                        pa.array(np.diff(sums), pa.int64()),
                    ],
                    names=schema.names,
                )
                at = to

    made = source.mapInArrow(work, schema)
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "text", "pre_chars", "pre_tokens", "n_tokens")


EDITS = "array<struct<start:long,end:long,text:string>>"


def apply_edits(
    trees: DataFrame, path: str, pattern: str, edits: str = "edits", keep: Sequence[str] = ("doc_id",), leaves: bool = True
) -> DataFrame:
    """``keep``, ``text``, the leaves, ``n_tokens`` after the edits and ``n_encoded``, the pre-tokens encoded anew.

    Without ``leaves`` text and leaves are left out of the result.
    """
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    source = trees.select(*kept, "text", "pre_chars", "pre_tokens", F.col(edits).cast(EDITS).alias("edits"))
    schema = T.StructType(source.schema.fields[: len(keep)])
    if leaves:
        own = T.ArrayType(T.IntegerType())
        schema = schema.add("text", T.StringType()).add("pre_chars", own).add("pre_tokens", own)
    schema = schema.add("n_tokens", T.LongType()).add("n_encoded", T.LongType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe.codec(path, pattern)
        for batch in batches:
            texts, chars, tokens, totals, encoded = [], [], [], [], []
            lists = batch.column("pre_chars"), batch.column("pre_tokens")
            for n, (text, edits_of) in enumerate(zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist(), strict=True)):
                text = text or ""
                tree = TokenTree(*[x[n].values.to_numpy() for x in lists])
                count = 0
                for one in edits_of or ():
                    if one is not None:
                        start = min(max(one["start"] or 0, 0), len(text))
                        end = min(max(one["end"] or 0, start), len(text))
                        text, some = edit(tree, text, start, end, one["text"] or "", own)
                        count += some
                totals.append(tree.n_tokens)
                encoded.append(count)
                if leaves:
                    texts.append(text)
                    chars.append(tree.chars.astype(np.int32))
                    tokens.append(tree.tokens.astype(np.int32))
            made = [pa.array(totals, pa.int64()), pa.array(encoded, pa.int64())]
            if leaves:
                kind = pa.list_(pa.int32())
                made = [pa.array(texts, pa.string()), pa.array(chars, kind), pa.array(tokens, kind), *made]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=schema.names)

    made = source.mapInArrow(work, schema)
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *schema.names[len(keep) :])
