"""Byte-level BPE with numpy matrices: all rows of a matrix merge one pair per round.

Texts are cut by the pattern of the vocabulary. The distinct pieces of a batch are put into padded
matrices by length; in each round every row merges its leftmost pair of least rank, found by
argmin over a matrix of pair ranks, and is closed up. A pair's rank comes from a hash table held
in two numpy arrays. Pieces of more than ``LONG`` bytes merge, in a round, every occurrence of the
least pair up to the first that gives rise to a lesser one, which is the same order of merges.

Nulls count as empty texts: no ids, empty bytes. Columns are taken by name and results have fixed
names, so further columns of the input, whatever they are called, do not matter. Repeated rows
give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import common

NONE = np.int32(2**31 - 1)
LONG = 512
CELLS = 1 << 19  # of one matrix
GROUP = 1 << 20  # characters whose pieces are encoded together
REMEMBERED = 250_000  # pieces per generation of a worker's memory
LATIN_END = 0x250  # texts below this code point are cut by the faster of two pattern engines
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open-addressing hash table from (left id, right id) to the id of their concatenation."""

    def __init__(self, lefts: np.ndarray, rights: np.ndarray, merged: np.ndarray):
        keys = self._keys(lefts, rights)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << bits, NONE)
        left = np.arange(len(keys))
        places = self._places(keys)
        while len(left):
            free = self.keys[places[left]] == np.uint64(2**64 - 1)
            asking = left[free]
            _, first = np.unique(places[asking], return_index=True)
            put = asking[first]
            self.keys[places[put]], self.values[places[put]] = keys[put], merged[put]
            left = left[self.keys[places[left]] != keys[left]]
            places[left] = (places[left] + 1) & self.mask

    @staticmethod
    def _keys(lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
        return (lefts.astype(np.uint64) << np.uint64(32)) | rights.astype(np.uint64)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> self.shift).astype(np.int64)

    def ranks(self, lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it cannot merge; ids below 0 are padding."""
        found = np.full(lefts.shape, NONE)
        real = np.flatnonzero((lefts >= 0) & (rights >= 0))
        keys = self._keys(lefts.reshape(-1)[real], rights.reshape(-1)[real])
        places, flat = self._places(keys), found.reshape(-1)
        while len(real):
            there = self.keys[places]
            hit = there == keys
            flat[real[hit]] = self.values[places[hit]]
            go_on = ~hit & (there != np.uint64(2**64 - 1))
            real, keys, places = real[go_on], keys[go_on], (places[go_on] + 1) & self.mask
        return found


def latin_pattern(pattern: str) -> re.Pattern:
    """The pattern with its Unicode classes written out up to LATIN_END, for the standard ``re``."""
    written: dict[str, str] = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        members = [c for c in range(LATIN_END) if regex.match(name, chr(c))]
        starts = [c for c in members if c - 1 not in members]
        ends = [c for c in members if c + 1 not in members]
        written[name] = "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends, strict=True))
    out, inside = [], False
    for part in regex.findall(r"\\p\{\w\}|\\.|.", pattern):
        if part in written:
            part = written[part] if inside else f"[{written[part]}]"
        elif part == r"\S" and not inside:
            part = f"[^{written[chr(92) + 's']}]"
        elif part in "[]":
            inside = part == "["
        out.append(part)
    return re.compile("".join(out))


class Codec:
    """Encoder and decoder for the ranks of a vocabulary file and the pattern that cuts texts.

    The ids of a piece are kept as the bytes of an int32 array, so that a text's ids are one join.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.direct, self.pattern, self.latin = ranks, regex.compile(pattern), latin_pattern(pattern)
        self.beyond = re.compile(f"[^\\x00-\\u{LATIN_END - 1:04x}]")
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = [
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.pairs = PairTable(*np.array(pairs, dtype=np.int64).reshape(-1, 3).T)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def cut(self, text: str) -> list[str]:
        return (self.pattern if self.beyond.search(text) else self.latin).findall(text)

    # --- pieces ---

    def encode_pieces(self, pieces: Sequence[bytes]) -> list[bytes]:
        """Ids of each piece: its own id when it is a token, else what the merges leave."""
        out: list = [None] * len(pieces)
        widths: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            own = self.direct.get(piece)
            if own is not None:
                out[i] = own.to_bytes(4, sys.byteorder)
            elif not piece:
                out[i] = b""
            elif len(piece) > LONG:
                out[i] = self._merge_long(piece).tobytes()
            else:
                widths.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, members in widths.items():
            step = max(1, CELLS // width)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for i, ids in zip(part, self._merge_rows([pieces[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def _merge_rows(self, pieces: list[bytes]) -> list[bytes]:
        lengths = np.array([len(p) for p in pieces])
        width, merges = int(lengths.max()), 0
        ids = np.full((len(pieces), width + 1), -1, dtype=np.int32)
        inside = np.arange(width + 1) < lengths[:, None]
        ids[inside] = self.byte_id[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        ranks = self.pairs.ranks(ids[:, :-1], ids[:, 1:])  # the last column is padding, so never the least
        rows, out = np.arange(len(pieces)), [b""] * len(pieces)
        while len(rows):
            at = ranks.argmin(1)
            least = ranks[np.arange(len(rows)), at]
            done = least == NONE
            if done.any():
                rest, stride = ids[done].tobytes(), 4 * ids.shape[1]
                left = 4 * (lengths[rows[done]] - merges)  # each round takes one id from each row
                for n, (row, end) in enumerate(zip(rows[done].tolist(), left.tolist(), strict=True)):
                    out[row] = rest[n * stride : n * stride + end]
                going = ~done
                ids, ranks, rows, at, least = ids[going], ranks[going], rows[going], at[going], least[going]
                if not len(rows):
                    break
            merges += 1
            each = np.arange(len(rows))
            ids[each, at] = least
            keep = np.ones(ids.shape, dtype=bool)
            keep[each, at + 1] = False
            ids = ids[keep].reshape(len(rows), -1)
            keep = np.ones(ranks.shape, dtype=bool)
            keep[each, at] = False
            ranks = ranks[keep].reshape(len(rows), -1)
            before = np.flatnonzero(at > 0)
            if len(before):
                j = at[before]
                ranks[before, j - 1] = self.pairs.ranks(ids[before, j - 1], ids[before, j])
            after = np.flatnonzero(at < ranks.shape[1])
            if len(after):
                j = at[after]
                ranks[after, j] = self.pairs.ranks(ids[after, j], ids[after, j + 1])
            if ranks.shape[1] == 0:
                ranks = np.full((len(rows), 1), NONE)
        return out

    def _merge_long(self, piece: bytes) -> np.ndarray:
        ids = self.byte_id[np.frombuffer(piece, dtype=np.uint8)]
        ranks = self.pairs.ranks(ids[:-1], ids[1:])
        while len(ranks) and (least := ranks.min()) != NONE:
            at = np.flatnonzero(ranks == least)
            # Of overlapping occurrences (a run of one token) every other one merges.
            run = np.cumsum(np.r_[True, np.diff(at) > 1])
            first = at[np.r_[True, np.diff(at) > 1]]
            at = at[(at - first[run - 1]) % 2 == 0]
            merged = np.zeros(len(ids), dtype=bool)
            merged[at] = True
            gone = np.zeros(len(ids), dtype=bool)
            gone[at + 1] = True
            after = ids.copy()
            after[at] = least
            place = np.cumsum(~gone) - 1  # of each kept token among the kept
            after = after[~gone]
            new = self.pairs.ranks(after[:-1], after[1:])
            here = place[at]
            low = np.zeros(len(at), dtype=bool)
            has_left = here > 0
            low[has_left] |= new[here[has_left] - 1] < least
            # To the right stands, at that moment, the token before its own merge.
            follows = at + 2 < len(ids)
            right = self.pairs.ranks(np.full(int(follows.sum()), least, dtype=np.int32), ids[at[follows] + 2])
            low[follows] |= right < least
            if low.any():
                at = at[: int(np.argmax(low)) + 1]
                gone = np.zeros(len(ids), dtype=bool)
                gone[at + 1] = True
                after = ids.copy()
                after[at] = least
                after = after[~gone]
                new = self.pairs.ranks(after[:-1], after[1:])
            ids, ranks = after, new
        return ids

    # --- texts ---

    def _known(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Ids of distinct pieces, remembered in two generations of bounded size."""
        known, new = {}, []
        for piece in pieces:
            ids = self.young.get(piece) or self.old.get(piece)
            if ids is None:
                new.append(piece)
            else:
                known[piece] = ids
        for piece, ids in zip(new, self.encode_pieces([p.encode() for p in new]), strict=True):
            known[piece] = ids
            if len(piece) <= 32:
                if len(self.young) >= REMEMBERED:
                    self.old, self.young = self.young, {}
                self.young[piece] = ids
        return known

    def encode_texts(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text; texts are worked on in groups of about GROUP characters."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= GROUP:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[np.ndarray]:
        pieces = [self.cut(text) for text in texts]
        known = self._known(set(chain.from_iterable(pieces)))
        for own in pieces:
            yield np.frombuffer(b"".join(map(known.__getitem__, own)), dtype=np.int32)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token from a file of lines ``base64(token) rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


@lru_cache(maxsize=1)
def codec(path: str, pattern: str) -> Codec:
    """One codec per Python worker; every machine has the vocabulary file at the same place."""
    return Codec(read_ranks(path), pattern)


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", keep: Sequence[str] = ("doc_id",), decode: bool = False
) -> DataFrame:
    """The columns ``keep``, ``token_ids`` (array of int) and ``n_tokens`` of each row's whole text.

    ``decode`` adds ``decoded``: the bytes that the ids stand for.
    """
    common.small_batches(docs.sparkSession)
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("text"))
    schema = source.drop("text").schema.add("token_ids", T.ArrayType(T.IntegerType())).add("n_tokens", "long")
    if decode:
        schema = schema.add("decoded", "binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            kept = [batch.column(i) for i in range(len(keep))]
            texts, at = batch.column("text").to_pylist(), 0
            ids: list[np.ndarray] = []
            size = 0
            for n, encoded in enumerate(own.encode_texts(texts), 1):
                ids.append(encoded)
                size += len(encoded)
                if size >= GROUP or n == len(texts):
                    columns = [c.slice(at, len(ids)) for c in kept]
                    ends = np.cumsum([0, *map(len, ids)])
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids))))
                    columns.append(pa.array(np.diff(ends), pa.int64()))
                    if decode:
                        columns.append(pa.array([own.decode(x.tolist()) for x in ids], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                    at, ids, size = n, [], 0

    made = source.mapInArrow(work, schema)
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *schema.names[len(keep) :])


def decode_ids(rows: DataFrame, path: str, pattern: str, ids: str = "token_ids", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``decoded``, the bytes of the ids; a null list gives empty bytes."""
    common.small_batches(rows.sparkSession)
    source = rows.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(ids).cast("array<int>").alias("ids"))
    schema = source.drop("ids").schema.add("decoded", "binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            made = pa.array([own.decode(x or ()) for x in batch.column("ids").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=schema.names)

    made = source.mapInArrow(work, schema)
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "decoded")
