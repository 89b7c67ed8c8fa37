"""Spelling variants: words of a vocabulary that one edit turns into a much more frequent word.

The vocabulary is counted over all texts. Two words that differ by one inserted, deleted or
replaced code point share the first or the last half of the shorter one, whichever half the edit
spares. Words are dealt out by these halves. Each deal is a bit-sliced position index: for
every position and letter a bitset over the words of the deal. All words of the shorter length run
through it side by side, letter by letter, and keep two pairs of sets: the words matched so far
without an error and those matched with one, over the words of equal length (one replacement) and,
read one position further on, over the words that are longer by one (one insertion). A hit counts
in the one deal that both words' first differing half points to, so nothing is counted twice.

A half that more than ``DEAL`` words share is dealt out as pairs of blocks, so that all its pairs meet. A
deal returns one row per word: how many near words it saw, and the most frequent of them.

Null texts have no words; a null doc_id counts as an empty one. Repeated rows count again. Of equally
frequent near words the smallest in code-point order is the form. Empty tables give no rows. A text is
read as a whole array of its words, however long it is; words may have any length. Further columns
do not matter.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import common

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 6
LEAST_COUNT = 5
FACTOR = 5  # a form is at least so many times as frequent
DEAL = 4096  # words of a deal, about

FOUND = "word string, near long, form string, form_n long"


def vocabulary(docs: DataFrame, mark: int = 199) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts: lower-cased runs of letters, of some of which a letter is deleted.

    A run loses a letter where the CRC-32 of ``<doc_id>:<run>`` is a multiple of ``mark``; the
    hash also says which one.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"),
        F.explode(F.expr(f"regexp_extract_all(text, '{RUN}', 0)")).alias("r"),
    )
    # Only A-Z are lower-cased; `lower` does no more than that on ASCII and is faster.
    ascii_only = F.octet_length("r") == F.length("r")
    lowered = F.when(ascii_only, F.lower("r")).otherwise(F.translate("r", string.ascii_uppercase, string.ascii_lowercase))
    hashed = runs.select("d", lowered.alias("r")).withColumn("h", F.crc32(F.encode(F.concat_ws(":", "d", "r"), "UTF-8")))
    at = (F.col("h") % F.length("r")).cast("int")
    cut = F.concat(F.substring(F.col("r"), F.lit(1), at), F.substring(F.col("r"), at + 2, F.length("r")))
    word = F.when(F.col("h") % mark == 0, cut).otherwise(F.col("r"))
    long_enough = F.filter(F.array(word), lambda w: F.length(w) >= LEAST_LENGTH)
    counted = hashed.select(F.explode(long_enough).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def halves(words: DataFrame) -> DataFrame:
    """Four entries per word: its first and last half among words of its own length, and of a length less by one.

    ``short`` is the shorter length of the pairs that meet under an entry.
    """
    entry = []
    for less in (0, 1):
        short = F.length("word") - less
        half = F.floor(short / 2).cast("int")
        first, last = F.substring(F.col("word"), F.lit(1), half), F.substring(F.col("word"), F.length("word") - half + 1, half)
        entry += [
            F.struct(short.alias("short"), F.lit(kind).alias("kind"), part.alias("half")) for kind, part in (("first", first), ("last", last))
        ]
    return words.select("word", "n", F.inline(F.array(*entry)))


def deals(words: DataFrame, deal: int) -> DataFrame:
    """Entries with the ``deal`` they meet in, and whether they are indexed there, run through it, or both.

    Small halves of one kind and length are put together until a deal has about ``deal`` words; large ones are cut
    into blocks, and each block's words run through the indexes of all blocks. A half of one word, or of none
    of the shorter length, has no pairs.
    """
    key = ["short", "kind", "half"]
    entries = common.stored(halves(words), "halves")
    sizes = entries.groupBy(key).agg(F.count("*").alias("size"), F.count_if(F.length("word") == F.col("short")).alias("asking"))
    sizes = common.stored(sizes.where("size > 1 and asking > 0").drop("asking"), "sizes")
    sums = sizes.where(F.col("size") <= deal).groupBy("short", "kind").agg(F.sum("size").alias("total"))
    small = sizes.where(F.col("size") <= deal).join(sums, ["short", "kind"])
    bucket = F.pmod(F.xxhash64("half"), F.ceil(F.col("total") * 2 / deal))
    place = small.select(*key, F.concat_ws(":", "short", "kind", bucket).alias("place"), F.lit(1).alias("blocks")).unionByName(
        sizes.where(F.col("size") > deal).select(
            *key, F.concat_ws(":", "short", "kind", "half").alias("place"), F.ceil(F.col("size") / deal).cast("int").alias("blocks")
        )
    )
    # Block i asks the index of block j in the deal (i, j), so a word asks in (i, j) and is indexed in (j, i) for all j.
    block, role = F.pmod(F.xxhash64("word"), F.col("blocks")), F.col("role")
    met = entries.join(place, key).select(*key, "word", "n", "place", block.alias("block"), "blocks")
    met = met.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    both = F.col("blocks") == 1
    roles = F.when(both, F.array(F.lit("both"))).otherwise(F.array(F.lit("asks"), F.lit("indexed")))
    met = met.select("*", F.explode(roles).alias("role"))
    deal_of = F.when(role == "indexed", F.concat_ws(":", "place", "other", "block")).otherwise(F.concat_ws(":", "place", "block", "other"))
    return met.select(*key, "word", "n", deal_of.alias("deal"), (role != "asks").alias("indexed"), (role != "indexed").alias("asks"))


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), length)


class PositionIndex:
    """Bitsets over words of one length: which words have a letter at a position."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.length = codes, codes.shape[1]
        self.width = -(-len(codes) // 64)
        self.everything = self._bits(np.ones((1, len(codes)), dtype=bool))[0]

    def _bits(self, flags: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(flags), self.width * 64), dtype=bool)
        padded[:, : flags.shape[1]] = flags
        return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)

    def at(self, position: int) -> tuple[np.ndarray, np.ndarray]:
        """The letters at a position, in order, and the bitset of each; one empty bitset more stands for all others."""
        column = self.codes[:, position]
        letters = np.unique(column)
        bits = self._bits(column[None, :] == letters[:, None])
        return letters, np.vstack([bits, np.zeros((1, self.width), dtype=np.uint64)])


def _rows(letters: np.ndarray, bits: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The bitset of each asked letter."""
    place = np.minimum(np.searchsorted(letters, asked), len(letters) - 1)
    return bits[np.where(letters[place] == asked, place, len(letters))]


def replaced(index: PositionIndex, asked: np.ndarray) -> np.ndarray:
    """Bitsets of the indexed words (of equal length) that one replacement turns each asked word into."""
    none = np.repeat(index.everything[None, :], len(asked), axis=0)
    one = np.zeros_like(none)
    for i in range(index.length):
        same = _rows(*index.at(i), asked[:, i])
        one = (one & same) | (none & ~same)
        none &= same
    return one


def lengthened(index: PositionIndex, asked: np.ndarray) -> np.ndarray:
    """Bitsets of the indexed words (longer by one) that one insertion turns each asked word into."""
    none = np.repeat(index.everything[None, :], len(asked), axis=0)
    one = np.zeros_like(none)
    here = index.at(0)
    for i in range(index.length - 1):
        after = index.at(i + 1)
        # The insertion lies before position i, so letter i stands one position further on.
        one = (one | none) & _rows(*after, asked[:, i])
        none &= _rows(*here, asked[:, i])
        here = after
    return one | none


def _hits(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Asked word and indexed word of every set bit."""
    asked, word = np.nonzero(bits)
    flags = np.unpackbits(bits[asked, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    hit, bit = np.nonzero(flags)
    return asked[hit], word[hit] * 64 + bit


def _deal(table: pa.Table) -> pa.Table:
    """What the words of one deal find: near words counted, and the best one."""
    words, n = np.array(table["word"].to_pylist(), dtype=object), table["n"].to_numpy()
    half = np.unique(np.array(table["half"].to_pylist(), dtype=object), return_inverse=True)[1]
    short, last = table["short"][0].as_py(), table["kind"][0].as_py() == "last"
    lengths = np.array([len(w) for w in words])
    indexed, asks = table["indexed"].to_numpy(), table["asks"].to_numpy()

    left, right = [], []
    asking = np.flatnonzero(asks & (lengths == short))
    for longer, matcher in ((0, replaced), (1, lengthened)):
        members = np.flatnonzero(indexed & (lengths == short + longer))
        if not len(members) or not len(asking):
            continue
        index = PositionIndex(_codes(words[members].tolist(), short + longer))
        a, b = _hits(matcher(index, _codes(words[asking].tolist(), short)))
        a, b = asking[a], members[b]
        keep = half[a] == half[b]
        if last:
            # Words that share their first half as well meet in the deal of that one.
            keep &= np.array([words[x][: short // 2] != words[y][: short // 2] for x, y in zip(a, b)], dtype=bool)
        a, b = a[keep], b[keep]
        # Words of equal length find each other both ways; a longer one is told by the shorter one.
        left += [a, b] if longer else [a]
        right += [b, a] if longer else [b]
    a, b = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (left, right))
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=lambda x: (-n[x], words[x]))] = np.arange(len(words))
    order = np.lexsort((rank[b], a))
    a, b = a[order], b[order]
    word, first, near = np.unique(a, return_index=True, return_counts=True)
    form = b[first]
    return pa.table(
        {"word": words[word].tolist(), "near": near.astype(np.int64), "form": words[form].tolist(), "form_n": n[form].astype(np.int64)},
        schema=pa.schema([("word", pa.string()), ("near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())]),
    )


def near_words(words: DataFrame, deal: int = DEAL) -> DataFrame:
    """``word``, ``n``, ``n_near`` (words within one edit) and ``best``, the most frequent of them with its count, or null."""
    found = deals(words, deal).groupBy("deal").applyInArrow(_deal, FOUND)
    # The least of (-count, word) is the most frequent, of equal ones the smallest.
    summed = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("least"))
    best = F.when(F.col("least").isNotNull(), F.struct(F.col("least.form").alias("word"), (-F.col("least.less")).alias("n")))
    return words.join(summed, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), best.alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last word that following (``word``, ``form``) leads to.

    Each round follows twice as many steps as the one before. A form is several times as frequent as its word, so
    there are no circles, and a few rounds reach every end. Each round's result is a stored table.
    """
    far = common.stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = far.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        far = common.stored(far.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if not far.where("moved").limit(1).count():
            return far.select("word", "root")


def variants(docs: DataFrame, factor: int = FACTOR, deal: int = DEAL) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` for the vocabulary of ``docs`` (doc_id, text)."""
    common.small_batches(docs.sparkSession)
    words = common.stored(vocabulary(docs), "vocabulary")
    near = near_words(words, deal)
    has_form = F.col("best.n") >= factor * F.col("n")
    near = near.select(
        "word", "n", "n_near", F.when(has_form, F.col("best.word")).alias("form"), F.when(has_form, F.col("best.n")).alias("form_n")
    )
    near = common.stored(near, "near")
    ends = roots(near.where("form is not null"))
    return near.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
