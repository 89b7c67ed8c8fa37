"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters are hashed into ``FEATURES`` features. The classifier is fitted
on a bounded sample of labelled documents (``SAMPLE`` in all, shared evenly by the languages, chosen
by a hash of the id), with the follow-the-regularised-leader update and both penalties, so that most
weights are zero. A part of the sample sets the temperature that turns scores into probabilities.
Of every sampled document a short passage is learned too, since short texts are to be told as well.

Every language that labels a document is learned, so the model's size goes with their number. Documents with a null id are never
held out; null texts and texts without a letter are ``und`` with score 0, as is everything when there
are no labels. Ties go to the language first by name. Results are by row: repeated rows and further
columns do not matter, an empty table gives an empty result. Long texts are counted whole, into as many numbers as
there are features; their code points lie in memory at one time.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import common

BITS = 15
FEATURES = 1 << BITS
SAMPLE = 2400
PASSAGE = 80  # characters
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
FOLDS, FOLD = 4, 2
UNKNOWN = "und"

_PLAIN = np.arange(128, dtype=np.uint32)
_PLAIN[[c for c in range(128) if not chr(c).isalpha()]] = 32  # digits, signs and spaces are one character
_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == FOLD, F.lit(False))


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and how often it holds them."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ascii_part = points < 128
    points = np.where(ascii_part, _PLAIN[np.where(ascii_part, points, 0)], points).astype(np.uint64)
    points = np.concatenate([[np.uint64(32)], points, [np.uint64(32)]])
    grams = [points, points[:-1] << np.uint64(21) | points[1:]]
    grams.append(grams[1][:-1] << np.uint64(21) | points[2:])
    cells = [((g + np.uint64(n)) * _MIX) >> np.uint64(64 - BITS) for n, g in enumerate(grams)]
    found = np.bincount(np.concatenate(cells).astype(np.int64), minlength=FEATURES)
    at = np.flatnonzero(found)
    return at, found[at]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features x languages
    bias: np.ndarray
    temperature: float

    def vector(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return tf_idf(self.idf, at, n)

    def logits(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.vector(at, n) @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        shares = softmax(self.logits(*counts(text)) / self.temperature)
        best = int(shares.argmax())
        return self.languages[best], float(shares[best])


def tf_idf(idf: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    value = np.log1p(n) * idf[at]
    return value / max(np.sqrt(value @ value), 1e-12)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max())
    return raised / raised.sum()


def fit(languages: list[str], rows: Sequence[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """Fit on (language number, features, counts); every fifth row is left for the temperature."""
    df = np.zeros(FEATURES)
    for _, at, _ in rows:
        df[at] += 1
    idf = np.log((1 + len(rows)) / (1 + df)) + 1
    learn = [(y, at, tf_idf(idf, at, n)) for i, (y, at, n) in enumerate(rows) if i % 5]
    check = [(y, at, tf_idf(idf, at, n)) for i, (y, at, n) in enumerate(rows) if i % 5 == 0]
    k = len(languages)
    # One more feature, always 1, is the bias.
    z, n2 = np.zeros((FEATURES + 1, k)), np.zeros((FEATURES + 1, k))

    def weights(z: np.ndarray, n2: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n2)) / ALPHA + L2)

    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(learn)):
            y, at, x = learn[i]
            at, x = np.append(at, FEATURES), np.append(x, 1.0)
            w = weights(z[at], n2[at])
            error = softmax(x @ w)
            error[y] -= 1
            g = np.outer(x, error)
            sigma = (np.sqrt(n2[at] + g * g) - np.sqrt(n2[at])) / ALPHA
            z[at] += g - sigma * w
            n2[at] += g * g
    w = weights(z, n2)
    w, bias = w[:-1], w[-1]
    logits = [(y, x @ w[at] + bias) for y, at, x in check]

    def loss(temperature: float) -> float:
        return -sum(np.log(max(softmax(s / temperature)[y], 1e-12)) for y, s in logits)

    temperature = min((1.25**e for e in range(-6, 12)), key=loss) if logits else 1.0
    return Model(languages, idf.astype(np.float32), w.astype(np.float32), bias.astype(np.float32), temperature)


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model:
    """Fit on labelled documents that are not held out.

    Every language that labels a document is learned, from ``sample`` documents over all, ten at least of each. The driver
    gets a count per language and, of the sample, the feature counts of each document and of a passage of it: at most
    ``4 * sample`` vectors (40 per language if that is more) of at most FEATURES entries.
    """
    common.small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col(text).cast("string").alias("text"), "lang").where("lang is not null and text is not null")
    known = rows.where(~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    found = known.groupBy("lang").count().collect()
    languages = sorted(r["lang"] for r in found)
    if not languages:
        return Model([], np.ones(FEATURES, np.float32), np.zeros((FEATURES, 0), np.float32), np.zeros(0, np.float32), 1.0)
    each = max(10, sample // len(languages))
    # A little over the wanted number, so that chance seldom leaves too few.
    shares = [(r["lang"], min(1_000_000, 1_300_000 * each // r["count"] + 1)) for r in found]
    shares = docs.sparkSession.createDataFrame(shares, "lang string, part long")
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000))
    drawn = known.withColumn("draw", draw).join(F.broadcast(shares), "lang").where("draw < part")
    # One row per language is broadcast. Texts become vectors before the drawn ones are put in order.
    drawn = drawn.select("draw", F.xxhash64("doc_id", "text", "lang").alias("row"), "lang", "text")
    schema = T.StructType().add("draw", "long").add("row", "long").add("part", "integer").add("lang", "string").add("at", "binary").add("n", "binary")
    types = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary())

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for *key, lang, whole in zip(*(batch.column(c).to_pylist() for c in ("draw", "row", "lang", "text")), strict=True):
                middle = max(0, (len(whole) - PASSAGE) // 2)
                for part, passage in enumerate((whole, whole[middle : middle + PASSAGE])):
                    at, n = counts(passage)
                    out.append((*key, part, lang, at.astype(np.int32).tobytes(), n.astype(np.int32).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.names
                )

    # A language's chance surplus may take a document of another one's place, but no more than as many again.
    made = drawn.mapInArrow(features, schema).orderBy("draw", "row", "part").limit(4 * each * len(languages))
    number = {lang: i for i, lang in enumerate(languages)}
    vectors = [
        (number[r["lang"]], np.frombuffer(r["at"], np.int32), np.frombuffer(r["n"], np.int32))
        for r in made.select("lang", "at", "n").toLocalIterator()
    ]
    # Rows come in an order that depends on partitions; this one does not.
    vectors.sort(key=lambda v: (v[1].tobytes(), v[2].tobytes(), v[0]))
    model = fit(languages, [vectors[i] for i in np.random.default_rng(0).permutation(len(vectors))])
    vectors.clear()
    _give_back()
    return model


def _give_back() -> None:
    """Return freed memory to the system: the driver needs what thousands of small arrays held."""
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def _told(docs: DataFrame, model: Model, text: str, keep: Sequence[str]) -> DataFrame:
    common.small_batches(docs.sparkSession)
    source = docs.select(F.col(text).cast("string").alias("text"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
    schema = source.drop("text").schema.add("lang_pred", T.StringType()).add("score", T.DoubleType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [model.predict(t) for t in batch.column("text").to_pylist()]
            made = [pa.array([t[0] for t in told], pa.string()), pa.array([t[1] for t in told], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], names=schema.names)

    return source.mapInArrow(work, schema)


def classify(docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, ``lang_pred`` and ``score`` of every row."""
    told = _told(docs, model, text, keep)
    return told.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")


def identified(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """The documents, unchanged, whose language is told with a score of ``least`` or more."""
    told = _told(docs, model, text, docs.columns).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return told.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
