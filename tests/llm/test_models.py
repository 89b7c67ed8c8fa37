"""Language identification and nearest neighbours, which are held to accuracy and recall."""

from __future__ import annotations

import random
import zlib

import compare
import edge
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import ann, langid
from millrace.llm.common import table
from millrace.llm.queries import QUERIES

# --- languages ---


def test_held_out_fold(spark):
    frame = spark.createDataFrame([(n,) for n in [None, *range(-50, 300)]], "doc_id long")
    for row in frame.select("doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect():
        assert row.h == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 4 == 2)


def test_accuracy_on_held_out_documents(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in table(spark, sf_dir, "documents").collect()}
    told = [r for r in QUERIES["op9_langid"](spark, sf_dir).collect() if r.held_out]
    assert told and all(0 <= r.score <= 1 for r in told)
    assert sum(r.lang_pred == truth[r.doc_id] for r in told) >= 0.98 * len(told)


def test_held_out_documents_teach_nothing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    wrong = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    first, second = langid.train(docs), langid.train(wrong)
    assert first.languages == second.languages
    assert np.array_equal(first.weights, second.weights) and first.temperature == second.temperature


def test_weights_are_sparse_and_the_order_of_rows_does_not_matter(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    first, second = langid.train(docs), langid.train(docs.repartition(7, "doc_id"))
    assert np.array_equal(first.weights, second.weights)
    assert 0 < (first.weights != 0).mean() < 0.6


def test_temperature_corrects_confidence():
    """Labels that are wrong for a quarter of the texts: scores must not claim to be right more often."""
    pick = random.Random(1)

    def drawn():
        lang = pick.randint(0, 1)
        text = " ".join(pick.choices([["alpha", "beta", "gamma"], ["uno", "dos", "tres"]][lang], k=12))
        return lang ^ (pick.random() < 0.25), text

    model = langid.fit(["a", "b"], [(lang, *langid.counts(text)) for lang, text in (drawn() for _ in range(600))])
    told = [(lang, *model.predict(text)) for lang, text in (drawn() for _ in range(400))]
    right = np.mean(["ab"[lang] == name for lang, name, _ in told])
    assert 0.6 < right < 0.85
    assert abs(np.mean([score for *_, score in told]) - right) < 0.12


def test_fit_equals_a_dense_loop():
    """The update written out over all weights at once, without skipping features that a text lacks."""
    pick = random.Random(8)
    rows = [(i % 3, *langid.counts("".join(pick.choice("abcd efgh"[i % 3 * 2 :]) for _ in range(60)))) for i in range(40)]
    model = langid.fit(["a", "b", "c"], rows)
    n = langid.FEATURES
    df = sum(np.isin(np.arange(n), at).astype(float) for _, at, _ in rows)
    idf = np.log((1 + len(rows)) / (1 + df)) + 1

    def dense(at, count):
        x = np.zeros(n)
        x[at] = np.log1p(count) * idf[at]
        return np.append(x / np.linalg.norm(x), 1.0)

    learn = [(y, dense(at, c)) for i, (y, at, c) in enumerate(rows) if i % 5]
    z, squares = np.zeros((n + 1, 3)), np.zeros((n + 1, 3))

    def weights():
        rate = (langid.BETA + np.sqrt(squares)) / langid.ALPHA + langid.L2
        return np.where(np.abs(z) <= langid.L1, 0.0, (np.sign(z) * langid.L1 - z) / rate)

    for epoch in range(langid.EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(learn)):
            y, x = learn[i]
            w = weights()
            scores = np.exp(x @ w - (x @ w).max())
            gradient = x[:, None] * (scores / scores.sum() - np.eye(3)[y])[None, :]
            z += gradient - (np.sqrt(squares + gradient**2) - np.sqrt(squares)) / langid.ALPHA * w
            squares += gradient**2
    w = weights()
    assert np.allclose(model.weights, w[:-1], atol=1e-5) and np.allclose(model.bias, w[-1], atol=1e-5)
    logits = w[model.weights.any(axis=1).nonzero()[0]]
    assert len(logits) < n
    text = "abc efg"
    shares = langid.softmax(dense(*langid.counts(text)) @ w / model.temperature)
    assert model.predict(text) == (["a", "b", "c"][shares.argmax()], pytest.approx(shares.max(), abs=1e-4))


def test_every_labelled_language_is_learned(spark):
    names = [f"l{i:03}" for i in range(150)]
    rows = [(i, f"{name} " * 30 + str(i), name) for i, name in enumerate(names * 20) if zlib.crc32(str(i).encode()) % 4 != 2]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == names


def test_documents_with_everything(spark):
    docs = edge.documents(spark, clash=True)
    model = langid.train(docs)
    assert model.languages == ["en", "fr"]
    for row in langid.classify(docs, model, keep=("doc_id", "text")).collect():
        if any(map(str.isalpha, row.text or "")):
            assert row.lang_pred in ("en", "fr") and 0 < row.score <= 1
        else:
            assert (row.lang_pred, row.score) == ("und", 0.0)


def test_without_labels_or_rows(spark):
    docs = edge.documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.classify(docs, langid.train(docs)).collect()} == {("und", 0.0)}
    none = edge.empty(spark)
    assert langid.classify(none, langid.train(none)).count() == 0


# --- neighbours ---


def brute(rows, every, k):
    """Exact neighbours among rows (vec_id, vector) that take part."""
    out = {}
    for query_id in sorted({i for i, _ in rows if i is not None and i % every == 0}):
        q = min(v for i, v in rows if i == query_id)
        near = []
        for i, v in rows:
            if i != query_id:
                a, b = np.array(q), np.array(v)
                near.append((-float((a * b).sum() / (np.sqrt((b * b).sum()) * np.sqrt((a * a).sum()))), i is None, i))
        out[query_id] = [(i, -s) for s, _, i in sorted(near, key=lambda x: (x[0], x[1], x[2] or 0))[:k]]
    return out


def found(frame, **options):
    out = {}
    for row in sorted(ann.search(frame, **options).collect(), key=lambda r: (r.query_id, r["rank"])):
        near = out.setdefault(row.query_id, [])
        near.append((row.vec_id, row.score))
        assert row["rank"] == len(near)
    return out


SCHEMA = "vec_id long, embedding array<float>"


def test_small_tables_are_exact(spark):
    pick = np.random.default_rng(3)
    rows = [(n, pick.normal(size=8).astype("f4").tolist()) for n in range(120)]
    rows += [(200 + n, rows[5][1]) for n in range(9)] + [(None, rows[10][1]), (10, rows[10][1]), (10, rows[11][1])]
    odd = [(301, None), (302, []), (303, [0.0] * 8), (304, [None] + [1.0] * 7), (305, [float("nan")] * 8), (306, [float("inf")] * 8), (310, [1.0])]
    frame = spark.createDataFrame(rows + odd, SCHEMA)
    for name in edge.CLASHES:
        frame = frame.withColumn(name, F.lit("clash"))
    got, wanted = found(frame, every=10), brute(rows, 10, 5)
    assert got.keys() == wanted.keys()
    for query, near in wanted.items():
        assert [i for i, _ in got[query]] == [i for i, _ in near]
        assert [s for _, s in got[query]] == pytest.approx([s for _, s in near], abs=1e-12)


def test_fewer_candidates_than_asked_for(spark):
    assert found(spark.createDataFrame([(50, [1.0, 0.0]), (51, [1.0, 1.0])], SCHEMA), every=50)[50][0][0] == 51
    assert found(spark.createDataFrame([(50, [1.0, 0.0])], SCHEMA), every=50) == {}
    assert found(edge.empty(spark, SCHEMA), every=50) == {}


def test_recall_with_many_parts(spark):
    pick = np.random.default_rng(4)
    centres = pick.normal(size=(40, 16))
    cloud = np.concatenate([centres[pick.integers(0, 40, 5000)] + 0.5 * pick.normal(size=(5000, 16)), np.tile(centres[0], (1500, 1))])
    rows = [(n, v.tolist()) for n, v in enumerate(cloud)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(frame, every=25)
    unit = cloud / np.linalg.norm(cloud, axis=1, keepdims=True)
    hits, asked = 0, np.arange(0, len(rows), 25)
    for query in asked:
        near = unit @ unit[query]
        near[query] = -np.inf
        edge_ = np.sort(near)[-5] - 1e-12
        assert len(got[query]) == 5
        hits += sum(near[i] >= edge_ for i, _ in got[query])
        # Copies of one vector are equally near, and the smaller ids come first.
        assert got[query] == sorted(got[query], key=lambda x: (-x[1], x[0]))
    assert hits >= 0.9 * 5 * len(asked)


def test_partition_is_balanced():
    pick = np.random.default_rng(5)
    unit = ann.units(pick.normal(size=(1024, 12)))
    part = ann.partition(ann.neighbours(unit, 10), 8)
    sizes = np.bincount(part)
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 8
    near = ann.neighbours(unit, 10)
    assert (part[near] == part[:, None]).mean() > 0.3  # by chance it would be an eighth


def test_recall_on_the_tables(spark, sf_dir):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in table(spark, sf_dir, "embeddings").collect()]
    got, wanted = found(table(spark, sf_dir, "embeddings"), every=50), brute(rows, 50, 5)
    assert got.keys() == wanted.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in near}) for q, near in wanted.items())
    assert hits >= 0.9 * sum(map(len, wanted.values()))


def test_registered_queries_have_rows(spark, sf_dir):
    assert set(QUERIES) == {
        "op1_warc", "op2_bpe", "op3_dedup", "op4_secrets", "op5_mixing",
        "op6_token_counts", "op7_urls", "op8_quality", "op9_langid", "op10_ann",
        "op11_spelling", "op12_hard_negatives", "op13_html",
    }
    assert compare.TABLES
