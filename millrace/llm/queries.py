"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from millrace.llm import ann, bpe, dedup, extraction, langid, mixing, negatives, quality, secrets, spelling, token_counts, urls, warc
from millrace.llm.common import table

RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_warc(spark, sf_dir):
    """Write all pages as seekable WARC bundles, read the bundles back, report each record."""
    index = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(index, payload=False).drop("payload", "url")


def op2_bpe(spark, sf_dir):
    """Encode every document, decode the ids, and digest both."""
    docs = table(spark, sf_dir, "documents")
    made = bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, decode=True)
    listed = F.concat_ws(",", F.col("token_ids").cast("array<string>"))
    return made.select(
        "doc_id",
        "n_tokens",
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_dedup(spark, sf_dir):
    """Near duplicates of all documents on shingles of four words."""
    return dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4).drop("text_hash")


def op4_secrets(spark, sf_dir):
    """Secret spans of every document, weak parts where their complements are near."""
    return secrets.scan(table(spark, sf_dir, "documents")).drop("found", "key")


def op5_mixing(spark, sf_dir):
    """What the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def edits_of(doc_id, text, source):
    """Two edits of a document: a passage in its first half is replaced by its source's name, one behind it is cut out."""
    size = F.length(F.coalesce(text, F.lit("")))
    start = F.pmod(F.xxhash64(doc_id), F.greatest(F.lit(1), F.floor(size / 2)))
    name = F.concat(F.lit(" "), F.coalesce(source, F.lit("none")), F.lit("'s "))
    return F.array(
        F.struct(start.alias("start"), (start + 7).alias("end"), name.alias("text")),
        F.struct((start + 40).alias("start"), (start + 53).alias("end"), F.lit("").alias("text")),
    ).cast(token_counts.EDITS)


def op6_token_counts(spark, sf_dir):
    """Token counts of every document before and after edits, with what the edits made to be encoded anew."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.withColumn("edits", edits_of(F.col("doc_id"), F.col("text"), F.col("source")))
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    trees = token_counts.build(docs, path, pattern, keep=("doc_id", "edits"))
    trees = trees.withColumns({"n_tokens_before": F.col("n_tokens"), "n_pretokens": F.size("pre_chars").cast("long")})
    kept = ("doc_id", "n_tokens_before", "n_pretokens")
    return token_counts.apply_edits(trees, path, pattern, keep=kept, leaves=False)


def op7_urls(spark, sf_dir):
    """Rules and, where none fits, the language models' verdict for every page."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op8_quality(spark, sf_dir):
    """Base counts and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_langid(spark, sf_dir):
    """Language of every document, learned from labelled documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    told = langid.classify(docs, langid.train(docs))
    return told.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_ann(spark, sf_dir):
    """The five nearest vectors of every fiftieth one."""
    return ann.search(table(spark, sf_dir, "embeddings"), every=50)


def op11_spelling(spark, sf_dir):
    """The vocabulary of all documents with the more frequent spelling of each word, where it has one."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector; every seventh row is labelled one further, as a wrong label would be."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", label), every=100).drop("positive_rank")


def op13_html(spark, sf_dir):
    """The main text of every page."""
    return extraction.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_bpe,
        op3_dedup,
        op4_secrets,
        op5_mixing,
        op6_token_counts,
        op7_urls,
        op8_quality,
        op9_langid,
        op10_ann,
        op11_spelling,
        op12_hard_negatives,
        op13_html,
    )
}

ORACLE = {
    "op1_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
        g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM g""",
    "op12_hard_negatives": """WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                     CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
              FROM v a JOIN v r ON a.vec_id <> r.vec_id AND len(a.q) = len(r.q) WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id,
               positive_score, s.score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
             AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
        QUALIFY row_number() OVER w <= 10""",
}
