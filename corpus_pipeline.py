"""A training-data pipeline over ``documents``, built from the corpus operators.

Each stage takes and returns the columns of documents, but for the last. Rows with nulls, repeated
rows and empty tables are treated as the operators' modules say.
"""

from __future__ import annotations

import public_tokenizers
from millrace.llm import bpe, common, dedup, langid, mixing, secrets

RANKS = "byte_bpe_multi_50k.tiktoken"
LEAST_SCORE = 0.5


def identify_language(spark, docs, sf_dir):
    """Learn languages from the labelled documents; those in no known language, or told with too little certainty, go."""
    return langid.identified(docs, langid.train(docs), LEAST_SCORE)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates stays, the one with the least id (shingles of five words, 0.8)."""
    return dedup.deduplicated(docs)


def mask_secrets(spark, docs, sf_dir):
    """Secrets are replaced by a mark in the text; every document stays."""
    return secrets.masked(docs)


def mix_sources(spark, docs, sf_dir):
    """Documents stay as often as the mix takes them: not at all, once, or two times."""
    return mixing.repeated(docs)


def encode_texts(spark, docs, sf_dir):
    """Token ids of every text."""
    return bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("secret_scans", mask_secrets),
    ("source_mix", mix_sources),
    ("bpe_encoding", encode_texts),
]

# Classifier, signatures, knapsack and merges have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply all stages to the documents of a folder, storing each stage's result for the next one."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
