"""A corpus pipeline over ``documents``: reject low quality, drop exact and near copies, mix sources, encode.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import bpe, exact_dedup, mixing, ngram_join, quality_classifier
from shelfcast.llm.common import table
from shelfcast.session import written

TOKENIZER = "word_bpe_49k.json"
QUALITY_THRESHOLD = 0.7
#: For near-copy stages; the contract of three words and 90 percent binds the query ``op2_ngram_join`` only.
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores at the threshold or above."""
    made = quality_classifier.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_classifier.accepted(docs, made, QUALITY_THRESHOLD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by their shingles, the one with the smallest id."""
    return ngram_join.one_per_class(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the text they decode to."""
    return bpe.with_digests(bpe.encode_decode(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality classifier", accept_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("BPE encoding", encode),
]

#: No SQL for compression, learnt scores and merges; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
