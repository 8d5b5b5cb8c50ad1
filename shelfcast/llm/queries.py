"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    bpe,
    exact_dedup,
    lm_scoring,
    merkle,
    mixing,
    ngram_join,
    oracles,
    pii,
    prefix_trie,
    quality_classifier,
    quality_rules,
    simhash,
    token_counts,
    toxicity,
)
from shelfcast.llm.common import table
from shelfcast.llm.learning import with_fold

BPE_FILE = "word_bpe_49k.json"
PIECES_FILE = "byte_bpe_50k.tiktoken"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return with_fold(toxicity.scores(docs, model), 5, 0, 0.5)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"), n=3, percent=90)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = bpe.with_digests(bpe.encode_decode(docs, public_tokenizers.path(BPE_FILE)))
    return found.drop("ids")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents")).drop("d2")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.decisions(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return with_fold(quality_classifier.scores(docs, made), 4, 2, 0.7)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.with_digests(pii.personal_data(table(spark, sf_dir, "documents")))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every word and pair of the corpus."""
    found = lm_scoring.scores(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.round(c, 6) for c in ("log_score", "mean_log_score")})


def op8_lm_scoring_all_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``op8_lm_scoring``, under the name it had while that one kept a vocabulary."""
    return op8_lm_scoring(spark, sf_dir)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES_FILE))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.decisions(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(merkle.proofs(table(spark, sf_dir, "documents")))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"), n=3)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_ngram_join,
        op3_bpe,
        op4_quality_rules,
        op5_mixing,
        op6_quality_classifier,
        op7_pii,
        op8_lm_scoring,
        op8_lm_scoring_all_words,
        op9_token_counts,
        op10_exact_dedup,
        op11_merkle,
        op12_simhash,
        op13_prefix_trie,
    )
}

ORACLES: dict[str, str] = {
    "op2_ngram_join": oracles.NGRAM_JOIN,
    "op4_quality_rules": oracles.quality_rules_sql(),
    "op5_mixing": oracles.MIXING,
    "op7_pii": oracles.PII,
    "op8_lm_scoring": oracles.LM_SCORING,
    "op8_lm_scoring_all_words": oracles.LM_SCORING,
    "op10_exact_dedup": oracles.EXACT_DEDUP,
    "op11_merkle": oracles.MERKLE,
    "op13_prefix_trie": oracles.PREFIX_TRIE,
}
