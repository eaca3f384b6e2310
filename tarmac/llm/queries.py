"""The operators bound to the registered tables: one thin query each, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm.bpe_chunks import encode_decode
from tarmac.llm.common import prepare, save
from tarmac.llm.conversation_trie import conversations, prefix_trie, with_shared_heads
from tarmac.llm.decontaminate import contamination
from tarmac.llm.fingerprints import fingerprints
from tarmac.llm.line_dedup import line_dedup
from tarmac.llm.lm_scoring import lm_scores
from tarmac.llm.ngram_join import near_duplicates
from tarmac.llm.phrases import phrases
from tarmac.llm.quality import quality
from tarmac.llm.sharding import shard_rows
from tarmac.llm.suffix_dedup import suffix_dedup
from tarmac.llm.token_counts import piece_scores, token_counts
from tarmac.llm.toxicity import toxicity

#: Folder of the public vocabulary files (a parameter; they are not part of the repository).
TOKENIZERS = "/opt/tokenizers"


def tokenizer_path(name: str) -> str:
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join(TOKENIZERS, name)
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), piece_scores(tokenizer_path("piece_bpe_32k.model")))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), texts=False)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_heads(save(conversations(table(spark, sf_dir, "conversations")), "conversations")))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(table(spark, sf_dir, "documents"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_token_counts, op2_fingerprints, op3_bpe, op4_toxicity, op5_sharding, op6_decontamination,
        op7_suffix_dedup, op8_line_dedup, op9_quality, op10_ngram_join, op11_conversation_trie,
        op12_lm_scoring, op13_phrases,
    )
    return {f.__name__: f for f in own}
