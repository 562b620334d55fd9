"""The registered queries of this subpackage, with production parameters.

Each applies its operator to the whole table it is meant for and derives the
columns that the query returns from the operator's own output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actlens.llm import (
    bpe,
    decontamination,
    line_dedup,
    pii,
    prefix_trie,
    quality_model,
    quality_rules,
    simhash,
    substring_dedup,
    token_counts,
    url_filter,
    vector_codes,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> tuple[str, str]:
    """Path and pattern of the public tokenizer that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def count_file() -> tuple[str, str]:
    """Path and pattern of the public tokenizer whose tokens are counted."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), *tokenizer_file())


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes(_table(spark, sf_dir, "embeddings"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), *count_file())


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_simhash": op2_simhash,
    "op3_warc": op3_warc,
    "op4_url_filter": op4_url_filter,
    "op5_line_dedup": op5_line_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_quality_rules": op7_quality_rules,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_personal_data": op9_personal_data,
    "op10_decontamination": op10_decontamination,
    "op11_vector_codes": op11_vector_codes,
    "op12_token_counts": op12_token_counts,
    "op13_prefix_trie": op13_prefix_trie,
}
