"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regiflow.llm import (bpe, language_id, lexical, lm, mixing, neardup, ngram_join, packing, pii, quality, substring, suffix_dedup,
                          whitening)

QueryFn = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(read(spark, sf_dir, "documents"), words=3, percent=90)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(substring.dedup_substrings(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(lm.score(read(spark, sf_dir, "documents").select("doc_id", "text"), lm.held_out()))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_vectors(read(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.dedup_bytes(read(spark, sf_dir, "documents").select("doc_id", "text")))


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op9_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), tokenizer_path())


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(read(spark, sf_dir, "documents")))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build_index(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_substring_dedup, op3_lm_scoring, op4_quality_rules, op5_embedding_near_dedup,
    op6_language_id, op7_pii, op8_suffix_array_dedup, op9_bpe_encode_decode, op10_best_fit_packing,
    op11_embedding_whitening, op12_source_mixing, op13_lexical_search)}
ORACLES: dict[str, str] = {"op2_substring_dedup": substring.ORACLE, "op4_quality_rules": quality.oracle(),
                           "op12_source_mixing": mixing.ORACLE, "op13_lexical_search": lexical.ORACLE}
