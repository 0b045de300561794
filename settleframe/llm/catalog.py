"""Registered queries of this subpackage: one thin query per operator, each
over its whole table with production parameters, and SQL where it can say the
same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from settleframe.llm import (
    byte_cnn,
    exact_dedup,
    jaccard_join,
    license_scan,
    lm_trie,
    merkle,
    mixing,
    packing,
    phrases,
    quality_rules,
    sharding,
    token_files,
    warc,
)
from settleframe.llm.oracles import ORACLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a vocabulary file, given by the installed package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op2_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return byte_cnn.score(docs, byte_cnn.fit(docs, _table(spark, sf_dir, "labels")))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.document_components(_table(spark, sf_dir, "documents"))


def op6_lm_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_trie.train_and_score(_table(spark, sf_dir, "documents"), min_count=1)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.measure(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "shards")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.score_quality(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "failed_rules")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(_table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_test(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_byte_cnn": op2_byte_cnn,
    "op3_warc": op3_warc,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_lm_trie": op6_lm_trie,
    "op7_mixing": op7_mixing,
    "op8_packing": op8_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_sharding": op10_sharding,
    "op11_phrases": op11_phrases,
    "op12_token_files": op12_token_files,
    "op13_merkle_manifest": op13_merkle_manifest,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
