"""The operators as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm import alignment, binary_ids, bpe, decontamination, jaccard_join, language_model, licenses, packing, quality
from llm import suffix_dedup, token_counts, toxicity, whitening
from llm.common import documents
from tripmart.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
BYTE_VOCABULARY, WORD_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).select(*quality.DIGEST)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    return toxicity.score_toxicity(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_join.join_similar(documents(spark, sf_dir), shingle=4, threshold=85)
    return joined.select("doc_id", "n_shingles", "component_id")


def op4_binary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    path = scratch_dir(spark, "id-packs")
    binary_ids.write_packs(docs, path, WORD_VOCABULARY, end_id=2)
    return binary_ids.read_documents(spark, path)


def op5_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), BYTE_VOCABULARY, end_id=0, capacity=2048)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontamination.find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return leaks.drop("text_key")


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(documents(spark, sf_dir))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = suffix_dedup.remove_passages(documents(spark, sf_dir), length=200)
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), BYTE_VOCABULARY, limit=1024)


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(documents(spark, sf_dir, "embeddings"), components=32)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_and_score(documents(spark, sf_dir), BYTE_VOCABULARY, PIECE_VOCABULARY)


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_texts(documents(spark, sf_dir), BYTE_VOCABULARY)
    return bpe.digest(bpe.decode_ids(encoded, BYTE_VOCABULARY))


def queries() -> dict[str, Query]:
    return {
        name: function
        for name, function in globals().items()
        if name.startswith("op") and name[2].isdigit() and callable(function)
    }


def oracle_sql() -> dict[str, str]:
    return {}
