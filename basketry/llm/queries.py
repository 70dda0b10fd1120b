"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import (alignment, embeddings, exact, language, licenses, lines, packing, phrases, pieces, pii, simhash, tokens,
                          topk)
from basketry.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"), words=4, distance=4)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", limit=1024)


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_dedup(table(spark, sf_dir, "embeddings"), least=0.93)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents"), window=3)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(table(spark, sf_dir, "documents"), "word_bpe_49k.json", size=2048)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.train(docs))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text is encoded, and each of its segmentations decoded again and held against it."""
    return pieces.encode(table(spark, sf_dir, "documents"), "piece_bpe_32k.model", n=2, with_decoded=True)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"), least=0.8)


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5, scale=256.0)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, most=2000, covered=80)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", "piece_bpe_32k.model")


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (op1_simhash, op2_token_counts, op3_embedding_dedup, op4_line_dedup, op5_best_fit_packing, op6_pii,
                            op7_language_id, op8_pieces, op9_exact_dedup, op10_licenses, op11_top_k, op12_collocations, op13_alignment)
}
