"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, PII, best-fit packing.

Each stage works on all that its predecessor kept; all but the last return
the columns of ``documents``. Between stages the rows are written as Parquet
into the shared checkpoint folder and read again, so a lost executor never
sends a job back further than its own stage.

SQL cannot express the language model, the fingerprints and the tokenizer, so
there is no ORACLE_SQL; tests/llm compares run() with a plain version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import exact, language, packing, pii, simhash
from basketry.session import checkpoint_root


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, or no letters in it) go; a missing ``lang`` is filled in where the prediction is clear."""
    return language.keep_known(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of linked fingerprints stays (4-word shingles, 4 bits)."""
    return simhash.keep_first(docs, words=4, distance=4)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by the name of its kind."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed into sequences of 2048."""
    return packing.best_fit_pack(docs)


STAGES = [
    ("language_id", keep_languages),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("pii", redact_pii),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last.

    The stages' tables stay in the checkpoint folder (one folder a run), as the
    result reads the last of them; clearing it is the caller's."""
    folder = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4()}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
