"""A corpus through language ID, near-duplicate removal, decontamination, redaction and packing.

Each stage takes all documents its predecessor kept. All but the last return the columns of ``documents``; ``run``
writes what a stage returns as Parquet to the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import decontamination, language_id, packing, pii, simhash_dedup
from stratalake.llm.common import read_table, stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; undetermined and rejected ones go. Learns from the documents' ``lang``."""
    return language_id.accepted(docs, language_id.fit(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    return simhash_dedup.deduplicate(docs).select(*docs.columns)


def no_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark")).select(*docs.columns)


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` is counted again."""
    cleaned = pii.redact(docs)
    changed = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return cleaned.withColumns(changed).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of fixed length, one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", one_of_each),
    ("decontamination", no_leaks),
    ("pii", no_personal_data),
    ("packing", sequences),
]
# Trained models, hashes and a tokenizer are not SQL; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces all stages make of the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
