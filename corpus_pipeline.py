"""Corpus pipeline: five stages, each written as Parquet and read again.

Each stage works on all rows that the one before it kept, and what it
decides takes effect: rows that language ID rejects go, one row of each
near-duplicate group stays, rows that cover a benchmark item go, the mix
repeats or drops rows to meet its budgets, and the rest becomes token ids.
All stages but the last return the columns of ``documents``.

Cases (nulls, empty and very long texts, ties, repeated rows, empty tables,
columns with clashing names) follow the operators' docstrings. Repeated rows
are near-duplicates, so one of them stays; a row whose text is null or has
no letter is rejected by language ID.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clasp.llm import decontamination, language, mixing, simhash, token_store
from clasp.llm.common import cut, table
from clasp.llm.queries import END_ID, VOCABULARY, tokenizer_path
from clasp.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.recognised(docs, language.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token store; one row per stored document, read back."""
    store = token_store.write_tokens(docs, scratch_path(spark, "llm", "pipeline-tokens"), tokenizer_path(),
                                     VOCABULARY, END_ID, by_word=True)
    return token_store.digests(spark, store)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token_ids", token_ids),
]

#: Fingerprints, tilings and token ids aren't SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
