"""The queries of this folder over the driver tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clasp.llm import decontamination, infilling, language, licenses, lm_scoring, mixing, neighbours, pii, simhash, substrings, token_counts, token_store, whitening
from clasp.llm.common import table
from clasp.session import scratch_path


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


#: A public vocabulary that drops white space and marks word ends; ids below 2**16.
TOKENIZER, VOCABULARY, END_ID = "word_bpe_49k.json", 49_408, 1


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = token_store.write_tokens(
        table(spark, sf_dir, "documents"), scratch_path(spark, "llm", "token-store"), tokenizer_path(),
        VOCABULARY, END_ID, by_word=True)
    return token_store.digests(spark, store)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scores(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.round("score", 6).alias("score"), F.round("mean", 6).alias("mean"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs)).drop("redacted")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no paths: a document lies under its source, in folders
    of a thousand ids."""
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000).cast("string"), F.col("doc_id").cast("string"))
    return licenses.scan(table(spark, sf_dir, "documents"), path=path)


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache of this run's own: its result must not depend on earlier runs."""
    cache = token_counts.TokenCountCache(scratch_path(spark, "llm", "token-count-cache"))
    counter = token_counts.Counter(tokenizer_path("piece_bpe_32k.model"))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), cache, counter).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op13_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infilling.digests(infilling.infill(table(spark, sf_dir, "documents")))


LLM_REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_neighbours": op2_neighbours,
    "op3_language": op3_language,
    "op4_token_store": op4_token_store,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_decontamination": op6_decontamination,
    "op7_pii": op7_pii,
    "op8_mixing": op8_mixing,
    "op9_licenses": op9_licenses,
    "op10_substrings": op10_substrings,
    "op11_token_counts": op11_token_counts,
    "op12_whitening": op12_whitening,
    "op13_infilling": op13_infilling,
}

LLM_ORACLE: dict[str, str] = {
    "op5_lm_scoring": lm_scoring.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op13_infilling": infilling.ORACLE,
}
