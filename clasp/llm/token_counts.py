"""Token counts with a cache keyed by content and tokenizer digests.

The cache is a folder of batches, each a committed Parquet table of
(content, n_tokens), under the digest of the tokenizer that counted them.
That digest covers the vocabulary file's bytes, the library with its version
and the name of the normalisation, so another file, release or rule never
meets old counts.

Counting a table takes three steps:

1. Content digests (SHA-256 of the normalised text) of all rows, reduced to
   distinct ones in every task before they are shuffled, are joined to the
   stored counts. Texts don't move.
2. Digests without a count are the misses. One text of each is encoded:
   copies are reduced in every task before texts are shuffled, and where the
   misses are few Spark sends their digests to the scan instead, so that
   texts with stored counts stay there. The new counts are appended as a
   batch of their own.
3. Rows are joined to the counts of their digests, a written table, so that
   Spark sees its size and can split the partition of a digest that a third
   of all rows share.

A batch has a folder of its own and counts once its writer has committed it;
runs at the same time don't touch each other's files, and a digest that two
of them count stands twice with one number. :func:`TokenCountCache.compact`
merges batches.

Cases: a null text is empty and has no tokens. Rows are counted one by one:
repeated rows and ids, null ids and ties each keep their row. Texts of any
length are encoded whole. An empty table gives no rows and no batch. Other
columns are kept as they are; those named like a result column are replaced.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clasp.llm.common import arrow_map, cut, free_prefix, texts_as_bytes

RESULT = ("n_bytes", "n_tokens", "over_limit")


def as_is(text: Column) -> Column:
    """Normalised content for tokenizers that tell any two texts apart."""
    return F.coalesce(text.cast("string"), F.lit(""))


@dataclass(frozen=True)
class Counter:
    """A tokenizer file and how texts are normalised before it.

    ``normalise`` must make texts equal only if the tokenizer counts them
    alike; ``rule`` names it in the digest.
    """
    path: str
    normalise: Callable[[Column], Column] = as_is
    rule: str = "as-is"

    @property
    def digest(self) -> str:
        library = __import__("sentencepiece" if self.path.endswith(".model") else "tokenizers")
        with open(self.path, "rb") as f:
            content = hashlib.file_digest(f, "sha256").hexdigest()
        return hashlib.sha256(f"{library.__name__} {library.__version__} {self.rule} {content}".encode()).hexdigest()

    def load(self) -> Callable[[list[str]], list[int]]:
        """A function from whole texts to token counts, without begin, end or
        added special tokens."""
        if self.path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=self.path)
            return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker a core already
        from tokenizers import Tokenizer
        model = Tokenizer.from_file(self.path)
        model.no_truncation()
        model.no_padding()
        return lambda texts: [len(e.ids) for e in model.encode_batch_fast(texts, add_special_tokens=False)]


@dataclass(frozen=True)
class TokenCountCache:
    """Stored counts under ``root``, a folder that all executors share."""
    root: str

    def _folder(self, tokenizer: str) -> str:
        return f"{self.root}/tokenizer={tokenizer}"

    def batches(self, spark: SparkSession, tokenizer: str) -> list[str]:
        """Folders of the committed batches: one per run that met new texts."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self._folder(tokenizer)}/batch=*/_SUCCESS")
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return sorted(s.getPath().getParent().toString() for s in found)

    def counts(self, spark: SparkSession, tokenizer: str) -> DataFrame:
        """(content, n_tokens) of all committed batches; a content may repeat."""
        schema = "content binary, n_tokens long"
        paths = self.batches(spark, tokenizer)
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def append(self, counts: DataFrame, tokenizer: str) -> DataFrame:
        """Store a batch and read it back."""
        path = f"{self._folder(tokenizer)}/batch={uuid.uuid4().hex}"
        counts.select("content", "n_tokens").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
        return counts.sparkSession.read.schema("content binary, n_tokens long").parquet(path)

    def compact(self, spark: SparkSession, tokenizer: str) -> None:
        """One batch with each content once in place of all present ones.
        Readers that run meanwhile may have to start again."""
        old = self.batches(spark, tokenizer)
        if len(old) < 2:
            return
        self.append(self.counts(spark, tokenizer).groupBy("content").agg(F.max("n_tokens").alias("n_tokens")), tokenizer)
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, old):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _encoded(texts: DataFrame, counter: Counter) -> DataFrame:
    """(content, n_tokens) of (content, text) rows."""
    loaded: list = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not loaded:
            loaded.append(counter.load())
        words = [t.decode() for t in texts_as_bytes(batch.column(1))]
        return pa.record_batch([batch.column(0), pa.array(loaded[0](words), pa.int64())], ["content", "n_tokens"])
    return arrow_map(texts, run, "content binary, n_tokens long", step=100)


def fill(docs: DataFrame, cache: TokenCountCache, counter: Counter, text_col: str = "text") -> DataFrame:
    """Counts of every distinct content of ``docs`` as a written table
    (content, n_tokens), after the misses were encoded and appended."""
    spark, version = docs.sparkSession, counter.digest
    text = counter.normalise(F.col(text_col))
    keyed = docs.select(F.unhex(F.sha2(text, 256)).alias("content"), text.alias("text"))
    # one text of each content, chosen in every task before the shuffle
    texts = keyed.groupBy("content").agg(F.first("text").alias("text"))
    if not cache.batches(spark, version):  # nothing stored: every content is a miss
        return cache.append(_encoded(texts, counter), version)
    stored = cache.counts(spark, version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    known = cut(keyed.select("content").distinct().join(stored, "content", "left"), "token-counts")
    misses = cut(known.where("n_tokens IS NULL").select("content"), "token-count-misses")
    if misses.isEmpty():
        return known
    new = cache.append(_encoded(texts.join(misses, "content", "left_semi"), counter), version)
    return known.where("n_tokens IS NOT NULL").unionByName(new)


def token_counts(docs: DataFrame, cache: TokenCountCache, counter: Counter, limit: int = 4096,
                 text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (of the text as UTF-8), ``n_tokens`` and
    ``over_limit`` (more than ``limit`` tokens)."""
    counts = fill(docs, cache, counter, text_col)
    own = free_prefix(docs, "_tokens")
    names = [c for c in docs.columns if c.lower() not in RESULT]
    rows = docs.select(*names, F.octet_length(as_is(F.col(text_col))).cast("long").alias("n_bytes"),
                       F.unhex(F.sha2(counter.normalise(F.col(text_col)), 256)).alias(own))
    counts = counts.select(F.col("content").alias(own), "n_tokens")
    return rows.join(counts, own).select(*names, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
