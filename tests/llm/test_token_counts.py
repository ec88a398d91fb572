"""Cached token counts against the tokenizer libraries."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clasp.llm import token_counts
from clasp.llm.queries import tokenizer_path
from clasp.llm.token_counts import Counter, TokenCountCache
from clasp.session import scratch_path

SCHEMA = "doc_id long, text string, n_tokens string, content string, _tokens int"
PIECES = tokenizer_path("piece_bpe_32k.model")


def plain(texts, path=PIECES):
    if path.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(model.encode(t or "")) for t in texts]
    model = Tokenizer.from_file(path)
    return [len(model.encode(t or "", add_special_tokens=False).ids) for t in texts]


def rows(seed=1, n=200):
    r = random.Random(seed)
    texts = [None, "", " ", "\n", "  two  spaces ", "<s>", "</s><unk>", "<0x0A>", "▁", "a▁b", "é日本\U0001f600", "\x00x", "w" * 30_000,
             "word " * 20_000, "<|endoftext|>", "naïve\r\n\ttab"]
    texts += [" ".join(r.choice(["ab", "Straße", "<", "7", "…", "xyzzy"]) for _ in range(r.randint(0, 30))) for _ in range(n)]
    texts += ["the same text again"] * n
    out = [(i, t, "n", "c", 9) for i, t in enumerate(texts)]
    return out + [(None, "no id", "n", "c", 9), out[3], out[3]]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def cache(spark):
    return TokenCountCache(scratch_path(spark, "t-token-counts"))


def results(df):
    return sorted(((x.doc_id, x.text, x.n_bytes, x.n_tokens, x.over_limit) for x in df.collect()), key=str)


def expected(data, path=PIECES, limit=4096):
    return sorted(((i, t, len((t or "").encode()), n, n > limit)
                   for (i, t, *_), n in zip(data, plain([x[1] for x in data], path))), key=str)


def stored(spark, c, counter):
    return c.counts(spark, counter.digest).collect()


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json"])
def test_equals_library(spark, name):
    path, data = tokenizer_path(name), rows()
    out = token_counts.token_counts(frame(spark, data), cache(spark), Counter(path), limit=1000)
    assert out.columns == ["doc_id", "text", "content", "_tokens", "n_bytes", "n_tokens", "over_limit"]
    assert results(out) == expected(data, path, 1000)


def test_only_distinct_misses_are_encoded_and_appended(spark):
    c, counter, first, second = cache(spark), Counter(PIECES), rows(1), rows(2, 50)
    assert results(token_counts.token_counts(frame(spark, first), c, counter)) == expected(first)
    one = {x[1] or "" for x in first}
    assert len(stored(spark, c, counter)) == len(one) and len(c.batches(spark, counter.digest)) == 1
    assert results(token_counts.token_counts(frame(spark, first), c, counter)) == expected(first)
    assert len(c.batches(spark, counter.digest)) == 1  # all were hits: nothing was encoded or appended
    both = first + second
    assert results(token_counts.token_counts(frame(spark, both), c, counter)) == expected(both)
    two = {x[1] or "" for x in both}
    newest = [spark.read.parquet(p).count() for p in c.batches(spark, counter.digest)]
    assert sorted(newest) == sorted([len(one), len(two - one)])
    c.compact(spark, counter.digest)
    assert len(c.batches(spark, counter.digest)) == 1 and len(stored(spark, c, counter)) == len(two)
    assert results(token_counts.token_counts(frame(spark, both), c, counter)) == expected(both)


def test_stored_counts_are_used_and_belong_to_one_tokenizer(spark):
    c, counter, data = cache(spark), Counter(PIECES), rows(1, 5)
    wrong = spark.createDataFrame([("no id",)], "t string").select(F.unhex(F.sha2("t", 256)).alias("content"), F.lit(99).cast("long").alias("n_tokens"))
    c.append(wrong, counter.digest)
    c.append(wrong, counter.digest)  # counted twice by two runs: rows of docs must not repeat
    got = token_counts.token_counts(frame(spark, data), c, counter).collect()
    assert len(got) == len(data) and {x.n_tokens for x in got if x.doc_id is None} == {99}
    other = Counter(tokenizer_path("word_bpe_49k.json"))
    assert results(token_counts.token_counts(frame(spark, data), c, other)) == expected(data, other.path)
    ruled = Counter(PIECES, lambda t: F.lower(token_counts.as_is(t)), "lower")
    assert ruled.digest != counter.digest and not c.batches(spark, ruled.digest)


def test_uncommitted_batches_do_not_count(spark):
    c, counter, data = cache(spark), Counter(PIECES), rows(1, 5)
    token_counts.token_counts(frame(spark, data), c, counter).count()
    path = spark._jvm.org.apache.hadoop.fs.Path(c.batches(spark, counter.digest)[0] + "/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    assert c.batches(spark, counter.digest) == []
    assert results(token_counts.token_counts(frame(spark, data), c, counter)) == expected(data)


def test_empty_table(spark):
    c, counter = cache(spark), Counter(PIECES)
    assert token_counts.token_counts(frame(spark, []), c, counter).count() == 0
    assert stored(spark, c, counter) == []


def test_few_misses_leave_texts_in_their_scan(spark):
    """Where few texts are new, no exchange carries the texts of the rest."""
    d, c, counter = scratch_path(spark, "t-token-docs"), cache(spark), Counter(PIECES)
    frame(spark, rows(1, 300)).write.parquet(d)
    docs = spark.read.parquet(d)
    token_counts.fill(docs.where("doc_id != 20"), c, counter)
    keyed = docs.select(F.unhex(F.sha2(token_counts.as_is(F.col("text")), 256)).alias("content"), "text")
    misses = token_counts.cut(keyed.join(c.counts(spark, counter.digest), "content", "left_anti").select("content").distinct(), "t")
    plan = keyed.groupBy("content").agg(F.first("text")).join(misses, "content", "left_semi")
    lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    at = [next(i for i, x in enumerate(lines) if w in x) for w in ("Exchange hashpartitioning", "BroadcastHashJoin")]
    assert at[0] < at[1]  # the join stands below the aggregate's exchange, in the scan


def test_query(spark):
    from clasp.llm.queries import LLM_REGISTRY
    d = "/root/testdata/sf0.01"
    docs = [(x.doc_id, x.text) for x in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, LLM_REGISTRY["op11_token_counts"](spark, d).collect()))
    assert got == sorted((i, len((t or "").encode()), n, n > 4096) for (i, t), n in zip(docs, plain([t for _, t in docs])))
