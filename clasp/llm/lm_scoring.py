"""Stupid-backoff language-model scores as joins of count tables.

The score of a text is the sum of ``ln S`` over its words. With ``w`` a word,
``g`` the longest run of up to ``order`` words that ends with it and that the
counts know, and ``c`` their number,

    S = alpha^s c(g) / c(g without its last word)    g of two words or more
    S = alpha^s max(c(w), 1) / N                     no longer run is known

where ``s`` is how many words ``g`` is shorter than the run that order and
text allow, and ``N`` the number of words counted. By default counts are over
the other rows of the table: what a text holds itself is taken off, so it
can't vouch for itself and unseen runs really back off. With a ``corpus`` the
counts are its own.

Texts are split and hashed once, into a table of blocks (ids, lengths and
word hashes of some documents). For each order, the distinct n-grams of every
document are dealt by n-gram hash to buckets; a bucket is a hash partition of
the count table together with the rows that ask for it, and joins the two by
one sort. Counts above zero go back to their blocks, where they are summed
per document. An n-gram travels as a few bytes of a packed column, not as a
row, and orders go one after another, so that little lies on disk at a time.

N-grams that a good part of all documents share would make one bucket grow
with the table. They are found in a sample of blocks; their exact counts over
all blocks come from one aggregate reduced in every task, and as there can be
only few of them (words of a document / share) the counts are sent to every
task. The sample only routes: results don't depend on it.

Hashes of 48 bits stand for words and, within a bucket, for n-grams, without a
check: of 100 million words about eighteen pairs, and of buckets of a million
n-grams one in five hundred, can be expected to hold a pair that shares its
hash and so adds its counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clasp.llm.common import cut, texts_as_bytes
from clasp.llm.substrings import joined, mixed

ALPHA, ORDER = 0.4, 3
MEMO_WORDS = 400_000
BLOCK_WORDS, BLOCK_ROWS = 1 << 18, 1 << 14
BUCKET_NGRAMS = 1_000_000
SAMPLE_BLOCKS = 32


class Hashes(dict):
    """48-bit hashes of words, at most ``MEMO_WORDS`` kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word) >> 16
        return out


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in as few bytes each as the largest needs, the
    lowest bytes of all first: what compresses well lies together."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in range(1, 9) if top < 1 << (8 * w))
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<i8")


def six_bytes(h: np.ndarray) -> np.ndarray:
    """The 48 lower bits of each, as rows of bytes."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def rising(values: np.ndarray) -> bytes:
    """Numbers in ascending order, by their steps."""
    return packed(np.diff(values, prepend=0))


def blocks(docs: DataFrame, id_col: str, text_col: str, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``block, ids, sizes, hashes, words``: neighbouring documents, A-Z in
    lower case, as numbers into the block's distinct word hashes; a block ends
    once it holds ``block_words``."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, task, made = Hashes(), TaskContext.get().partitionId(), 0
        ids, words, held = [], [], 0

        def block() -> pa.RecordBatch:
            every = pa.concat_arrays(ids)
            sizes = pa.array([len(w) for w in words], pa.int32())
            ends = pa.array([0, len(words)], pa.int32())
            hashes, numbers = np.unique(np.concatenate(words), return_inverse=True)
            return pa.record_batch([pa.array([(task << 32) + made]), pa.ListArray.from_arrays(ends, every), pa.ListArray.from_arrays(ends, sizes),
                                    pa.array([six_bytes(hashes).tobytes()], pa.binary()), pa.array([packed(numbers)], pa.binary())],
                                   ["block", "ids", "sizes", "hashes", "words"])
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                start = 0
                for i, text in enumerate(texts_as_bytes(part.column(1))):
                    split = text.lower().split()
                    found = np.fromiter(map(memo.__getitem__, split), dtype=np.uint64, count=len(split))
                    words.append(found)
                    held += len(found)
                    if held >= block_words or len(words) >= BLOCK_ROWS:
                        ids.append(part.column(0).slice(start, i + 1 - start))
                        yield block()
                        ids, words, held, made, start = [], [], 0, made + 1, i + 1
                ids.append(part.column(0).slice(start))
        if words:
            yield block()
    return docs.select(id_col, text_col).mapInArrow(run, f"block long, ids array<{id_type}>, sizes array<int>, hashes binary, words binary")


TEXTS = ("block", "sizes", "hashes", "words")


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(block, sizes, word hashes, word numbers)`` of each row."""
    at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    for block, sizes, hashes, words in zip(at["block"].to_pylist(), at["sizes"], at["hashes"], at["words"]):
        yield block, np.array(sizes.values, dtype=np.int64), mixed(from_six(hashes.as_py())), unpacked(words.as_py())


def ends(sizes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the last words of all runs of ``n`` words inside one
    document, and their document's number."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    last = np.arange(min(n - 1, len(doc)), len(doc))
    inside = last[doc[last] == doc[last - n + 1]]
    return inside, doc[inside]


def run_hashes(words: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words that end at ``last``."""
    h, size = words, 1
    while size < n:
        h, size = joined(h, size, words, 1), size + 1
    return mixed(h[last - n + 1]) if n > 1 else h[last]


def numbered(words: np.ndarray, last: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, run) pairs in an order of their own, by the block's
    word numbers alone: which run is the first of each, their occurrences, and
    of every run the number of its pair."""
    base = int(words.max(initial=0)) + 1
    if base ** n * (int(doc.max(initial=0)) + 1) < 1 << 63:
        key = doc.copy()
        for back in range(n - 1, -1, -1):
            key = key * base + words[last - back]
        order = np.argsort(key)
        key = key[order]
        new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, dtype=bool)
    else:
        h = run_hashes(words.astype(np.uint64), last, n)
        order = np.lexsort((h, doc))
        h, d = h[order], doc[order]
        new = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])) if len(h) else np.zeros(0, dtype=bool)
    starts = np.flatnonzero(new)
    pair = np.empty(len(order), dtype=np.int64)
    pair[order] = np.cumsum(new) - 1
    return order[starts], np.diff(np.append(starts, len(order))), pair


def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted table."""
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def common_runs(hashes: np.ndarray, words: np.ndarray, last: np.ndarray, n: int, table: np.ndarray) -> np.ndarray:
    """Which of the runs of ``n`` words that end at ``last`` are in the table
    of common n-grams. Every word of a common n-gram is common itself, so only
    runs of common words are looked up."""
    common = _in(hashes, table)
    held = common[words[last]]
    for back in range(1, n):
        held &= common[words[last - back]]
    if n > 1:
        at = np.flatnonzero(held)
        held[at] = _in(run_hashes(hashes[words], last[at], n), table)
    return held


def common_ngrams(corpus: DataFrame, order: int, share: float, sample_blocks: int = SAMPLE_BLOCKS) -> np.ndarray:
    """Hashes of n-grams in about ``share`` or more of the documents of a hash
    sample of blocks, and in 20 of them; met by some block as often."""
    rate = min(1.0, sample_blocks / max(1, corpus.count()))
    sample = corpus.where(F.pmod(F.xxhash64(F.lit("lm"), "block"), F.lit(1_000_000)) < int(rate * 1_000_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sizes, hashes, words in _texts(batch):
                for n in range(1, order + 1):
                    last, doc = ends(sizes, n)
                    first = numbered(words, last, doc, n)[0]
                    h, held = np.unique(run_hashes(hashes[words], last, n)[first], return_counts=True)
                    often = held >= max(2.0, share * len(sizes))
                    yield pa.record_batch([pa.array(h[often].view(np.int64)), pa.array(held[often])], ["h", "n"])
    docs = sample.agg(F.sum(F.size("sizes"))).first()[0] or 0
    rows = (sample.select(*TEXTS).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= max(20.0, share * docs)).select("h").collect())
    return np.unique(np.array([r.h for r in rows], dtype=np.int64).view(np.uint64))


def common_counts(corpus: DataFrame, order: int, common) -> tuple[np.ndarray, int]:
    """Exact counts of the common n-grams, and the number of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n_words = np.zeros(len(common.value), dtype=np.int64), 0
        for batch in batches:
            for _, sizes, hashes, words in _texts(batch):
                n_words += len(words)
                for n in range(1, order + 1):
                    last = ends(sizes, n)[0]
                    hit = run_hashes(hashes[words], last[common_runs(hashes, words, last, n, common.value)], n)
                    total += np.bincount(np.searchsorted(common.value, hit), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n_words))], ["at", "n"])
    out, n_words = np.zeros(len(common.value), dtype=np.int64), 0
    for r in corpus.select(*TEXTS).mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        if r["at"] < 0:
            n_words = r["n"]
        else:
            out[r["at"]] = r["n"]
    return out, n_words


DEALT = "bucket int, block long, h binary, pair binary, k binary"  # h is null where k is the count to give back
KEPT = np.uint64((1 << 48) - 1)


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """By the upper bits; a bucket compares the 48 lower ones."""
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def dealt(table: DataFrame, n: int, buckets: int, common, totals, asks: bool, own: bool) -> DataFrame:
    """Distinct n-grams of every document, packed by bucket: hash, number of
    the pair in its block, occurrences. Common ones have their counts already
    and only pass through, by a bucket of their block. Rows that only count
    (``asks`` false) are summed over their block, as block -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, sizes, hashes, words in _texts(batch):
                last, doc = ends(sizes, n)
                first, k, _ = numbered(words, last, doc if asks else np.zeros_like(doc), n)
                h = run_hashes(hashes[words], last, n)[first]
                often = common_runs(hashes, words, last[first], n, common.value)
                pair = np.flatnonzero(~often)
                bucket = bucket_of(h[pair], buckets)
                by = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
                pair, bucket = pair[by], bucket[by]
                edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(pair)] if len(pair) else [0]
                parts = [pair[i:j] for i, j in zip(edges, edges[1:])]
                six = six_bytes(h)
                rows = [(int(bucket[i]), six[p].tobytes(), rising(p), packed(k[p])) for i, p in zip(edges, parts)]
                if asks and often.any():
                    pair = np.flatnonzero(often)
                    count = totals.value[np.searchsorted(common.value, h[pair])] - (k[pair] if own else 0)
                    rows.append((int(mixed(np.array([block], dtype=np.uint64))[0] % np.uint64(buckets)), None, rising(pair), packed(count)))
                cols = list(zip(*rows)) or [(), (), (), ()]
                yield pa.record_batch([pa.array(cols[0], pa.int32()), pa.array([block if asks else -1] * len(rows), pa.int64()),
                                       *(pa.array(c, pa.binary()) for c in cols[1:])], ["bucket", "block", "h", "pair", "k"])
    return table.select(*TEXTS).mapInArrow(run, DEALT)


def counted(rows: DataFrame, n: int, own: bool) -> DataFrame:
    """Per block, the numbers of its pairs that the counts know, and their
    counts, ``own`` occurrences taken off."""
    def run(group: pa.Table) -> pa.Table:
        held = group.column("h").is_null()
        through = group.filter(held)
        group = group.filter(pc.invert(held))
        column = {c: group.column(c).to_pylist() for c in ("block", "h", "pair", "k")}
        pairs = [np.cumsum(unpacked(p)) for p in column["pair"]]
        block = np.repeat(np.array(column["block"], dtype=np.int64), np.array([len(p) for p in pairs], dtype=np.int64))
        pair = np.concatenate([*pairs, np.zeros(0, dtype=np.int64)])
        k = np.concatenate([*map(unpacked, column["k"]), np.zeros(0, dtype=np.int64)])
        h = from_six(b"".join(column["h"]))
        adds = k if own else np.where(block < 0, k, 0)
        order = np.argsort(h)
        starts = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1])) if len(h) else np.zeros(0, dtype=np.int64)
        total = np.add.reduceat(adds[order], starts) if len(h) else adds
        count = np.empty(len(h), dtype=np.int64)
        count[order] = np.repeat(total, np.diff(np.append(starts, len(h))))
        if own:
            count -= k
        # a block sends a bucket one row, its pairs in ascending order
        known = np.flatnonzero((count > 0) & (block >= 0))
        edges = [0, *(np.flatnonzero(np.diff(block[known])) + 1).tolist(), len(known)] if len(known) else [0]
        parts = [known[i:j] for i, j in zip(edges, edges[1:])]
        at = [int(block[p[0]]) for p in parts] + through.column("block").to_pylist()
        return pa.table({"block": pa.array(at, pa.int64()), "n": pa.array([n] * len(at), pa.int32()),
                         "pair": pa.array([rising(pair[p]) for p in parts] + through.column("pair").to_pylist(), pa.binary()),
                         "count": pa.array([packed(count[p]) for p in parts] + through.column("k").to_pylist(), pa.binary())})
    return rows.groupBy("bucket").applyInArrow(run, "block long, n int, pair binary, count binary")


def text_scores(sizes: np.ndarray, words: np.ndarray, counts, order: int, alpha: float, n_words: np.ndarray) -> np.ndarray:
    """Scores of the documents of a block of word numbers. ``counts(n,
    pairs)`` gives the count of each distinct pair; ``n_words`` the words
    counted for each document."""
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # in the document
    known = []
    for n in range(1, order + 1):
        last, doc = ends(sizes, n)
        first, _, pair = numbered(words, last, doc, n)
        c = np.zeros(len(words), dtype=np.int64)
        c[last] = counts(n, len(first))[pair]
        known.append(c)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    out = np.log(np.maximum(known[0], 1)) - np.log(n_words[doc])
    used = np.ones(len(words), dtype=np.int64)
    for n in range(2, order + 1):
        has = np.flatnonzero(known[n - 1] > 0)
        out[has] = np.log(known[n - 1][has]) - np.log(known[n - 2][has - 1])
        used[has] = n
    out += math.log(alpha) * (np.minimum(order, place + 1) - used)
    return np.bincount(doc, weights=out, minlength=len(sizes))


def scores(docs: DataFrame, corpus: DataFrame | None = None, alpha: float = ALPHA, order: int = ORDER, id_col: str = "doc_id",
           text_col: str = "text", common_share: float = 0.005, block_words: int = BLOCK_WORDS,
           bucket_ngrams: int = BUCKET_NGRAMS) -> DataFrame:
    """``doc_id, n_words, score, mean``, one row per input row.

    ``score`` is a natural logarithm, 0 for a text without words (null,
    empty); ``mean`` is per word, null without words. Every row counts, so a
    repeated row knows its copies. A word that no counted row has counts as
    if one had it once; no counted words at all count as one. Null and
    repeated ids each keep their row. Other columns are ignored; an empty
    table gives no rows. ``block_words`` and ``bucket_ngrams`` set how much a
    task holds at a time.
    """
    spark, own = docs.sparkSession, corpus is None
    given = cut(blocks(docs, id_col, text_col, block_words), "lm-blocks", compression="zstd")
    learned = given if own else cut(blocks(corpus, id_col, text_col, block_words), "lm-corpus", compression="zstd")
    sent = spark.sparkContext.broadcast(common_ngrams(learned, order, common_share))
    counts, n_words = common_counts(learned, order, sent)
    totals = spark.sparkContext.broadcast(counts)
    buckets = max(1, math.ceil(n_words / bucket_ngrams), spark.sparkContext.defaultParallelism)
    found = []
    for n in range(1, order + 1):
        rows = dealt(given, n, buckets, sent, totals, True, own)
        rows = rows if own else rows.unionByName(dealt(learned, n, buckets, sent, totals, False, own))
        found.append(cut(counted(rows, n, own), f"lm-counts-{n}", compression="zstd"))
    back = found[0]
    for more in found[1:]:
        back = back.unionByName(more)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([[], [], []], schema=kinds)
        batch = left.combine_chunks().to_batches()[0]
        at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        sizes, words = np.array(at["sizes"][0].values, dtype=np.int64), unpacked(at["words"][0].as_py())
        parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for n, pair, count in zip(*(right.column(c).to_pylist() for c in ("n", "pair", "count"))):
            parts.setdefault(n, []).append((np.cumsum(unpacked(pair)), unpacked(count)))

        def known(n: int, pairs: int) -> np.ndarray:
            out = np.zeros(pairs, dtype=np.int64)
            for pair, count in parts.get(n, ()):
                out[pair] = count
            return out
        others = np.maximum(n_words - (sizes if own else 0), 1) + np.zeros(len(sizes), dtype=np.int64)
        return pa.table([at["ids"].flatten(), pa.array(sizes, pa.int64()),
                         pa.array(text_scores(sizes, words, known, order, alpha, others))], schema=kinds)
    kinds = pa.schema([("doc_id", given.limit(0).toArrow().schema.field("ids").type.value_type), ("n_words", pa.int64()), ("score", pa.float64())])
    texts = given.select("block", "ids", "sizes", "words")  # word hashes have done their work
    out = texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(run, f"doc_id {id_type}, n_words long, score double")
    return out.select("doc_id", "n_words", "score", F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")).alias("mean"))


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w FROM documents),
o AS (SELECT r, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS p FROM d),
g AS (SELECT r, p, w, lag(w) OVER x AS v, lag(w, 2) OVER x AS u FROM o WINDOW x AS (PARTITION BY r ORDER BY p)),
c1 AS (SELECT *, sum(k) OVER (PARTITION BY w) - k AS n FROM (SELECT r, w, count(*) AS k FROM g GROUP BY r, w)),
c2 AS (SELECT *, sum(k) OVER (PARTITION BY v, w) - k AS n FROM (SELECT r, v, w, count(*) AS k FROM g WHERE v IS NOT NULL GROUP BY r, v, w)),
c3 AS (SELECT *, sum(k) OVER (PARTITION BY u, v, w) - k AS n
       FROM (SELECT r, u, v, w, count(*) AS k FROM g WHERE u IS NOT NULL GROUP BY r, u, v, w)),
e AS (SELECT g.r, p, c1.n AS n1, c2.n AS n2, c3.n AS n3, m1.n AS m1, m2.n AS m2,
             greatest((SELECT count(*) FROM o) - (SELECT len(d.w) FROM d WHERE d.r = g.r), 1) AS total
      FROM g JOIN c1 USING (r, w) LEFT JOIN c2 ON c2.r = g.r AND c2.v = g.v AND c2.w = g.w
      LEFT JOIN c3 ON c3.r = g.r AND c3.u = g.u AND c3.v = g.v AND c3.w = g.w
      LEFT JOIN c1 m1 ON m1.r = g.r AND m1.w = g.v LEFT JOIN c2 m2 ON m2.r = g.r AND m2.v = g.u AND m2.w = g.v),
s AS (SELECT r, sum(CASE WHEN n3 > 0 THEN ln(n3 / m2) WHEN n2 > 0 THEN (least(p, 3) - 2) * ln({ALPHA}) + ln(n2 / m1)
                         ELSE (least(p, 3) - 1) * ln({ALPHA}) + ln(greatest(n1, 1) / total) END) AS score FROM e GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, round(coalesce(s.score, 0.0), 6) AS score,
       CASE WHEN len(d.w) > 0 THEN round(s.score / len(d.w), 6) END AS mean
FROM d LEFT JOIN s USING (r)
"""
