"""Substring de-duplication by level-wise doubling.

A window of ``window`` words is repeated if its words also start at any
other place. It can only be repeated if the shorter windows inside it are,
so lengths grow from a quarter over a half to the whole window, and each
level looks only at what was repeated at the level before:

* quarter length: of the short windows in each full window only the one
  with the smallest hash is kept (the leftmost, if equal). Both copies of a
  repeated full window choose the same one, so this loses none while a few
  hundredths of all positions are shuffled;
* half length: surviving short windows extended to twice their length,
  to the right or, near the end of the full window, to the left;
* full length: full windows around survivors, compared by 96 bits.

Counts are partial aggregates before any shuffle, and joins back to the
positions are plain equi-joins, so a passage that a third of all documents
share is neither gathered in a task nor paired with itself. Documents whose
word sequences are equal need no windows at all beyond one copy's.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clasp.llm.common import arrow_map, cut, discard, texts_as_bytes

POS_BITS = 30  # positions share a 64-bit sort key with the hash of a window
MEMO_WORDS = 400_000


class WordHashes(dict):
    """16-byte hashes of words seen so far, at most ``MEMO_WORDS``."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= MEMO_WORDS:
            self.clear()
        out = self[word] = xxhash.xxh3_128_digest(word)
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        """(n, 2) unsigned 64-bit hashes."""
        return np.frombuffer(b"".join([self[w] for w in words]), dtype="<u8").reshape(-1, 2)


def levels(window: int) -> tuple[int, int]:
    return -(-window // 4), -(-window // 2)


def joined(left: np.ndarray, n_left: int, right: np.ndarray, n_right: int) -> np.ndarray:
    """Hashes of windows made of ``n_left`` words and the ``n_right`` after them."""
    n = len(right) - n_left
    base = np.uint64(pow(0x9E3779B97F4A7C15, n_right, 2**64))
    return left[:max(n, 0)] * base + right[n_left:]


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of ``length`` words, by doubling."""
    if len(words) < length:
        return np.empty(0, dtype=np.uint64)
    out, n, power, size = None, 0, words, 1
    while True:
        if length & size:
            out, n = (power, size) if out is None else (joined(out, n, power, size), n + size)
        if size * 2 > length:
            return out[:len(words) - length + 1]
        power, size = joined(power, size, power, size), size * 2


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def chosen(short: np.ndarray, span: int) -> np.ndarray:
    """Position of the smallest of each ``span`` neighbouring hashes, the
    leftmost if equal."""
    low = np.uint64((1 << POS_BITS) - 1)
    best = (short & ~low) | np.arange(len(short), dtype=np.uint64)
    size = 1
    while size * 2 <= span:
        best, size = np.minimum(best[:-size], best[size:]), size * 2
    if size < span:
        best = np.minimum(best[:len(best) - (span - size)], best[span - size:])
    return (best & low).astype(np.int64)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _anchors(window: int):
    quarter, half = levels(window)
    memo = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, digests, pos, short, right, left = [], [], [], [], [], []
        for text in texts_as_bytes(batch.column("text")):
            words = text.split()
            n_words.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            at = np.empty(0, dtype=np.int64)
            hs = hr = hl = at
            if len(words) >= window:
                h = memo.of(words)[:, 0]
                small = mixed(window_hashes(h, quarter))
                at = chosen(small, window - quarter + 1)
                at = at[np.append(True, at[1:] != at[:-1])]
                twice = mixed(window_hashes(h, half))
                hs = small[at].view(np.int64)
                # a start beyond either end is no window: its hash is that of none
                hr = np.where(at < len(twice), twice[np.minimum(at, len(twice) - 1)].view(np.int64), 0)
                back = at + quarter - half
                hl = np.where(back >= 0, twice[np.clip(back, 0, len(twice) - 1)].view(np.int64), 0)
            for to, x in zip((pos, short, right, left), (at, hs, hr, hl)):
                to.append(x)
        cols = [batch.column(c) for c in ("doc_id", "k1", "k2")]
        return pa.RecordBatch.from_arrays(
            [*cols, pa.array(n_words, pa.int64()), pa.array(digests, pa.string()),
             _lists(pos, pa.int32()), _lists(short, pa.int64()), _lists(right, pa.int64()), _lists(left, pa.int64())],
            names=["doc_id", "k1", "k2", "n_words", "digest", "pos", "short", "right", "left"])
    return run


def _full_windows(window: int):
    quarter, half = levels(window)
    memo = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        starts, first, second = [], [], []
        for text, live in zip(texts_as_bytes(batch.column("text")), batch.column("live").to_pylist()):
            h = memo.of(text.split())
            s = np.empty(0, dtype=np.int64)
            a = b = s
            if len(h) >= window:
                at = chosen(mixed(window_hashes(h[:, 0], quarter)), window - quarter + 1)
                code = at * 2 + (at - np.arange(len(at)) > window - half)
                s = np.flatnonzero(np.isin(code, np.array(live, dtype=np.int64)))
                a = mixed(window_hashes(h[:, 0], window))[s].view(np.int64)
                b = (mixed(window_hashes(h[:, 1], window))[s] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            starts.append(s), first.append(a), second.append(b)
        keep = [batch.column(c) for c in ("k1", "k2", "copied", "text")]
        return pa.RecordBatch.from_arrays(
            [*keep, _lists(starts, pa.int32()), _lists(first, pa.int64()), _lists(second, pa.int32())],
            names=["k1", "k2", "copied", "text", "start", "ha", "hb"])
    return run


def _removed(window: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        gone, digests = [], []
        for text, starts in zip(texts_as_bytes(batch.column("text")), batch.column("starts").to_pylist()):
            words = text.split()
            edge = np.zeros(len(words) + window + 1, dtype=np.int64)
            s = np.array(starts, dtype=np.int64)
            np.add.at(edge, s, 1)
            np.add.at(edge, s + window, -1)
            kept = np.cumsum(edge)[:len(words)] == 0
            gone.append(len(words) - int(kept.sum()))
            digests.append(hashlib.sha256(b" ".join([w for w, k in zip(words, kept.tolist()) if k])).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), pa.array(gone, pa.int64()), pa.array(digests, pa.string())],
            names=["k1", "k2", "gone", "kept"])
    return run


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Remove each word covered by a window that also starts elsewhere.

    Returns ``doc_id, n_words, n_removed, kept_sha256``, one row per input
    row: SHA-256 of the kept words joined by one space. Words are separated
    by ASCII white space and otherwise unchanged; null and empty texts have
    none. Rows that repeat (also with the same id, or a null id) are
    repeats of each other like any other text. A text shorter than the
    window is kept whole. Other columns are ignored; an empty table gives
    no rows.
    """
    quarter, half = levels(window)
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("k1"),
        F.xxhash64(F.col(id_col).cast("string"), F.coalesce(F.col(text_col), F.lit(""))).alias("k2"),
        F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    found = cut(arrow_map(
        keyed, _anchors(window),
        f"doc_id {id_type}, k1 long, k2 long, n_words long, digest string, pos array<int>, "
        "short array<long>, right array<long>, left array<long>"), "sub-anchors")
    info = cut(found.select("doc_id", "k1", "k2", "n_words", "digest"), "sub-rows")

    # quarter length
    short = found.select("k1", "k2", F.explode(F.arrays_zip("pos", "short", "right", "left")).alias("a")).select(
        "k1", "k2", "a.pos", "a.short", "a.right", "a.left")
    live = cut(short.join(_repeated(short, ["short"]), "short").drop("short"), "sub-quarter")
    discard(found)
    # half length: to the right (side 0) and to the left (side 1)
    twice = live.select("k1", "k2", F.explode(F.array(
        F.struct((F.col("pos") * 2).alias("code"), F.col("right").alias("h")),
        F.struct((F.col("pos") * 2 + 1).alias("code"), F.col("left").alias("h")))).alias("a")).select(
        "k1", "k2", "a.code", "a.h").where("h <> 0")
    # a document's own positions: at most twice its words
    candidates = (twice.join(_repeated(twice, ["h"]), "h").groupBy("k1", "k2")
                  .agg(F.collect_set("code").alias("live")))
    copies = cut(info.where(F.col("n_words") >= window).groupBy("digest")
                 .agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("k1", "k2")).alias("one"))
                 .where("_n > 1").drop("_n"), "sub-copies")
    copied = (info.select("k1", "k2", "digest").join(copies, "digest")
              .groupBy("k1", "k2").agg(F.max(F.struct("k1", "k2") == F.col("one")).alias("copied")))
    candidates = cut(candidates.join(copied, ["k1", "k2"], "left")
                     .where(F.coalesce("copied", F.lit(True)))
                     .withColumn("copied", F.col("copied").isNotNull()), "sub-half")
    discard(live)
    # full length
    windows = cut(arrow_map(
        keyed.select("k1", "k2", "text").join(candidates, ["k1", "k2"]).select("k1", "k2", "copied", "text", "live"),
        _full_windows(window),
        "k1 long, k2 long, copied boolean, text string, start array<int>, ha array<long>, hb array<int>"),
        "sub-windows")
    discard(candidates)
    each = windows.select("k1", "k2", "copied", F.explode(F.arrays_zip("start", "ha", "hb")).alias("a")).select(
        "k1", "k2", "copied", "a.start", "a.ha", "a.hb")
    marked = (each.where(~F.col("copied")).join(_repeated(each, ["ha", "hb"]), ["ha", "hb"])
              .groupBy("k1", "k2").agg(F.collect_set("start").alias("starts")))
    removed = cut(arrow_map(
        windows.where(~F.col("copied")).select("k1", "k2", "text").join(marked, ["k1", "k2"]),
        _removed(window), "k1 long, k2 long, gone long, kept string"), "sub-removed")
    discard(windows)
    whole = F.col("_copy").isNotNull()
    return (info.join(removed, ["k1", "k2"], "left")
            .join(copies.select(F.col("digest"), F.lit(True).alias("_copy")), "digest", "left")
            .select("doc_id", "n_words",
                    F.when(whole, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
                    F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "digest")).alias("kept_sha256")))
