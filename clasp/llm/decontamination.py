"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet at shared seeds: runs of ``min_match``
equal tokens. For each pair of a document and an item that could reach the
threshold, the longest non-overlapping matches are marked again and again,
longest first, until none of ``min_match`` tokens is left (running
Karp-Rabin: seeds on one diagonal are one match). The share of the item's
tokens under marked tiles is its coverage, wherever in the document the
tiles lie, so a passage with its parts in another order is caught.

The benchmark is the small side. It is read in blocks of at most
``block_tokens`` tokens, so what a task is sent is bounded; each block is
one pass over all documents. A document is worked on alone, in its own task:
nothing is shuffled and no group of documents is ever gathered.
"""

from __future__ import annotations

import heapq
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clasp.llm.common import arrow_map

TOKEN = re.compile(r"[^\W_]+")
MIN_MATCH = 4
THRESHOLD = 0.6


def tokens(text: str | None) -> list[str]:
    """Runs of letters and digits, lower-cased; punctuation is no token."""
    return TOKEN.findall(text.lower()) if text else []


def tiles(hits: list[tuple[int, int]], min_match: int) -> list[tuple[int, int, int]]:
    """Seed hits ``(item position, document position)`` -> marked tiles
    ``(item position, document position, length)``: longest first, ties to
    the smaller item and then document position."""
    runs: dict[int, list[list[int]]] = {}
    for i, d in sorted(hits):
        line = runs.setdefault(d - i, [])
        if line and line[-1][0] + line[-1][1] - min_match + 1 == i:
            line[-1][1] += 1
        else:
            line.append([i, min_match])
    heap = [(-n, i, i + diagonal) for diagonal, line in runs.items() for i, n in line]
    heapq.heapify(heap)
    used_item, used_doc, out = set(), set(), []
    while heap:
        n, i, d = heapq.heappop(heap)
        n, free = -n, []
        for k in range(n):  # pieces that no tile covers yet
            if i + k in used_item or d + k in used_doc:
                continue
            if free and free[-1][0] + free[-1][1] == k:
                free[-1][1] += 1
            else:
                free.append([k, 1])
        if free == [[0, n]]:
            out.append((i, d, n))
            used_item.update(range(i, i + n))
            used_doc.update(range(d, d + n))
        else:
            for k, m in free:
                if m >= min_match:
                    heapq.heappush(heap, (-m, i + k, d + k))
    return out


class Block:
    """Seeds of some benchmark items."""

    def __init__(self, items: list[tuple[int, list[str]]], min_match: int, threshold: float):
        self.threshold, self.min_match = threshold, min_match
        self.ids = [i for i, _ in items]
        self.sizes = np.array([len(t) for _, t in items])
        self.vocabulary: dict[str, int] = {}
        self.seeds: dict[int, dict[tuple[int, ...], list[tuple[int, int]]]] = {}
        for n, (_, words) in enumerate(items):
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            size = min(min_match, len(codes))  # an item shorter than a seed must match whole
            table = self.seeds.setdefault(size, {})
            for p in range(len(codes) - size + 1):
                table.setdefault(tuple(codes[p:p + size]), []).append((n, p))

    def found(self, words: list[str]) -> list[tuple[int, float, int, int]]:
        """``(item id, coverage, tiles, longest tile)`` at the threshold or above."""
        get = self.vocabulary.get
        codes = np.array([get(w, -1) for w in words], dtype=np.int64)
        out = []
        for size, table in self.seeds.items():
            if len(codes) < size:
                continue
            known = np.concatenate(([0], np.cumsum(codes >= 0)))
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            places: dict[tuple[int, ...], list[int]] = {}
            for p in at.tolist():
                seed = tuple(codes[p:p + size].tolist())
                if seed in table:
                    places.setdefault(seed, []).append(p)
            if not places:
                continue
            seen: dict[int, int] = {}
            for seed in places:
                for n, _ in table[seed]:
                    seen[n] = seen.get(n, 0) + 1
            # each seed covers `size` tokens of its item at most
            hopeful = {n for n, k in seen.items() if k * size >= self.threshold * self.sizes[n]}
            hits: dict[int, list[tuple[int, int]]] = {}
            for seed, ps in places.items():
                for n, i in table[seed]:
                    if n in hopeful:
                        hits.setdefault(n, []).extend((i, p) for p in ps)
            for n, pairs in hits.items():
                marked = tiles(pairs, size)
                cover = sum(t[2] for t in marked) / float(self.sizes[n])
                if cover >= self.threshold:
                    out.append((self.ids[n], cover, len(marked), max(t[2] for t in marked)))
        return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str, min_match: int, threshold: float,
           block_tokens: int) -> list[Block]:
    out, held, size = [], [], 0
    for row in benchmark.select(id_col, text_col).toLocalIterator():
        words = tokens(row[1])
        if words:  # an item without tokens matches nothing
            held.append((row[0], words))
            size += len(words)
        if size >= block_tokens:
            out.append(Block(held, min_match, threshold))
            held, size = [], 0
    return [*out, Block(held, min_match, threshold)] if held else out


def contaminations(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD,
                   id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", block_tokens: int = 2_000_000) -> DataFrame:
    """Pairs of a document and an item that it covers: ``doc_id, item_id,
    coverage, n_tiles, longest``; documents that are not returned are clean.

    Whole texts are compared. Null and empty texts, on either side, match
    nothing. Repeated document rows each give their pairs, and so do
    repeated items. Other columns are ignored; an empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {id_type}, item_id {item_type}, coverage double, n_tiles long, longest long"
    spark = docs.sparkSession

    def one(block: Block) -> DataFrame:
        sent = spark.sparkContext.broadcast(block)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [(d, *hit) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                    for hit in sent.value.found(tokens(t))]
            return pa.RecordBatch.from_pylist(
                [dict(zip(("doc_id", "item_id", "coverage", "n_tiles", "longest"), r)) for r in rows],
                schema=pa.schema([("doc_id", batch.schema.field("doc_id").type), ("item_id", item_kind),
                                  ("coverage", pa.float64()), ("n_tiles", pa.int64()), ("longest", pa.int64())]))
        return arrow_map(given, run, schema)

    item_kind = pa.int64() if item_type == "bigint" else pa.int32() if item_type == "int" else pa.string()
    parts = [one(b) for b in blocks(benchmark, item_col, item_text_col, min_match, threshold, block_tokens)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD,
                    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                    block_tokens: int = 2_000_000) -> DataFrame:
    """``docs`` without the rows that cover an item; all columns kept."""
    spark = docs.sparkSession
    out, names = docs, docs.columns
    for block in blocks(benchmark, item_col, item_text_col, min_match, threshold, block_tokens):
        sent = spark.sparkContext.broadcast(block)

        def run(batch: pa.RecordBatch, sent=sent) -> pa.RecordBatch:
            keep = [not sent.value.found(tokens(t)) for t in batch.column(names.index(text_col)).to_pylist()]
            return batch.filter(pa.array(keep, pa.bool_()))
        out = arrow_map(out, run, out.schema)
    return out
