"""Language identification by words first, then shorter and shorter n-grams.

A known word scores its per-language log frequency. A word that no language
knows falls back to its character n-grams of the greatest length of which
any is known: their mean log frequency. A text's score per language is the
mean over its words; what a language lacks costs a fixed penalty.

The model is fitted on a bounded sample of labelled rows (a hash of the id
picks about ``rows_per_language`` of each language) and keeps a bounded
number of words and n-grams, an equal part from each language, so what is
broadcast has a fixed bound and a small language keeps its words.
Prediction is one pass over whole texts, without a shuffle.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clasp.llm.common import arrow_map

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")  # letters, and the marks that belong to them
UNKNOWN = "und"
LONGEST = 5  # characters of an n-gram
PENALTY = 6.5  # minus log10 of the frequency of what a language lacks
SURE_WORDS = 20  # words after which more of them add no certainty
MEMO_WORDS = 300_000


def held_out(id_col: str = "doc_id") -> Column:
    """The quarter of documents that no model learns from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def words(text: str | None) -> list[str]:
    return WORD.findall(unicodedata.normalize("NFC", text).lower()) if text else []


def grams(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


@dataclass
class Model:
    languages: list[str]
    tables: list[dict[str, list[float]]]  # words, then n-grams of 1..LONGEST characters: costs per language

    def cost(self, word: str) -> list[float] | None:
        """Minus log10 frequency per language; None if nothing of it is known."""
        known = self.tables[0].get(word)
        if known is not None:
            return known
        for n in range(LONGEST, 0, -1):
            hits = [h for g in grams(word, n) if (h := self.tables[n].get(g)) is not None]
            if hits:
                return [sum(c) / len(hits) for c in zip(*hits)]
        return None


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str, int] = {}
        self.costs = np.empty((MEMO_WORDS, max(1, len(model.languages))))

    def __call__(self, text: str | None) -> tuple[str, float]:
        """Language and its share of the likelihood, 0 to 1."""
        languages = self.model.languages
        counts = Counter(words(text))
        if not counts or not languages:
            return UNKNOWN, 0.0
        rows, known, total, n = [], [], np.zeros(len(languages)), 0
        for word, k in counts.items():
            row = self.rows.get(word)
            if row is None:
                row = len(self.rows)
                if row >= MEMO_WORDS:  # start anew, after what this text has used so far
                    total += self.costs[rows].T @ np.array(known, dtype=float)
                    rows, known, row = [], [], 0
                    self.rows.clear()
                cost = self.model.cost(word)
                self.costs[row] = PENALTY if cost is None else cost
                self.rows[word] = row
            rows.append(row)
            known.append(k)
            n += k
        total += self.costs[rows].T @ np.array(known, dtype=float)
        mean = total / n
        best = int(mean.argmin())
        share = np.exp(np.log(10) * (mean[best] - mean) * min(n, SURE_WORDS))
        return languages[best], float(1 / share.sum())


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows_per_language: int = 2_000, max_words: int = 60_000, max_grams: int = 20_000) -> Model:
    """Learn from rows with a text and a language that aren't held out.

    Row counts cover all labelled rows; the sample takes rows whose id hash
    lies below ``rows_per_language`` / count, so it is the same on every run.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col)).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col).cast("string")), F.lit(1_000_000)).alias("part"))
    rows = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one a language
    languages = sorted(rows)
    if not languages:
        return Model([], [{} for _ in range(LONGEST + 1)])
    limit = F.create_map(*[x for k in languages for x in (
        F.lit(k), F.lit(int(min(1.0, rows_per_language / rows[k]) * 1_000_000)))])
    sample = labelled.where(F.col("part") < limit[F.col("lang")]).select("lang", "text")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for word, k in Counter(words(text)).items():
                found[lang, 0, word] += k
                for n in range(1, LONGEST + 1):
                    for g in grams(word, n):
                        found[lang, n, g] += k
        cols = list(zip(*((*key, k) for key, k in found.items()))) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            cols, (pa.string(), pa.int32(), pa.string(), pa.int64()))], names=["lang", "kind", "item", "n"])

    counts = arrow_map(sample, count, "lang string, kind int, item string, n long", step=2000)
    counts = counts.groupBy("kind", "item", "lang").agg(F.sum("n").alias("n")).persist()
    totals = {(r.kind, r.lang): r.n for r in counts.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()}
    tables = []
    for kind in range(LONGEST + 1):
        share = (max_grams if kind else max_words) // len(languages)
        by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "item")
        top = (counts.where(F.col("kind") == kind).withColumn("rank", F.row_number().over(by_count)).groupBy("item")
               .agg(F.min("rank").alias("rank"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
               .where(F.col("rank") <= share).collect())
        tables.append({r["item"]: [float(-np.log10(r["by"][k] / totals[kind, k])) if k in r["by"] else PENALTY
                                   for k in languages] for r in top})
    counts.unpersist()
    return Model(languages, tables)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, one row per input row.

    ``und`` with score 0 if the text is null or has no letter, or nothing
    was learned. Only the text is read to predict. Other columns are
    ignored; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = Scorer(sent.value)
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                out = [score(t) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array([x[0] for x in out], pa.string()),
                     pa.array([x[1] for x in out], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return given.mapInArrow(run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")


def recognised(docs: DataFrame, model: Model, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is unknown or, at a share
    of the likelihood under ``min_score``, unsure; all columns kept."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        score = Scorer(sent.value)
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                out = [score(t) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array([x != UNKNOWN and s >= min_score for x, s in out], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
