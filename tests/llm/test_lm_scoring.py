"""Stupid backoff against plain counting."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from clasp.llm import lm_scoring
from clasp.llm.lm_scoring import ALPHA, ORDER, scores

SCHEMA = "doc_id long, text string, score string, n int, k1 int"


def plain(texts, corpus=None, order=ORDER, alpha=ALPHA):
    """By counting; without a corpus, each text by the counts of the others."""
    split = lambda t: (t or "").lower().split()
    grams = lambda w: Counter(tuple(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total, words = Counter(), 0
    for t in texts if corpus is None else corpus:
        total.update(grams(split(t)))
        words += len(split(t))
    out = []
    for t in texts:
        w, s = split(t), 0.0
        held, n = (grams(w), words - len(w)) if corpus is None else (Counter(), words)
        c = lambda *g: total[g] - held[g]
        for i in range(len(w)):
            top = min(order, i + 1)
            for size in range(top, 0, -1):
                g = w[i - size + 1:i + 1]
                if size == 1 or c(*g):
                    s += (top - size) * math.log(alpha) + (math.log(c(*g) / c(*g[:-1])) if size > 1 else math.log(max(c(*g), 1) / max(n, 1)))
                    break
        out.append((len(w), s))
    return out


def corpus(seed, n=60):
    r = random.Random(seed)
    texts = [" ".join(r.choice(["the", "The", "of"]) if r.random() < .4 else f"w{r.randint(0, 200)}" for _ in range(r.randint(1, 60)))
             for _ in range(n)]
    return texts + [None, "", " ", "one", texts[0], texts[0], "of the " * 5000]


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], t, None, 1, 2) for i, t in enumerate(texts)], SCHEMA)


def check(spark, texts, other=None, **kw):
    more = {} if other is None else {"corpus": frame(spark, other).repartition(2)}
    got = {r.doc_id: r for r in scores(frame(spark, texts).repartition(3), **more, **kw).collect()}
    want = plain(texts, other, kw.get("order", ORDER), kw.get("alpha", ALPHA))
    for i, (n, s) in enumerate(want):
        assert got[i].n_words == n and abs(got[i].score - s) < 1e-6
        assert got[i].mean is None if not n else abs(got[i].mean - s / n) < 1e-9
    return [got[i].score for i in range(len(texts))]


@pytest.mark.parametrize("options", [{}, {"common_share": 0.3, "order": 2}, {"common_share": 2.0, "block_words": 50, "bucket_ngrams": 100},
                                     {"order": 4, "alpha": 0.1, "block_words": 300}, {"order": 1}])
def test_own_corpus(spark, options):
    check(spark, corpus(1), **options)


@pytest.mark.parametrize("share", [0.05, 2.0])
def test_other_corpus(spark, share):
    check(spark, corpus(2), corpus(3, 30), common_share=share, block_words=200)


def test_alpha_decides(spark):
    """Unseen runs really back off: another alpha gives other scores."""
    one, two = check(spark, corpus(1), alpha=0.4), check(spark, corpus(1), alpha=0.2)
    assert sum(a > b for a, b in zip(one, two)) > 40


def test_junk_scores_below_prose(spark):
    r = random.Random(9)
    prose = ["the cat sat on the mat and the dog sat on the rug"[:r.randint(20, 49)] + f" {i}" for i in range(40)]
    junk = [" ".join(f"{r.random():.9f}" for _ in range(10)) for _ in range(5)]
    got = [x.mean for x in sorted(scores(frame(spark, prose + junk)).collect(), key=lambda x: x.doc_id)]
    assert max(got[40:]) < min(got[:40])


def test_repeated_rows_null_ids_and_empty_tables(spark):
    texts = ["a b a", "a b a", "a b a", "b a", None]
    got = sorted((r.n_words, round(r.score, 9)) for r in scores(frame(spark, texts, [1, 1, None, None, None])).collect())
    assert got == sorted((n, round(s, 9)) for n, s in plain(texts))
    none = frame(spark, [])
    assert scores(none).count() == 0
    assert [r.score for r in scores(frame(spark, ["x"]), none).collect()] == [0.0]
    words = spark.createDataFrame([("id one", "a b"), (None, "b a b")], "doc_id string, text string")
    assert sorted((str(r.doc_id), r.n_words) for r in scores(words).collect()) == [("None", 3), ("id one", 2)]


def test_query_equals_sql(spark):
    import duckdb
    from clasp.llm.queries import LLM_ORACLE, LLM_REGISTRY
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    want = {x[0]: x[1:] for x in con.execute(LLM_ORACLE["op5_lm_scoring"]).fetchall()}
    got = LLM_REGISTRY["op5_lm_scoring"](spark, d).collect()
    assert len(got) == len(want)
    for x in got:
        assert want[x.doc_id] == pytest.approx((x.n_words, x.score, x.mean), abs=2e-6)


def test_common_runs_are_those_of_the_table(monkeypatch):
    """Only runs of common words are looked up, and none of them is missed."""
    r = np.random.default_rng(3)
    hashes = lm_scoring.mixed(np.sort(r.integers(0, 1 << 48, 400).astype(np.uint64)))
    words, sizes = r.zipf(1.3, 5000) % 400, np.array([0, 7, 1, 2, 2990, 2000])
    looked, plainly = [], lm_scoring._in
    for n in (1, 2, 3):
        last, _ = lm_scoring.ends(sizes, n)
        tables = [np.unique(lm_scoring.run_hashes(hashes[words], lm_scoring.ends(sizes, m)[0], m), return_counts=True) for m in (1, 2, 3)]
        table = np.unique(np.concatenate([h[k >= 40] for h, k in tables]))
        monkeypatch.setattr(lm_scoring, "_in", plainly)
        want = plainly(lm_scoring.run_hashes(hashes[words], last, n), table)
        monkeypatch.setattr(lm_scoring, "_in", lambda v, t: looked.append(len(v)) or plainly(v, t))
        got = lm_scoring.common_runs(hashes, words, last, n, table)
        assert got.tolist() == want.tolist() and want.any()
        assert sum(looked) < len(last)
        looked.clear()
