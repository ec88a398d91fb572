"""Substring removal against brute force over all windows."""

import hashlib
import random
from collections import Counter

import pytest

from clasp.llm.substrings import chosen, levels, remove_repeats, window_hashes

SCHEMA = "doc_id long, text string, k1 string, digest int"


def brute(texts, w):
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(x[i:i + w]) for x in split for i in range(len(x) - w + 1))
    out = []
    for x in split:
        gone = set()
        for i in range(len(x) - w + 1):
            if seen[tuple(x[i:i + w])] > 1:
                gone.update(range(i, i + w))
        kept = b" ".join(q for i, q in enumerate(x) if i not in gone)
        out.append((len(x), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=40):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(6)] + ["É", "naïve", "x y"]
    shared = [[r.choice(vocab) for _ in range(r.randint(3, 60))] for _ in range(4)]
    out = []
    for _ in range(n):
        words = []
        for _ in range(r.randint(0, 4)):
            words += r.choice(shared) if r.random() < .5 else [r.choice(vocab) + str(r.randint(0, 99)) for _ in range(r.randint(1, 40))]
        out.append(r.choice([" ", "\n", " \t "]).join(words))
    return out + [None, "", " \n", out[0], out[0], out[1], "a " * 300, "long " + "b c " * 2000]


@pytest.mark.parametrize("w,seed", [(1, 1), (2, 2), (3, 3), (5, 4), (7, 5), (12, 6), (35, 7), (35, 8)])
def test_equals_brute_force(spark, w, seed):
    texts = corpus(seed)
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in remove_repeats(spark.createDataFrame(rows, SCHEMA), w).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, w)


def test_null_and_repeated_ids_and_empty(spark):
    t = " ".join(f"q{i}" for i in range(40))
    rows = [(None, t, None, None), (1, t, None, None), (1, t, None, None), (1, "only me", None, None), (None, None, None, None)]
    got = sorted((r.n_words, r.n_removed) for r in remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 0), (2, 0), (40, 40), (40, 40), (40, 40)]
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_window_holds_its_chosen_short_window():
    import numpy as np
    for w in range(1, 40):
        q, half = levels(w)
        h = np.random.default_rng(w).integers(0, 5, 120).astype("u8")
        at = chosen(window_hashes(h, q), w - q + 1)
        assert len(at) == len(h) - w + 1
        r = at - np.arange(len(at))
        assert (r >= 0).all() and (r <= w - q).all()
        assert (r[r > w - half] >= half - q).all()
