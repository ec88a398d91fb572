"""Greedy string tiling against a plain one, and planted passages."""

import random

import pytest

from clasp.llm.decontamination import THRESHOLD, clean_documents, contaminations, tiles, tokens

DOCS = "doc_id long, text string, item_id string, coverage int"
ITEMS = "item_id long, text string, doc_id int"


def plain_tiles(item, doc, m):
    """Mark the longest unmarked match, again and again."""
    used_i, used_d, out = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n]
                       and i + n not in used_i and d + n not in used_d):
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < m:
            return out
        out.append((i, d, n))
        used_i.update(range(i, i + n))
        used_d.update(range(d, d + n))


@pytest.mark.parametrize("seed", range(30))
def test_tiles(seed):
    r = random.Random(seed)
    item = [r.choice("abc") for _ in range(r.randint(1, 25))]
    doc = [r.choice("abcd") for _ in range(r.randint(1, 60))]
    m = r.randint(1, 4)
    hits = [(i, d) for i in range(len(item) - m + 1) for d in range(len(doc) - m + 1) if item[i:i + m] == doc[d:d + m]]
    assert tiles(hits, m) == plain_tiles(item, doc, m)


def passages(seed=1):
    r = random.Random(seed)
    words = [f"v{i}" for i in range(500)]
    return r, words, [(k, " ".join(r.choice(words) for _ in range(r.randint(15, 50))), 0) for k in range(30)]


@pytest.mark.parametrize("block_tokens", [100, 2_000_000])
def test_planted(spark, block_tokens):
    r, words, items = passages()
    other = lambda n: " ".join("z" + r.choice(words) for _ in range(n))
    rows, leaks = [], set()
    for k, t, _ in items:
        w = t.split()
        third = len(w) // 3
        shuffled = " ".join(w[2 * third:] + ["and"] + w[:third] + ["or"] + w[third:2 * third])
        for text, leak in ((other(50) + " " + t.upper() + "! " + other(20), True), (other(10) + "\n" + shuffled, True),
                           (other(100), False), (" ".join(w[:third]), False)):
            if leak:
                leaks.add((len(rows), k))
            rows.append((len(rows), text, "x", 1))
    rows += [(900, None, None, None), (901, "", None, None), (902, other(20_000) + " " + items[0][1], None, None)]
    leaks.add((902, 0))
    rows.append(rows[0])
    df = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame(items + [(99, None, 0), (98, "", 0), (97, "...", 0)], ITEMS)
    out = contaminations(df, bench, block_tokens=block_tokens).collect()
    assert {(x.doc_id, x.item_id) for x in out} == leaks
    assert all(THRESHOLD <= x.coverage <= 1 and x.longest >= 4 for x in out)
    assert len(out) == len(leaks) + 1  # the repeated row
    kept = clean_documents(df, bench, block_tokens=block_tokens)
    assert kept.columns == df.columns
    assert {x.doc_id for x in kept.collect()} == {x[0] for x in rows} - {d for d, _ in leaks}


def test_short_items_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "two words", 0), (2, "One", 0)], ITEMS)
    df = spark.createDataFrame([(1, "these two, words", "x", 1), (2, "two other words", "x", 1), (3, "one", "x", 1)], DOCS)
    assert {(x.doc_id, x.item_id) for x in contaminations(df, items).collect()} == {(1, 1), (3, 2)}
    none = spark.createDataFrame([], ITEMS)
    assert contaminations(df, none).count() == 0 and clean_documents(df, none).count() == 3
    assert contaminations(spark.createDataFrame([], DOCS), items).count() == 0
    assert tokens(None) == [] and tokens("Ab_c-Ü1") == ["ab", "c", "ü1"]
