"""SimHash fingerprints, links and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from clasp.llm.components import components
from clasp.llm.simhash import allocate, ball, bit_groups, fingerprint, links, near_duplicates, one_of_each

SCHEMA = "doc_id long, text string, row string, fp int, component_id string"


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(fps, distance=2):
    fps = sorted(set(fps))
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin((a ^ b) % 2**64).count("1") <= distance:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {f: find(f) for f in fps}


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_fingerprint():
    r = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 700):
        t = " \n".join(r.choice(["Ab", "É", "c", "dé", "Z9"]) for _ in range(n))
        assert fingerprint(t.encode()) == slow_fingerprint(t)


def test_spark_hash_is_the_same(spark):
    t = "some Ünicode text that is longer than thirty-two bytes"
    h = spark.sql(f"select xxhash64('{t}') h").first().h
    assert h % 2**64 == xxhash.xxh64_intdigest(t.encode(), 42)


@pytest.mark.parametrize("kind", ["spread", "dense", "few"])
def test_links_have_the_components_of_all_pairs(spark, kind):
    r = random.Random(kind)
    base = [r.getrandbits(64) for _ in range(60)]
    if kind == "few":
        fps = {0, 1, 7, 2**63, 2**64 - 1}
    else:
        flips = (2, 5) if kind == "spread" else (0, 4)
        n = 300 if kind == "spread" else 900
        fps = set(base if kind == "spread" else base[:2])
        while len(fps) < n:
            f = r.choice(base if kind == "spread" else base[:2])
            for _ in range(r.randint(*flips)):
                f ^= 1 << r.randrange(64 if kind == "spread" else 20)
            fps.add(f)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = links(df).collect()
    assert all(bin((x.a ^ x.b) % 2**64).count("1") <= 2 for x in got)
    want = roots([signed(f) for f in fps])
    comp = {c.node: c.root for c in components(links(df)).collect()}
    assert {f: comp.get(f, f) for f in want} == want


def test_bit_groups_hold_every_bit_and_correlated_bits_meet(spark):
    r = random.Random(3)
    fps = []
    for _ in range(400):
        f = r.getrandbits(64)
        f = f & ~((1 << 60) | (1 << 5)) | ((f >> 33 & 1) << 60) | ((f >> 33 & 1) << 5)
        fps.append((signed(f),))
    groups = bit_groups(spark.createDataFrame(fps, "fp long"), 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any({5, 33, 60} <= set(g) for g in groups)


def test_allocation_is_the_cheapest():
    costs = np.random.default_rng(1).random((50, 3, 4))
    plan, cost = allocate(costs)
    for row in range(50):
        every = {(a, b, c): costs[row, 0, a] + costs[row, 1, b] + costs[row, 2, c]
                 for a in range(4) for b in range(4) for c in range(4) if a + b + c == 3}
        assert tuple(plan[row]) in every and abs(min(every.values()) - cost[row]) < 1e-9
    assert len(ball(21, 2)) == 1 + 21 + 210


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (7, 3), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    long = [r.choice(words) for _ in range(1500)]
    near = list(long)
    near[700] = "changed"
    texts = [" ".join(long), " ".join(near), "some other text here", "Some Other Text here", None, "", "  ",
             "lone words of its own", " ".join(long)]
    rows = [(i + 10, t, "x", 1, None) for i, t in enumerate(texts)] + [(10, texts[0], None, None, None), (None, "null id", "", 2, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = near_duplicates(df).collect()
    want = roots([signed(slow_fingerprint(x[1])) for x in rows])
    ids = {}
    for i, t, *_ in rows:
        root = want[signed(slow_fingerprint(t))]
        if i is not None:
            ids[root] = min(i, ids.get(root, i))
    assert sorted((x.doc_id or -1, x.fingerprint, x.component_id or -1) for x in out) == sorted(
        (i or -1, f"{slow_fingerprint(t):016x}", ids.get(want[signed(slow_fingerprint(t))], -1)) for i, t, *_ in rows)
    kept = one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((x.doc_id is None, x.doc_id) for x in kept.collect()) == sorted(
        [(False, i) for i in ids.values()] + [(True, None)])
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
