"""Posting lists: recall, exact scores, ties and rows that take no part."""

import numpy as np
import pyarrow as pa
import pytest

from clasp.llm import neighbours
from clasp.llm.neighbours import Lists, centroids, fit, graph_of, search

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int"


def brute(vectors, every=20, k=20):
    out = {}
    for q, x in vectors.items():
        if q % every == 0:
            scores = sorted((-(np.array(x, "f4").astype("f8") * np.array(y, "f4").astype("f8")).sum(), i)
                            for i, y in vectors.items() if i != q)
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def found(df, **more):
    out = {}
    for r in sorted(search(df, **more).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items()])


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute({r.vec_id: r.embedding for r in df.collect()})
    got = found(df, list_size=32)
    assert recall(got, want) >= 0.9
    for q, rows in got.items():
        assert len(rows) == 20 and all(abs(s - dict(want[q]).get(i, s)) < 1e-12 for i, s in rows)
        assert [(-s, i) for i, s in rows] == sorted((-s, i) for i, s in rows)


def test_lengths_differ_and_one_vector_is_very_common(spark):
    g = np.random.default_rng(3)
    v = {i: (g.normal(size=8) * (1 + i % 5)).astype("f4").tolist() for i in range(600)}
    v[0] = [9.0] * 8
    v |= {i: v[0] for i in range(600, 900)}
    df = spark.createDataFrame([(i, x, 1, None, None) for i, x in v.items()], SCHEMA)
    want, got = brute(v), found(df, list_size=50, sample_rows=300)
    assert recall(got, want) >= 0.9
    for q in (0, 620, 880):  # its own copies, by id
        assert got[q] == want[q]


def test_few_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [1.0, 2.0]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]),
            (3, [1.0, None]), (4, []), (5, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (0, [1.0, 2.0]), (6, [-1.0, -1.0])]
    got = found(spark.createDataFrame([(i, x, None, None, None) for i, x in rows], SCHEMA))
    assert got == {0: [(2, 5.0), (1, 4.0), (6, -3.0)]}
    assert found(spark.createDataFrame([(20, [1.0, 1.0], 1, "", 1)], SCHEMA)) == {}
    assert found(spark.createDataFrame([], SCHEMA)) == {}


def test_graph_walk_finds_the_nearest_centroids():
    x = np.random.default_rng(1).normal(size=(4000, 16))
    lists = fit(x, 4000, float(np.sqrt((x * x).sum(axis=1)).max()), 20)
    q = lists.pointed(x[:100])
    ids, _ = lists.walk(q, 32)
    true = np.argsort(((q[:, None, :] - lists.centroids[None]) ** 2).sum(axis=2), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids, true)]) > 0.9
    assert all(len(set(r)) == len(r) for r in ids.tolist())
    assert isinstance(lists, Lists) and graph_of(centroids(x, 1)).shape[0] == 1


def test_small_isolated_clusters_fill_every_query(spark):
    g = np.random.default_rng(5)
    middles = g.normal(size=(60, 16)) * 10
    sizes = [150] * 20 + [6] * 40
    x = np.vstack([m + g.normal(size=(n, 16)) * 0.05 for m, n in zip(middles, sizes)]).astype("f4")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    v = dict(enumerate(x[g.permutation(len(x))].tolist()))
    want, got = brute(v), found(spark.createDataFrame([(i, y, 1, None, None) for i, y in v.items()], SCHEMA), list_size=20)
    assert set(got) == set(want) and all(len(rows) == 20 for rows in got.values())
    assert recall(got, want) >= 0.9


def test_a_query_that_reads_most_lists_is_not_walked_further():
    """Beyond the 32 nearest the walk costs a step for each list; then all
    centroids are measured at once."""
    x = np.random.default_rng(2).normal(size=(6000, 16))
    lists = fit(x, 6000, float(np.sqrt((x * x).sum(axis=1)).max()), 20)
    lists.slack, widths, walk = 0.6, [], lists.walk
    lists.walk = lambda q, width: widths.append(width) or walk(q, width)
    q = lists.pointed(x[:50])
    dist = np.sqrt(((q[:, None, :] - lists.centroids[None]) ** 2).sum(axis=2))
    got = lists.probes(q)
    assert max(widths) <= 32 and np.mean([len(p) for p in got]) > 100
    for p, d in zip(got, dist):
        assert sorted(p) == np.flatnonzero(d <= 1.6 * max(d.min(), lists.usual) + 1e-12).tolist()


def test_a_query_is_sent_once_to_each_shelf_of_its_lists():
    first, parts = neighbours.shelves(np.array([30, 50, 0, 40, 250, 10, 90]), 100)
    assert first.tolist() == [0, 0, 0, 1, 2, 5, 5] and parts.tolist() == [1, 1, 1, 1, 3, 1, 1]
    at, shelf, lists = neighbours._on_shelves([np.array([6, 0, 5]), np.array([4]), np.array([1, 3, 0])], first, parts)
    assert list(zip(at.tolist(), shelf.tolist(), lists.to_pylist())) == [
        (0, 0, [0]), (0, 5, [5, 6]), (1, 2, [4]), (1, 3, [4]), (1, 4, [4]), (2, 0, [0, 1]), (2, 1, [3])]


@pytest.mark.parametrize("scale", [1.0, 1e-25, 1e12, 1e18])
def test_the_best_of_a_shelf_whatever_the_lengths(scale):
    """Rough scores in single precision hide no row; a replica is one row."""
    g = np.random.default_rng(4)
    x = (g.normal(size=(900, 12)) * scale).astype("f4")
    x[1:300:2] = x[0:300:2]  # ties
    home = np.sort(g.integers(0, 3, size=1200))
    row = np.concatenate([np.arange(900), g.integers(0, 900, 300)])
    pairs = sorted({*zip(home.tolist(), row.tolist())})
    vectors = pa.list_(pa.float32())
    shelf = neighbours.Shelf(pa.table({"cluster": [c for c, _ in pairs], "class_id": [r for _, r in pairs], "vector": pa.array([x[r].tolist() for _, r in pairs], vectors),
                                       "ids": [[r, r + 1000] if r % 7 == 0 else [r] for _, r in pairs]}))
    read = [[0, 2], [1], [0, 1, 2], [9]]
    asked = pa.RecordBatch.from_pydict({"class_id": [0, 20, 40, 60], "vector": pa.array([x[q].tolist() for q in (0, 20, 40, 60)], vectors), "ids": read})
    got: dict = {}
    for q, i, s in zip(*(c.tolist() for c in shelf.best(asked, 5))):
        got.setdefault(q, []).append((-s, i))
    for q, lists in zip((0, 20, 40, 60), read):
        there = sorted({r for c, r in pairs if c in lists})
        want = sorted((-float((x[r].astype("f8") * x[q].astype("f8")).sum()), r) for r in there)[:5]
        assert sorted((s, i) for s, i in got.get(q, []) if i < 1000) == want
        assert sorted(i - 1000 for _, i in got.get(q, []) if i >= 1000) == sorted(i for _, i in want if i % 7 == 0)


def test_a_task_gives_each_query_its_best_once():
    """However many shelves a task holds, a query has ``k`` rows of it."""
    best = neighbours.Best(3)
    rows = [(q, i, float((i * 7 + q) % 11)) for q in (5, 9) for i in range(10)] + [(7, 1, 2.0)]
    for part in (rows[::2], rows[1::2], rows[:4]):
        best.fresh.append(tuple(np.array(c) for c in zip(*part)))
        best.settle()
    want = [r for q in (5, 7, 9) for r in sorted((r for r in rows if r[0] == q), key=lambda r: (-r[2], r[1]))[:3]]
    assert best.bound(np.array([9, 7, 5, 1])).tolist() == [want[-1][2], -np.inf, want[2][2], -np.inf]
    assert [r for b in best.emptied(2) for r in zip(*(c.to_pylist() for c in b.columns))] == want
    assert list(neighbours.Best(3).emptied()) == []
