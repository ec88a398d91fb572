"""Whitening against numpy's eigenvectors and exact integer sums."""

import random
from fractions import Fraction

import numpy as np
import pytest

from clasp.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, v string, id int, deviation int"


def frame(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, "v", 2, 3) for i, v in enumerate(vectors)], schema).repartition(3)


def plain(vectors):
    """n, deviations, covariance and whitening, by Fractions and numpy."""
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    deviations = [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x]
    centred = np.array([[float(Fraction(n * r[j] - s[j], n)) for j in range(d)] for r in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    return n, deviations, e, u.T, centred


def check(spark, vectors, kept, k=8):
    got = [x.asDict() for x in whitening.whiten(frame(spark, vectors), k).collect()]
    n, deviations, e, u, centred = plain([vectors[i] for i in kept])
    k = min(k, int((e > len(e) * 2.0 ** -52 * e[0]).sum()))
    assert sorted((x["vec_id"], x["component"]) for x in got) == [(i, c + 1) for i in kept for c in range(k)]
    sign = {}
    for x in got:
        at, c = kept.index(x["vec_id"]), x["component"] - 1
        assert x["n"] == n and int(x["deviation"]) == deviations[at]
        assert x["explained"] == pytest.approx(e[c] / e.sum(), rel=1e-9) and x["identity_error"] < 1e-9
        want = float(centred[at] @ u[c] / np.sqrt(e[c]))
        if abs(want) > 0.1:
            assert sign.setdefault(c, np.sign(want * x["whitened"])) == np.sign(want * x["whitened"])
        assert abs(abs(x["whitened"]) - abs(want)) < 1e-6
    return got


def random_vectors(n, d, seed=1, spread=1.0):
    r = np.random.default_rng(seed)
    return [list(map(float, v)) for v in r.normal(size=(n, d)) * np.geomspace(spread, spread / 50, d) + 3]


def test_equals_plain(spark):
    vectors = random_vectors(300, 12)
    vectors[5] = None
    vectors[6] = [*vectors[7][:3], None, *vectors[7][4:]]
    vectors[8] = [float("nan")] * 12
    vectors[9] = [*vectors[7][:11], float("inf")]
    vectors[10] = vectors[7][:11]
    vectors[11] = []
    vectors[20] = vectors[21]
    check(spark, vectors, [i for i in range(300) if i not in (5, 6, 8, 9, 10, 11)])


def test_rank_below_eight(spark):
    r = random.Random(4)
    vectors = [[float(a), float(b), 0.5, float(a)] for a, b in ((r.randint(-9, 9), r.randint(-9, 9)) for _ in range(50))]
    got = check(spark, vectors, list(range(50)))
    assert {x["component"] for x in got} == {1, 2}


@pytest.mark.parametrize("vectors", [[], [None, None], [[1.0, 2.0]], [[1.0, 2.0]] * 9, [[], []], [[float("nan")]]])
def test_nothing_to_scale(spark, vectors):
    out = whitening.whiten(frame(spark, vectors))
    assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_stay_exact(spark):
    vectors = [[v[0] * 1e9, v[1] * 1e7, v[2]] for v in random_vectors(40, 3)]
    got = whitening.whiten(frame(spark, vectors)).collect()
    assert {x.vec_id: int(x.deviation) for x in got} == dict(enumerate(plain(vectors)[1]))
    with pytest.raises(Exception, match="2\\^53"):
        whitening.whiten(frame(spark, [[1e30, 1.0], [0.0, 1.0]]))


def test_whole_products_in_blocks():
    y = np.array([[2.0 ** 27, 3.0], [2.0 ** 26 + 1, -5.0], [7.0, 2.0 ** 26]])
    exact = [[sum(int(r[i]) * int(r[j]) for r in y) for j in range(2)] for i in range(2)]
    assert whitening.whole_products(y).tolist() == exact
    assert whitening.whole_products(y[1:]).tolist() == [[sum(int(r[i]) * int(r[j]) for r in y[1:]) for j in range(2)] for i in range(2)]


@pytest.mark.parametrize("d,rank", [(1, 1), (6, 6), (20, 7), (64, 64)])
def test_factorisation(d, rank):
    r = np.random.default_rng(d)
    b = r.normal(size=(d, rank)) * np.geomspace(1, 1e-4, rank)
    v = b @ b.T
    l, order = whitening.pivoted_cholesky(v)
    assert l.shape == (d, rank) and np.allclose(l @ l.T, v[order][:, order], atol=1e-14 * d)
    assert np.allclose(l[:rank], np.tril(l[:rank]))
    e, u = whitening.principal(v)
    want = np.linalg.eigvalsh(v)[::-1][:rank]
    assert np.allclose(e, want, rtol=1e-9, atol=1e-14 * d * want[0]) and np.allclose(u @ u.T, np.eye(rank), atol=1e-10)
    assert np.allclose(v @ u.T, u.T * e, atol=1e-13 * d)


def test_query(spark):
    import pyarrow.parquet as pq
    from clasp.llm.queries import LLM_REGISTRY
    d = "/root/testdata/sf0.01"
    t = pq.read_table(f"{d}/embeddings.parquet").to_pydict()
    got = LLM_REGISTRY["op12_whitening"](spark, d)
    assert dict(got.dtypes)["deviation"] == "bigint"
    n, deviations, e, u, centred = plain(t["embedding"])
    rows = got.collect()
    assert len(rows) == 8 * n and {x.n for x in rows} == {n}
    at = {i: k for k, i in enumerate(t["vec_id"])}
    white = centred @ u[:8].T / np.sqrt(e[:8])
    for x in rows:
        assert x.deviation == deviations[at[x.vec_id]] and x.identity_error < 1e-9
        assert abs(abs(x.whitened) - abs(white[at[x.vec_id], x.component - 1])) < 1e-7
        assert x.explained == pytest.approx(e[x.component - 1] / e.sum(), rel=1e-10)
