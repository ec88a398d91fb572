"""Approximate nearest neighbours by balanced posting lists.

Vectors are dealt to clusters by their nearest centroids. A vector near the
boundary of several clusters is stored in each of them (unless a nearer
centroid of its own already covers that direction), so a query needs few
lists. Centroids are fitted with a penalty on crowded clusters. Lists lie
together in shelves of bounded length and a crowded list fills several, so no
list is one task's burden. To find centroids, every task walks an in-memory
neighbour graph over them; a query reads all lists whose centroid is at most
``1 + slack`` times as far as its nearest one, and further ones, nearest
first, while those it reads might hold too few rows to fill its answer. Where
the walk ends among lists that are still read, the distances to all centroids
are taken instead: steps of a wider walk would cost its width each. The slack
is fitted to a wanted recall within a bounded sample, so clustered vectors
need few lists and evenly spread ones many.

A query is sent once to each shelf that holds a list of its own, not once to
each list, and the shelf's rows lie in a task's memory while its queries
stream by: no row is sent again for every block of queries.

Largest inner product becomes least distance by one more coordinate,
``sqrt(M**2 - |x|**2)``, with ``M`` the largest length. Equal vectors are
searched as one class that carries its smallest ids, so a vector that a
third of all rows share costs no more than another.

The number of centroids is at most ``max_lists``; they and their graph are
the only data sent to every task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clasp.llm.common import cut

SHELF = 1_024, 65_536  # stored rows of a shelf: least and most, expected, not a cap
ASKED = 65_536  # queries that one task holds against a shelf, expected, not a cap
SINGLE = 1e15  # vectors shorter than this have rough scores in single precision
DEGREE = 24  # of the centroid graph


@dataclass
class Lists:
    """Centroids with their graph."""
    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    longest: float  # M
    usual: float = 0.0  # median distance of a query to its nearest centroid
    slack: float = 0.0
    sizes: np.ndarray | None = None  # stored rows of each list
    least: int = 0  # stored rows that a query's lists hold together

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest ** 2 - (x * x).sum(axis=1, keepdims=True), 0))
        return np.hstack([x, rest])

    def pointed(self, q: np.ndarray) -> np.ndarray:
        length = np.sqrt((q * q).sum(axis=1, keepdims=True))
        return np.hstack([q / length * self.longest, np.zeros((len(q), 1))])

    def walk(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest centroids that a walk over the graph finds,
        nearest first, and their squared distances; for all rows at once."""
        k, n = len(self.centroids), len(x)
        width = min(width, k)
        norms = (self.centroids ** 2).sum(axis=1)
        own = (x * x).sum(axis=1)

        def far(rows, ids):
            return own[rows][:, None] + norms[ids] - 2 * np.einsum("nd,nmd->nm", x[rows], self.centroids[ids])

        every = np.arange(n)
        seen = np.zeros((n, k), dtype=bool)
        ids = np.tile(self.entries[:width], (n, 1))
        seen[every[:, None], ids] = True
        dist = far(every, ids)
        order = np.argsort(dist, axis=1, kind="stable")
        ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        ids = np.hstack([ids, np.zeros((n, width - ids.shape[1]), dtype=ids.dtype)])
        dist = np.hstack([dist, np.full((n, width - dist.shape[1]), np.inf)])
        open_ = np.isfinite(dist)
        while True:
            rows = np.flatnonzero(open_.any(axis=1))
            if not len(rows):
                return ids, np.maximum(dist, 0)
            step = open_[rows].argmax(axis=1)  # nearest that isn't expanded
            open_[rows, step] = False
            new = self.graph[ids[rows, step]]
            d = far(rows, new)
            d[seen[rows[:, None], new]] = np.inf
            seen[rows[:, None], new] = True
            all_d = np.hstack([dist[rows], d])
            all_i = np.hstack([ids[rows], new])
            all_o = np.hstack([open_[rows], np.isfinite(d)])
            best = np.argsort(all_d, axis=1, kind="stable")[:, :width]
            dist[rows] = np.take_along_axis(all_d, best, 1)
            ids[rows] = np.take_along_axis(all_i, best, 1)
            open_[rows] = np.take_along_axis(all_o, best, 1)

    def homes(self, x: np.ndarray, replicas: int, slack: float) -> list[np.ndarray]:
        """Clusters that store each vector."""
        ids, dist = self.walk(x, max(2 * replicas, 8))
        dist = np.sqrt(dist)
        out = []
        for row_ids, row in zip(ids, dist):
            kept = [0]
            for j in range(1, len(row)):
                if len(kept) == replicas or row[j] > (1 + slack) * row[0] + 1e-12:
                    break
                gap = np.sqrt(((self.centroids[row_ids[kept]] - self.centroids[row_ids[j]]) ** 2).sum(axis=1))
                if (gap >= row[j] * 0.5).all():  # not behind a centroid it is stored with
                    kept.append(j)
            out.append(row_ids[kept])
        return out

    def all_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All centroids, nearest first, and their squared distances."""
        dist = (x * x).sum(axis=1, keepdims=True) + (self.centroids ** 2).sum(axis=1) - 2 * x @ self.centroids.T
        ids = np.argsort(dist, axis=1, kind="stable")
        return ids, np.maximum(np.take_along_axis(dist, ids, 1), 0)

    def probes(self, q: np.ndarray) -> list[np.ndarray]:
        """Lists that each query reads: all within the distance ratio, and
        the nearest ones up to ``least`` stored rows. A query at a centroid
        is allowed what a usual one is."""
        out: list = [None] * len(q)
        rows = np.arange(len(q))
        for find in (lambda x: self.walk(x, 32), self.all_of):
            ids, dist = find(q[rows])
            dist = np.sqrt(dist)
            near = dist <= (1 + self.slack) * np.maximum(dist[:, :1], self.usual) + 1e-12
            if self.sizes is not None:  # what the lists before it hold
                held = np.cumsum(self.sizes[ids], axis=1) - self.sizes[ids]
                near |= held < self.least
            done = ~near[:, -1] | (ids.shape[1] >= len(self.centroids))
            for r, i, m in zip(rows[done], ids[done], near[done]):
                out[r] = i[m]
            rows = rows[~done]
            if not len(rows):
                break
        return out


def centroids(sample: np.ndarray, k: int, rounds: int = 6, seed: int = 1, crowding: float = 0.3) -> np.ndarray:
    """k-means whose assignment cost grows with a cluster's share."""
    g = np.random.default_rng(seed)
    c = sample[g.permutation(len(sample))[:k]].copy()
    for _ in range(rounds):
        counts, sums = np.zeros(len(c)), np.zeros_like(c)
        norms, spread = (c * c).sum(axis=1), None
        for part in np.array_split(g.permutation(len(sample)), max(1, len(sample) // 1024)):
            x = sample[part]
            d = norms - 2 * x @ c.T + (x * x).sum(axis=1, keepdims=True)
            spread = spread or float(np.maximum(d.min(axis=1), 0).mean())
            home = (d + crowding * spread * counts * len(c) / len(sample)).argmin(axis=1)
            counts += np.bincount(home, minlength=len(c))
            sums += (home == np.arange(len(c))[:, None]).astype(float) @ x
        full = counts > 0
        c[full] = sums[full] / counts[full, None]
    return c


def graph_of(c: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Nearest neighbours of each centroid, and the next one in number, so
    that every centroid can be reached."""
    k = len(c)
    norms, out = (c * c).sum(axis=1), np.zeros((k, min(degree, k) + 1), dtype=np.int64)
    for lo in range(0, k, 1024):
        d = norms - 2 * c[lo:lo + 1024] @ c.T
        out[lo:lo + 1024, :-1] = np.argsort(d, axis=1, kind="stable")[:, :min(degree, k)]
    out[:, -1] = (np.arange(k) + 1) % k
    twice = (out[:, :-1] == out[:, -1:]).any(axis=1)
    out[twice, -1] = np.flatnonzero(twice)  # itself, which a walk has seen
    return out


def fit(sample: np.ndarray, n: int, longest: float, list_size: int = 128, max_lists: int = 4096, replicas: int = 6,
        home_slack: float = 0.12, k: int = 20, wanted: float = 0.96, queries: int = 300) -> Lists:
    """Centroids, graph, and the slack at which ``wanted`` of the ``k``
    nearest neighbours that ``queries`` sampled rows have in the sample lie
    in lists that are read (in a sample they are further off than among all
    rows, so the slack is on the safe side)."""
    lists = int(min(max(1, n // list_size), max_lists, len(sample)))
    bare = Lists(np.zeros((1, 1)), np.zeros((1, 1), dtype=np.int64), np.zeros(1, dtype=np.int64), longest)
    c = centroids(bare.lifted(sample), lists)
    out = Lists(c, graph_of(c), np.unique(np.linspace(0, lists - 1, 16).astype(np.int64)), longest)
    asked = np.unique(np.linspace(0, len(sample) - 1, queries).astype(np.int64))
    pointed = out.pointed(sample[asked])
    far = np.sqrt(np.maximum((pointed ** 2).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * pointed @ c.T, 0))
    out.usual = float(np.median(far.min(axis=1)))
    scores = sample[asked] @ sample.T
    scores[np.arange(len(asked)), asked] = -np.inf
    nearest = np.argsort(-scores, axis=1, kind="stable")[:, :min(k, len(sample) - 1)]
    members, where = np.unique(nearest, return_inverse=True)
    homes = out.homes(out.lifted(sample[members]), replicas, home_slack) if len(members) else []
    ratios = [far[q, homes[m]].min() / max(far[q].min(), out.usual, 1e-12)
              for q, row in enumerate(where.reshape(nearest.shape)) for m in row]
    out.slack = max(0.0, float(np.quantile(ratios, wanted)) - 1) if ratios else 0.0
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _rows(batch: pa.RecordBatch, names: list[str], rows: np.ndarray, **more: pa.Array) -> pa.RecordBatch:
    part = batch.take(pa.array(rows, pa.int64()))
    return pa.RecordBatch.from_arrays([*more.values(), *(part.column(n) for n in names)], names=[*more, *names])


def classes_of(vectors: DataFrame, id_col: str, vector_col: str, keep: int) -> tuple[DataFrame, DataFrame]:
    """Rows that take part, ``vec_id, class_id``, and the distinct vectors,
    ``class_id, vector, ids`` with the ``keep`` smallest ids of each."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = v.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(
        usable & F.exists("vector", lambda x: x != 0))
    v = cut(v.groupBy("vec_id").agg(F.min("vector").alias("vector")), "ann-rows")
    size = v.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if size is not None:
        v = v.where(F.size("vector") == size.d)
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    first = v.withColumn("_n", F.row_number().over(by_vector)).where(F.col("_n") <= keep)
    classes = cut(first.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("class_id"), "vector", "ids"), "ann-classes")
    named = v.join(classes.select("class_id", F.col("vector").alias("_v")), F.col("vector") == F.col("_v"))
    return named.select("vec_id", "class_id"), classes


def shelves(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shelf of each list and how many it fills: a list of more than
    ``length`` rows has shelves of its own, others share one of about
    ``length``."""
    parts = np.maximum(1, -(-sizes // length))
    first, shelf, held = np.zeros(len(sizes), dtype=np.int64), 0, 0
    for i, (n, p) in enumerate(zip(sizes.tolist(), parts.tolist())):
        if held and held + n > length:
            shelf, held = shelf + 1, 0
        first[i], held = shelf, held + n
        if p > 1:
            shelf, held = shelf + p, 0
    return first, parts


def _on_shelves(lists: list[np.ndarray], first: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Each query's lists by shelf: number of the query, shelf, lists."""
    each = np.concatenate(lists)
    at = np.repeat(np.arange(len(lists)), [len(p) for p in lists])
    n = parts[each]
    part = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at, each = np.repeat(at, n), np.repeat(each, n)
    shelf = first[each] + part
    order = np.lexsort((each, shelf, at))
    at, shelf, each = at[order], shelf[order], each[order]
    new = np.flatnonzero(np.r_[True, (np.diff(at) != 0) | (np.diff(shelf) != 0)])
    offsets = pa.array(np.r_[new, len(at)], pa.int32())
    return at[new], shelf[new], pa.ListArray.from_arrays(offsets, pa.array(each, pa.int64()))


def _below(bound: np.ndarray, kind: np.dtype) -> np.ndarray:
    """A column of bounds in another precision, none larger than it was."""
    out = bound.astype(kind)
    return np.where(out > bound, np.nextafter(out, kind.type(-np.inf)), out)[:, None]


class Shelf:
    """Stored rows of a shelf, ordered by list."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        self.x = _vectors(rows.column("vector").combine_chunks())
        self.names = rows.column("class_id").to_numpy()
        members = rows.column("ids").combine_chunks()
        starts = members.offsets.to_numpy()
        self.ids, self.counts = members.values.to_numpy()[starts[0]:starts[-1]], np.diff(starts)
        self.starts = starts[:-1] - starts[0]
        self.lists, self.at = np.unique(rows.column("cluster").to_numpy(), return_index=True)
        self.ends = np.r_[self.at[1:], len(self.x)]
        self.longest = float(np.sqrt((self.x * self.x).sum(axis=1).max()))
        self.rough = self.x.astype(np.float32) if self.longest < SINGLE else self.x

    def best(self, asked: pa.RecordBatch, k: int, bound: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Query, id and score of the ``k`` best rows (more only by their
        ids) of each query among its lists on this shelf. ``bound`` has the
        scores below which a query needs no row."""
        q, queries, wanted = _vectors(asked.column("vector")), asked.column("class_id").to_numpy(), asked.column("ids")
        owner = np.repeat(np.arange(len(q)), np.diff(wanted.offsets.to_numpy()))
        wanted = wanted.flatten().to_numpy()
        order = np.argsort(wanted, kind="stable")
        wanted, owner = wanted[order], owner[order]
        lo, hi = np.searchsorted(wanted, self.lists), np.searchsorted(wanted, self.lists, "right")
        # rough scores say which rows need a look: those by which rounding, in so many terms, may hide a best one
        length = np.sqrt((q * q).sum(axis=1))
        single = self.rough.dtype == np.float32 and length.max() < SINGLE
        rows, near = (self.rough, q.astype(np.float32)) if single else (self.x, q)
        slip = 4 * q.shape[1] * (2.0 ** -24 if single else 2.0 ** -53) * length * self.longest + 1e-40
        kept = [np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)]  # query, row, score
        least, more = np.full(len(q), -np.inf) if bound is None else bound - slip, []

        def settle():
            """The best so far, and what a query's k-th best leaves out."""
            n, row, score = (np.concatenate([a, *b]) for a, b in zip(kept, zip(*more)))
            order = np.lexsort((self.names[row], -score, n))
            n, row, score = n[order], row[order], score[order]
            first = np.r_[True, (np.diff(n) != 0) | (np.diff(self.names[row]) != 0)]  # a replica is the same row
            n, row, score = n[first], row[first], score[first]
            place = np.arange(len(n)) - np.searchsorted(n, n)
            kept[:] = (a[place < k] for a in (n, row, score))
            full = place == k - 1
            least[n[full]] = score[full] - slip[n[full]]
            more.clear()

        for a, b, start, end in zip(lo, hi, self.at, self.ends):
            if a == b:
                continue
            mine, x = owner[a:b], self.x[start:end]
            rough = near[mine] @ rows[start:end].T
            bound = least[mine]
            found = rough >= _below(bound, rough.dtype)
            if end - start > k and np.count_nonzero(found) > 2 * k * len(mine):
                kth = np.partition(rough, end - start - k, axis=1)[:, end - start - k]
                found = rough >= _below(np.maximum(bound, kth - 2 * slip[mine]), rough.dtype)
            n, row = np.divmod(np.flatnonzero(found), end - start)
            if len(n):
                # the same sum wherever the row is stored
                more.append((mine[n], row + start, (x[row] * q[mine[n]]).sum(axis=1)))
                if sum(len(m[0]) for m in more) > 2 * k * len(q):
                    settle()
        if more:
            settle()
        n, row, score = kept
        count = self.counts[row]
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        ids = self.ids[np.repeat(self.starts[row], count) + place]
        return queries[np.repeat(n, count)], ids, np.repeat(score, count)


class Best:
    """The best ids of each query among what a task has met so far."""

    def __init__(self, k: int):
        self.k, self.fresh = k, []
        self.rows = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)  # by query, best first
        self.names, self.kth = self.rows[0], self.rows[2]

    def settle(self) -> None:
        query, ids, score = (np.concatenate([a, *b]) for a, b in zip(self.rows, zip(*self.fresh))) if self.fresh else self.rows
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        new = np.r_[True, (np.diff(query) != 0) | (np.diff(ids) != 0)][:len(query)]  # a replica has the same score
        query, ids, score = query[new], ids[new], score[new]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        full = place == self.k - 1
        self.names, self.kth = query[full], score[full]
        self.rows, self.fresh = tuple(a[place < self.k] for a in (query, ids, score)), []

    def bound(self, queries: np.ndarray) -> np.ndarray:
        """The ``k``-th best score of each query, as last settled."""
        if not len(self.names):
            return np.full(len(queries), -np.inf)
        at = np.minimum(np.searchsorted(self.names, queries), len(self.names) - 1)
        return np.where(self.names[at] == queries, self.kth[at], -np.inf)

    def emptied(self, step: int = 100_000):
        self.settle()
        rows = pa.RecordBatch.from_arrays([pa.array(a) for a in self.rows], names=["query", "vec_id", "score"])
        self.__init__(self.k)
        yield from (rows.slice(at, step) for at in range(0, rows.num_rows, step))


def _scan(k: int, step: int = 1024, flush: int = 2_000_000):
    """Rows in the order of shelf, share and kind (stored ones first) ->
    each query's best among them, once for each task (or ``flush`` rows)."""
    def run(batches):
        name, held, shelf, best = None, [], None, Best(k)
        for whole in batches:
            if not whole.num_rows:
                continue
            keys = np.stack([whole.column(c).to_numpy() for c in ("shelf", "share", "kind")])
            cuts = [0, *(np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1).tolist(), whole.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if name != tuple(keys[:2, lo]):
                    name, held, shelf = tuple(keys[:2, lo]), [], None
                    best.settle()
                    if len(best.rows[0]) > flush:
                        yield from best.emptied()
                if keys[2, lo] == 0:
                    held.append(whole.slice(lo, hi - lo))
                    continue
                if shelf is None and held:
                    shelf, held = Shelf(pa.Table.from_batches(held)), []
                for at in range(lo, hi if shelf else lo, step):
                    asked = whole.slice(at, min(step, hi - at))
                    best.fresh.append(shelf.best(asked, k, best.bound(asked.column("class_id").to_numpy())))
        yield from best.emptied()
    return run


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20,
           list_size: int = 128, max_lists: int = 4096, sample_rows: int = 20_000, replicas: int = 6,
           home_slack: float = 0.12, wanted: float = 0.96) -> DataFrame:
    """Each query's ``k`` nearest rows: ``query_id, rank, vec_id, score``.

    Queries are rows whose id is divisible by ``every``; candidates all rows
    but the query's own. A query has fewer than ``k`` rows only if there are
    fewer candidates. The index is fitted on about ``sample_rows`` rows
    and holds every row. Scores are inner products in double precision of
    the vectors as given; ties go to the smaller id. Rows without id, and
    vectors that are null, empty, zero, hold a null or a non-finite
    component, or have another length than most, take no part. An id that
    repeats is one row, with its smallest vector. Other columns are ignored;
    an empty table gives no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows, classes = classes_of(vectors, id_col, vector_col, k + 1)
    stats = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate(
        "vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("m")).first()
    if not stats.n:
        return spark.createDataFrame([], schema)
    rate = int(min(1.0, sample_rows / stats.n) * 1_000_000)
    sampled = classes.where(F.pmod(F.xxhash64(F.lit("ann"), "class_id"), F.lit(1_000_000)) < rate).orderBy("class_id")
    sample = np.array([r.vector for r in sampled.select("vector").limit(2 * sample_rows).collect()], dtype=np.float64)
    if not len(sample):
        sample = np.array([classes.orderBy("class_id").first().vector], dtype=np.float64)
    sent = spark.sparkContext.broadcast(fit(
        sample, stats.n, float(np.sqrt(stats.m)), list_size, max_lists, replicas, home_slack, k, wanted))

    def store(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                batch = whole.slice(lo, 1024)
                homes = sent.value.homes(sent.value.lifted(_vectors(batch.column("vector"))), replicas, home_slack)
                at = np.repeat(np.arange(len(homes)), [len(h) for h in homes])
                yield _rows(batch, ["class_id", "vector", "ids"], at, cluster=pa.array(np.concatenate(homes), pa.int64()))

    def ask(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                probes = sent.value.probes(sent.value.pointed(_vectors(batch.column("vector"))))
                at, shelf, read = _on_shelves(probes, first, parts)
                yield _rows(batch, ["class_id", "vector"], at, shelf=pa.array(shelf, pa.int64()), ids=read)

    kind = dict(classes.dtypes)["vector"]
    queries = cut(rows.where(F.col("vec_id") % every == 0), "ann-queries")
    asked = classes.join(queries.select("class_id").distinct(), "class_id", "left_semi").select("class_id", "vector")
    stored = cut(classes.mapInArrow(store, f"cluster long, class_id long, vector {kind}, ids array<long>"), "ann-lists")
    # a row is stored in at most ``replicas`` lists, so these hold k rows beside the query's own
    lists = sent.value
    lists.sizes, lists.least = np.zeros(len(lists.centroids), dtype=np.int64), replicas * (k + 1)
    for r in stored.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect():
        lists.sizes[r.cluster] = r.n
    sent = spark.sparkContext.broadcast(lists)
    tasks = 4 * spark.sparkContext.defaultParallelism
    first, parts = shelves(lists.sizes, int(min(max(SHELF[0], -(-lists.sizes.sum() // tasks)), SHELF[1])))
    probes = cut(asked.mapInArrow(ask, f"shelf long, ids array<long>, class_id long, vector {kind}"), "ann-probes")
    # a shelf that very many queries ask for is read by several tasks, each with a share of them
    many = sorted(probes.groupBy("shelf").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int")).collect())
    before = np.cumsum([0, *(n for _, n in many)]).tolist()
    share_of = F.broadcast(spark.createDataFrame([(s, n, b) for (s, n), b in zip(many, before)], "shelf long, shares int, before long"))
    list_of = F.broadcast(spark.createDataFrame(list(zip(range(len(first)), first.tolist(), parts.tolist())), "cluster long, first long, parts long"))
    on_shelf = stored.join(list_of, "cluster").withColumn("shelf", F.col("first") + F.pmod(F.xxhash64("class_id"), F.col("parts"))).join(
        share_of, "shelf").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).withColumn("kind", F.lit(0))
    shared = probes.join(share_of, "shelf").withColumn("share", F.pmod(F.xxhash64("class_id"), F.col("shares")).cast("int")).withColumns(
        {"kind": F.lit(1), "cluster": F.lit(0).cast("long")})
    # shares are dealt in turn: a number for each task that is hashed to it alone
    own = dict(spark.range(20 * tasks).select(F.pmod(F.hash("id"), F.lit(tasks)), "id").collect())
    spot = F.get(F.array(*[F.lit(own.get(i, i)) for i in range(tasks)]), F.pmod(F.col("before") + F.col("share"), F.lit(tasks)).cast("int"))
    columns = [spot.alias("spot"), "shelf", "share", "kind", "cluster", "class_id", "vector", "ids"]
    dealt = on_shelf.select(*columns).unionByName(shared.select(*columns)).repartition(tasks, "spot").sortWithinPartitions(
        "shelf", "share", "kind", "cluster", "class_id")
    found = dealt.mapInArrow(_scan(k + 1), "query long, vec_id long, score double").repartition("query")
    found = found.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    nearest_first = [F.desc("score"), F.asc("vec_id")]
    top = found.withColumn("_r", F.row_number().over(Window.partitionBy("query").orderBy(*nearest_first))).where(
        F.col("_r") <= k + 1).drop("_r")
    each = (queries.select(F.col("vec_id").alias("query_id"), "class_id")
            .join(top, F.col("class_id") == F.col("query")).where("query_id <> vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*nearest_first))
    return (each.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
