"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are 64 majority bits over the hashes of word shingles. Bits
are grouped into partitions so that correlated bits sit together. If the
thresholds ``t_i`` (``-1`` skips a partition) of ``m`` partitions sum to
``distance - m + 1``, two fingerprints within ``distance`` differ by at most
``t_i`` bits in some partition ``i``. Each fingerprint chooses its own
thresholds by dynamic programming on estimated candidate counts, probes all
values in reach, and every candidate is verified.

A fingerprint for which every allocation is dear (its values are shared by
very many others, as in a large group of near copies) is searched without
candidates: it gives every value in reach of half the distance as a key.
Two fingerprints within an even ``distance`` share such a key, and any two
that share one are within it, so a group of keys is a star of true links.
A link between such a fingerprint and another one is found by the other's
probes. Work therefore stays in proportion to the number of distinct
fingerprints, whatever the sizes of the groups.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clasp.llm.common import arrow_map, cut, discard, row_key, texts_as_bytes
from clasp.llm.components import components

BITS = 64
COARSE_BITS = 12  # of a partition's value, for the histogram behind the estimates
_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    words = text.lower().split()  # lower-cases A-Z only
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends.tolist()]
        line, digest = b" ".join(words), xxhash.xxh64_intdigest
        hashes = [digest(line[s:e - 1], seed) for s, e in zip(starts, starts[shingle:])]
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    if len(octets) < 256:
        counts = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        counts = np.concatenate([np.bincount(octets[:, b], minlength=256) @ _BIT_OF_BYTE for b in range(8)])
    return int(np.packbits(counts * 2 > len(octets), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3, seed: int = 42) -> DataFrame:
    """``id, row, fp``, one row per input row: the id, the 128-bit name of
    (id, text) and the fingerprint as a signed long. No words: 0."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle, seed) for t in texts_as_bytes(batch.column("text"))], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), pa.array(fps.view(np.int64))],
                                          names=["id", "row", "fp"])
    id_type = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("id"), F.unhex(row_key(id_col, text_col)).alias("row"),
                        F.col(text_col).alias("text"))
    return arrow_map(given, run, f"id {id_type}, row binary, fp long")


def bit_groups(classes: DataFrame, parts: int) -> list[list[int]]:
    """Partitions of the 64 bits: each takes, one by one, the bit most
    correlated with those it has. Correlations are over all fingerprints;
    64 x 64 sums per task are all that moves."""
    def run(batches):
        total = np.zeros((BITS + 1, BITS + 1))
        for b in batches:
            fps = b.column("fp").to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            one = np.hstack([bits, np.ones((len(bits), 1), dtype=np.uint8)]).astype(np.float32)
            for lo in range(0, len(one), 1 << 16):
                part = one[lo:lo + (1 << 16)]
                total += part.T @ part
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()),
                                          pa.array(total.ravel().astype(np.int64))], names=["i", "j", "n"])
    sums = np.zeros((BITS + 1, BITS + 1))
    for r in classes.select("fp").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(
            F.sum("n").alias("n")).collect():  # 65 x 65 rows
        sums[r.i, r.j] = r.n
    n = max(sums[BITS, BITS], 1)
    mean = sums[BITS, :BITS] / n
    cov = sums[:BITS, :BITS] / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(BITS)), []
    for p in range(parts):
        size = BITS // parts + (p < BITS % parts)
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            nearest = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(nearest)
            left.remove(nearest)
        groups.append(group)
    return groups


def _value(bits: list[int]) -> Column:
    out = F.lit(0).cast("long")
    for k, b in enumerate(bits):
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1).cast("long")), k))
    return out


def ball(width: int, radius: int) -> np.ndarray:
    """Masks of at most ``radius`` of ``width`` bits."""
    return np.array([sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)],
                    dtype=np.uint64)


def _estimates(hist: np.ndarray, width: int, distance: int) -> list[np.ndarray]:
    """Fingerprints expected within 0..distance bits of a value, by its
    coarse bits; the other bits of a value count as even coins."""
    coarse = min(COARSE_BITS, width)
    rest = width - coarse
    at = np.arange(1 << coarse)
    rings = [sum(hist[at ^ int(m)] for m in ball(coarse, d) if bin(int(m)).count("1") == d) for d in range(distance + 1)]
    near = [sum(comb(rest, j) for j in range(k + 1)) / 2.0 ** rest for k in range(distance + 1)]
    return [sum(rings[d] * near[t - d] for d in range(t + 1)) for t in range(distance + 1)]


def allocate(costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``costs[row, part, u]`` of threshold ``u - 1`` -> the cheapest ``u``
    per row and part with sum ``costs.shape[2] - 1``, and its cost."""
    rows, parts, states = costs.shape
    best = costs[:, 0, :].copy()
    choice = np.zeros((rows, parts, states), dtype=np.int64)
    choice[:, 0, :] = np.arange(states)
    for p in range(1, parts):
        options = np.full((rows, states, states), np.inf)
        for total in range(states):
            for u in range(total + 1):
                options[:, total, u] = best[:, total - u] + costs[:, p, u]
        choice[:, p, :] = options.argmin(axis=2)
        best = options.min(axis=2)
    left = np.full(rows, states - 1)
    out = np.zeros((rows, parts), dtype=np.int64)
    for p in range(parts - 1, -1, -1):
        out[:, p] = choice[np.arange(rows), p, left]
        left = left - out[:, p]
    return out, best[:, -1]


def _probes(groups: list[list[int]], hists: list[np.ndarray], distance: int):
    widths = [len(g) for g in groups]
    tables = [_estimates(h, w, distance) for h, w in zip(hists, widths)]
    masks = [[ball(w, t) for t in range(distance + 1)] for w in widths]
    around = ball(BITS, distance // 2)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        costs = np.zeros((len(fps), len(groups), distance + 2))
        values = []
        for p, (table, mask) in enumerate(zip(tables, masks)):
            v = batch.column(f"v{p}").to_numpy(zero_copy_only=False).astype(np.int64)
            same = batch.column(f"c{p}").to_numpy(zero_copy_only=False).astype(np.float64)
            values.append(v.view(np.uint64))
            for t in range(distance + 1):
                low = v & ((1 << min(COARSE_BITS, widths[p])) - 1)
                guess = same if t == 0 else np.maximum(table[t][low], same)
                costs[:, p, t + 1] = len(mask[t]) + guess
        plan, cost = allocate(costs)
        dear = cost > 2 * len(around) if distance % 2 == 0 else np.zeros(len(fps), dtype=bool)
        out_fp, out_part, out_val = [], [], []
        for p in range(len(groups)):
            for t in range(distance + 1):
                rows = np.flatnonzero(~dear & (plan[:, p] == t + 1))
                probes = values[p][rows][:, None] ^ masks[p][t][None, :]
                out_fp.append(np.repeat(fps[rows], probes.shape[1]))
                out_part.append(np.full(probes.size, p, dtype=np.int32))
                out_val.append(probes.ravel().view(np.int64))
        rows = np.flatnonzero(dear)
        keys = fps[rows].view(np.uint64)[:, None] ^ around[None, :]
        out_fp.append(np.repeat(fps[rows], keys.shape[1]))
        out_part.append(np.full(keys.size, -1, dtype=np.int32))
        out_val.append(keys.ravel().view(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x)) for x in (out_fp, out_part, out_val)], names=["fp", "part", "val"])
    return run


def links(classes: DataFrame, distance: int = 2, parts: int = 3) -> DataFrame:
    """Distinct fingerprints (``fp``) -> ``a, b``: links whose components
    are those of all pairs within ``distance`` bits. Every row is a true
    link or an edge of a star of true links."""
    groups = bit_groups(classes, parts)
    index = classes.select("fp", *[_value(g).alias(f"v{p}") for p, g in enumerate(groups)])
    hists = [np.zeros(1 << min(COARSE_BITS, len(g))) for g in groups]
    keyed = index.select("fp", F.explode(F.array(*[
        F.struct(F.lit(p).alias("part"), F.col(f"v{p}").alias("val")) for p in range(parts)])).alias("x")).select(
        "fp", "x.part", "x.val")
    keyed = cut(keyed, "simhash-index")
    low = F.col("val").bitwiseAND(F.lit((1 << COARSE_BITS) - 1).cast("long"))
    for r in keyed.groupBy("part", low.alias("low")).agg(F.count(F.lit(1)).alias("n")).collect():  # 4096 a part
        hists[r.part][r.low] = r.n
    shared = keyed.groupBy("part", "val").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    known = (keyed.join(shared, ["part", "val"]).groupBy("fp")
             .agg(*[F.max(F.when(F.col("part") == p, F.col("n"))).alias(f"c{p}") for p in range(parts)]))
    counted = index.join(known, "fp", "left").select(
        "fp", *[f"v{p}" for p in range(parts)],
        *[F.coalesce(f"c{p}", F.lit(1)).cast("long").alias(f"c{p}") for p in range(parts)])
    probes = cut(arrow_map(counted, _probes(groups, hists, distance), "fp long, part int, val long"), "simhash-probes")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance
    found = (probes.where("part >= 0")
             .join(keyed.withColumnRenamed("fp", "other"), ["part", "val"])
             .where((F.col("fp") != F.col("other")) & near)
             .select(F.col("fp").alias("a"), F.col("other").alias("b")))
    # all members of a key are within distance / 2 of it, so a key has as many at most as a ball that size
    stars = (probes.where("part < 0").groupBy("val").agg(F.collect_set("fp").alias("members"))
             .where("size(members) > 1")
             .select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a <> b"))
    return found.unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, distance: int = 2, parts: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, fingerprint, component_id, row, is_kept``, one row per
    input row.

    Null and empty texts have fingerprint zero and link like any other. The
    component id is the smallest id reachable (nulls only count if there is
    no other). ``is_kept`` marks one (id, text) per component: that of the
    smallest id, then the smallest ``row``; equal rows share the mark.
    Other columns are ignored; an empty table gives no rows.
    """
    sketch = cut(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-rows")
    first = F.min(F.struct(F.col("id").isNull().alias("_null"), "id", "row")).alias("first")
    classes = cut(sketch.groupBy("fp").agg(first), "simhash-classes")
    found = components(links(classes.select("fp"), distance, parts))
    rooted = (classes.join(found, classes["fp"] == found["node"], "left")
              .select("fp", F.coalesce("root", "fp").alias("root"), "first"))
    rooted = cut(rooted, "simhash-rooted")
    ends = rooted.groupBy("root").agg(F.min("first").alias("first"))
    named = rooted.select("fp", "root").join(ends, "root").select("fp", "first")
    return (sketch.join(named, "fp")
            .select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("first")["id"].alias("component_id"), "row",
                    (F.col("row") == F.col("first")["row"]).alias("is_kept")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = 3, distance: int = 2, parts: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each component, all columns kept."""
    kept = (near_duplicates(docs, id_col, text_col, shingle, distance, parts, seed)
            .where("is_kept").groupBy("row").agg(F.lit(1).alias("_one")))
    inner = [f"_dup_{i}" for i in range(len(docs.columns))]
    held = dict(zip(docs.columns, inner))
    rows = docs.toDF(*inner).withColumn("_dup_row", F.unhex(row_key(held[id_col], held[text_col])))
    joined = rows.join(kept, rows["_dup_row"] == kept["row"])
    # rows with one id and text: the join has brought them together in this order already
    order = Window.partitionBy("_dup_row").orderBy("_dup_row")
    return (joined.withColumn("_dup_n", F.row_number().over(order)).where("_dup_n = 1")
            .select(*[F.col(i).alias(n) for n, i in zip(docs.columns, inner)]))
