"""Token ids as raw shards, with a minimal perfect hash index over them.

Writing: documents are range-partitioned and sorted by id, every task
encodes its documents and appends their ids to its own shards. A shard is
raw little-endian ids (two bytes each if the vocabulary fits, else four),
nothing else. Where each document lies is written beside as a table.

Index: keys are dealt by hash to index files of bounded size. A file holds
a minimal perfect hash (levels of bit arrays; a key that collides at one
level goes on to the next) and, at each key's slot, a stored fingerprint,
the shard, the first id and the number of ids. A lookup is a hash, a few bit
tests and one record, whatever the number of documents; keys that were never
stored fail the fingerprint.

Files have names of their own per task attempt, and only those named in the
committed tables count, so a lost executor's half-written files are ignored.
Files are written and read through the file system that the URI names.
"""

from __future__ import annotations

import json
import os
import unicodedata
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


MAGIC = b"CLMPH001"
RECORD = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("start", "<u8"), ("n", "<u8")])
GAMMA = 2.0  # bits a key at each level
MEMO_WORDS, MEMO_TAILS = 800_000, 10_000
#: ASCII punctuation that neither begins a contraction nor a special token.
TAIL = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


@dataclass(frozen=True)
class TokenStore:
    """A written store: ``entries`` and ``index`` tables and the files they name."""
    root: str
    width: int  # bytes an id

    def entries(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/entries")

    def index(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/index")


class Encoder:
    """Encodes whole texts; if ``by_word``, each distinct word once.

    By word is right for byte-pair tokenizers that drop white space, part
    letters from all else and mark word ends: then a text's ids are those of
    its words in a row, a word of letters and punctuation after them has the
    ids of both in a row, and a word of letters alone ends where its only
    end-of-word id stands, so new words are encoded together.
    """

    def __init__(self, tokenizer_path: str, by_word: bool, width: int, end_id: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker a core already
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.by_word, self.kind = by_word, np.dtype(f"<u{width}")
        self.end = b"" if end_id is None else np.array([end_id], self.kind).tobytes()
        self.known: dict[bytes, bytes] = {}
        suffix = self.tokenizer.model.end_of_word_suffix if by_word else None
        ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        if suffix:
            ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.ends_word, self.suffix = ends, suffix
        self.tails: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[bytes]) -> bool:
        """Encode words of letters alone; False if their ids can't be parted."""
        line = " ".join([w.decode() for w in words])
        ids = np.array(self.tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, self.kind)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):  # each word has one end at least
            return False
        data, size = ids.tobytes(), self.kind.itemsize
        edges = [0, *(ends * size).tolist()]
        self.known.update(zip(words, [data[i:j] for i, j in zip(edges, edges[1:])]))
        return True

    def _learn(self, new: set[bytes]) -> None:
        stems, tailed, rest = set(), [], []
        for w in new:
            stem = w.rstrip(TAIL)
            if not (stem.isalpha() or unicodedata.normalize("NFC", stem.decode()).lower().isalpha()):
                rest.append(w)
                continue
            stems.add(stem)
            if len(stem) < len(w):
                tailed.append((w, stem, w[len(stem):]))
        letters = list(stems.difference(self.known))
        if not self.suffix:
            rest, letters = rest + letters, []
        for lo in range(0, len(letters), 500):
            part = letters[lo:lo + 500]
            if not self._letters(part):
                rest += part
        self.known.update(zip(rest, self._ids([w.decode() for w in rest])))
        if tails := list({t for _, _, t in tailed}.difference(self.tails)):
            if len(self.tails) > MEMO_TAILS:
                self.tails.clear()
                tails = list({t for _, _, t in tailed})
            self.tails.update(zip(tails, self._ids([t.decode() for t in tails])))
        for w, stem, tail in tailed:
            self.known[w] = self.known[stem] + self.tails[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [x + self.end for x in self._ids(texts)]
        # lower-casing A-Z here only makes more words equal: the tokenizer does it too, but never to special tokens
        split = [t.encode() for t in texts]
        split = [(t if b"<|" in t else t.lower()).split() for t in split]
        words = set().union(*split)
        if len(self.known) > MEMO_WORDS:  # what these texts hold stays
            self.known = {w: self.known[w] for w in words.intersection(self.known)}
        known = self.known
        if new := words.difference(known):
            self._learn(new)
        return [b"".join(map(known.__getitem__, words)) + self.end for words in split]


_ENCODERS: dict[tuple, Encoder] = {}


def worker_encoder(*made_with) -> Encoder:
    """The encoder of this Python worker: a later task finds the words that
    earlier ones learned. Only the last one asked for is kept."""
    if made_with not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[made_with] = Encoder(*made_with)
    return _ENCODERS[made_with]


def _open(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root)


def write_tokens(docs: DataFrame, root: str, tokenizer_path: str, vocabulary: int, end_id: int | None = 1,
                 by_word: bool = False, id_col: str = "doc_id", text_col: str = "text",
                 shard_bytes: int = 256 << 20, keys_per_file: int = 200_000,
                 partitions: int | None = None) -> TokenStore:
    """Encode every whole text (null: empty), in ascending id order (null
    ids first), and index it. A repeated id is stored once per row and found
    as occurrence 0, 1, ... Other columns are ignored. An empty table gives
    a store without entries."""
    width = 2 if vocabulary <= 1 << 16 else 4
    id_type = docs.schema[id_col].dataType.simpleString()
    spark = docs.sparkSession
    local = root.startswith("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = _open(root)
        encoder = worker_encoder(tokenizer_path, by_word, width, end_id)
        part, seq, out, name, at = TaskContext.get().partitionId(), 0, None, "", 0
        last, again = object(), 0
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                rows = []
                ids = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
                for key, data in zip(batch.column("doc_id").to_pylist(), ids):
                    again = again + 1 if key == last else 0
                    last = key
                    if out is None or at >= shard_bytes:
                        if out is not None:
                            out.close()
                        name, at, seq = f"ids-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.bin", 0, seq + 1
                        if local:
                            os.makedirs(base, exist_ok=True)
                        out = where.open_output_stream(f"{base}/{name}")
                    out.write(data)
                    rows.append((again, name, at // width, len(data) // width))
                    at += len(data)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows), (
                        pa.int64(), pa.string(), pa.int64(), pa.int64())))],
                    names=["doc_id", "occurrence", "shard", "first", "n_tokens"])
        if out is not None:
            out.close()

    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    (given.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
     .mapInArrow(run, f"doc_id {id_type}, occurrence long, shard string, first long, n_tokens long")
     .write.parquet(f"{root}/entries"))
    store = TokenStore(root, width)
    _write_index(spark, store, keys_per_file)
    return store


def _hashes(n_files: int) -> list[Column]:
    """File number and two 64-bit hashes of a key."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("#"), F.col("occurrence"))
    return [F.pmod(F.xxhash64(key, F.lit("file")), F.lit(n_files)).cast("int").alias("file_no"),
            F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("mark"), key).alias("h2")]


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    x = h1 + h2 * np.uint64(2 * level + 1)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return ((x ^ (x >> np.uint64(33))) % np.uint64(size)).astype(np.int64)


def build_hash(h1: np.ndarray, h2: np.ndarray) -> list[np.ndarray]:
    """Bit arrays, one per level, in which every key has one bit of its own."""
    out, left = [], np.arange(len(h1))
    while len(left):
        if len(out) > 200:
            raise ValueError("two keys have equal 128-bit hashes")
        size = max(64, int(GAMMA * len(left)))
        at = _positions(h1[left], h2[left], len(out), size)
        alone = np.bincount(at, minlength=size) == 1
        out.append(alone)
        left = left[~alone[at]]
    return out


def slots(levels: list[np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Slot of each key, 0..n-1 for the keys the hash was built from; -1 or
    any slot for others."""
    out, left, before = np.full(len(h1), -1, dtype=np.int64), np.arange(len(h1)), 0
    for level, bits in enumerate(levels):
        rank = np.cumsum(bits)
        at = _positions(h1[left], h2[left], level, len(bits))
        hit = bits[at]
        out[left[hit]] = before + rank[at[hit]] - 1
        left, before = left[~hit], before + int(rank[-1])
    return out


def _pack(levels: list[np.ndarray], shards: list[str], records: np.ndarray) -> bytes:
    head = json.dumps({"levels": [len(b) for b in levels], "shards": shards, "n": len(records)}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head,
                     *(np.packbits(b, bitorder="little").tobytes() for b in levels), records.tobytes()])


def _unpack(data: bytes) -> tuple[list[np.ndarray], list[str], np.ndarray]:
    if data[:8] != MAGIC:
        raise ValueError("not an index file")
    at = 12 + int.from_bytes(data[8:12], "little")
    head, levels = json.loads(data[12:at]), []
    for size in head["levels"]:
        end = at + -(-size // 8)
        levels.append(np.unpackbits(np.frombuffer(data[at:end], np.uint8), count=size, bitorder="little").astype(bool))
        at = end
    return levels, head["shards"], np.frombuffer(data[at:], RECORD, head["n"])


def _write_index(spark: SparkSession, store: TokenStore, keys_per_file: int) -> None:
    entries = store.entries(spark)
    n_files = max(1, -(-entries.count() // keys_per_file))
    root = store.root

    def build(part):
        h1, h2 = part["h1"].to_numpy(np.int64).view(np.uint64), part["h2"].to_numpy(np.int64).view(np.uint64)
        levels = build_hash(h1, h2)
        names, codes = np.unique(part["shard"].to_numpy(str), return_inverse=True)
        records = np.zeros(len(part), RECORD)
        at = slots(levels, h1, h2)
        for field, values in (("mark", h2 & np.uint64(0xFFFFFFFF)), ("shard", codes),
                              ("start", part["first"].to_numpy()), ("n", part["n_tokens"].to_numpy())):
            records[field][at] = values
        where, base = _open(root)
        name = f"keys-{part['file_no'].iloc[0]:06d}-{uuid.uuid4().hex}.mph"
        with where.open_output_stream(f"{base}/{name}") as out:
            out.write(_pack(levels, names.tolist(), records))
        return part.iloc[:1][["file_no"]].assign(file=name, n_keys=len(part))

    (entries.select(*_hashes(n_files), "shard", "first", "n_tokens").groupBy("file_no")
     .applyInPandas(build, "file_no int, file string, n_keys long").write.parquet(f"{root}/index"))


def locate(spark: SparkSession, store: TokenStore, keys: DataFrame) -> DataFrame:
    """``doc_id, occurrence`` -> with ``shard, first, n_tokens`` from the
    index files; null where the store has no such key."""
    index = store.index(spark)
    n_files = index.count()
    root = store.root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = _open(root)
        name, held = None, None
        for batch in batches:
            files = np.array(batch.column("file").to_pylist(), dtype=object)
            h1 = batch.column("h1").to_numpy().view(np.uint64)
            h2 = batch.column("h2").to_numpy().view(np.uint64)
            shard, first, n = np.full(len(files), None, dtype=object), np.zeros(len(files), np.int64), np.zeros(len(files), np.int64)
            for file in dict.fromkeys(files.tolist()):
                if file is None:
                    continue
                if file != name:
                    with where.open_input_stream(f"{base}/{file}") as f:
                        name, held = file, _unpack(f.read())
                levels, names, records = held
                rows = np.flatnonzero(files == file)
                at = slots(levels, h1[rows], h2[rows])
                good = at >= 0
                good[good] = records["mark"][at[good]] == (h2[rows][good] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                rows, found = rows[good], records[at[good]]
                shard[rows] = np.array(names, dtype=object)[found["shard"]]
                first[rows], n[rows] = found["start"], found["n"]
            missing = np.array([s is None for s in shard], dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("occurrence"), pa.array(shard.tolist(), pa.string()),
                 pa.array(first, mask=missing), pa.array(n, mask=missing)],
                names=["doc_id", "occurrence", "shard", "first", "n_tokens"])

    hashed = keys.select("doc_id", "occurrence", *_hashes(max(n_files, 1)))
    named = hashed.join(index.select("file_no", "file"), "file_no", "left")
    id_type = keys.schema["doc_id"].dataType.simpleString()
    return (named.repartition("file_no").sortWithinPartitions("file").select("doc_id", "occurrence", "file", "h1", "h2")
            .mapInArrow(run, f"doc_id {id_type}, occurrence long, shard string, first long, n_tokens long"))


def _read(store: TokenStore, located: DataFrame, value: Callable[[bytes], object], kind: pa.DataType,
          sql_kind: str) -> DataFrame:
    """``value`` of each located document's raw ids, read from its shard."""
    root, width = store.root, store.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = _open(root)
        name, f = None, None
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch, values = whole.slice(lo, 1000), []
                for shard, first, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "first", "n_tokens"))):
                    if shard is None:
                        values.append(None)
                        continue
                    if shard != name:
                        if f is not None:
                            f.close()
                        name, f = shard, where.open_input_file(f"{base}/{shard}")
                    data = f.read_at(n * width, first * width)
                    if len(data) != n * width:
                        raise ValueError(f"{shard} is shorter than its entries say")
                    values.append(value(data))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, kind)],
                                                 names=[*batch.schema.names, "value"])
        if f is not None:
            f.close()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in located.schema.fields)
    return (located.repartition("shard").sortWithinPartitions("shard", "first")
            .mapInArrow(run, f"{schema}, value {sql_kind}"))


def fetch(spark: SparkSession, store: TokenStore, keys: DataFrame) -> DataFrame:
    """``doc_id`` (and ``occurrence``, else 0) -> with ``ids array<long>``,
    null where the store has no such key."""
    width = store.width
    keys = keys if "occurrence" in keys.columns else keys.withColumn("occurrence", F.lit(0).cast("long"))
    rows = _read(store, locate(spark, store, keys.select("doc_id", F.col("occurrence").cast("long").alias("occurrence"))),
                 lambda data: np.frombuffer(data, f"<u{width}").astype(np.int64).tolist(), pa.list_(pa.int64()), "array<long>")
    return rows.select("doc_id", "occurrence", F.col("value").alias("ids"))


def digests(spark: SparkSession, store: TokenStore) -> DataFrame:
    """Every stored document, found by its key in the index and read from
    its shard: ``doc_id, start, n_tokens, ids_crc32``. ``start`` counts the
    ids of all documents before it; the checksum is over ids of 32 bits."""
    width = store.width
    entries = store.entries(spark)
    shards = entries.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    # one row a shard; shard names sort in document order
    before = Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select(F.col("shard").alias("_shard"), "_n").withColumn(
        "_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    found = _read(store, locate(spark, store, entries.select("doc_id", "occurrence")),
                  lambda data: zlib.crc32(np.frombuffer(data, f"<u{width}").astype("<u4").tobytes()), pa.int64(), "long")
    return (found.join(bases, found["shard"] == bases["_shard"])
            .select("doc_id", (F.col("_base") + F.col("first")).alias("start"), "n_tokens",
                    F.col("value").alias("ids_crc32")))


