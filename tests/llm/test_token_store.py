"""Round trips through shards and the minimal perfect hash index."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clasp.llm import token_store
from clasp.llm.token_store import Encoder, build_hash, digests, fetch, slots, write_tokens
from clasp.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, shard string, first int"
ODD = ["<|endoftext|> Hello<|ENDOFTEXT|> x", "İstanbul ǅ ́a é Å K", "it's don't 'Ll 12ab ..' a'​s",
       "a\x85b\x1cc\x1db c　d", "ΑΣ ΣΑΣ σς.", " ", "", "日本語 テスト 😀😀 a😀b", "end. End, end.. ., .", "tab\x01bed \x01",
       "é. ñ, straße. ß", "x" * 3000 + ". " + "y" * 2000]


def whole(texts, end=1):
    t = Tokenizer.from_file(PATH)
    return [[*t.encode(x or "", add_special_tokens=False).ids, end] for x in texts]


def test_by_word_equals_whole_texts():
    r = random.Random(2)
    chars = list("abcXYZ'., \n\té́ßİσΣ9€🙂‍<|>-") + ["'s", "'ll ", "the "]
    texts = ODD + ["".join(r.choice(chars) for _ in range(r.randint(0, 200))) for _ in range(400)]
    e = Encoder(PATH, True, 2, 1)
    for _ in range(2):
        assert [np.frombuffer(x, "<u2").tolist() for x in e.encode(texts)] == whole(texts)


def test_documents_of_the_tables(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    e = Encoder(PATH, True, 4, None)
    t = Tokenizer.from_file(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)] == [
        t.encode(x, add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 20_000])
def test_hash_is_minimal_and_perfect(n):
    g = np.random.default_rng(n)
    h1, h2 = g.integers(0, 2**63, n).astype("u8"), g.integers(0, 2**63, n).astype("u8")
    at = slots(build_hash(h1, h2), h1, h2)
    assert sorted(at.tolist()) == list(range(n))


def test_equal_hashes_are_refused():
    same = np.array([5, 5], dtype="u8")
    with pytest.raises(ValueError):
        build_hash(same, same)


@pytest.mark.parametrize("by_word,vocabulary", [(True, 49_408), (False, 1 << 20)])
def test_round_trip(spark, by_word, vocabulary):
    texts = ODD + [None, "repeated", "repeated", "of one id", "no id"]
    ids = [3 * i for i in range(len(ODD))] + [1, 7, 7, 7, None]
    df = spark.createDataFrame([(i, t, "x", None) for i, t in zip(ids, texts)], SCHEMA).repartition(4)
    store = write_tokens(df, scratch_path(spark, "t-store"), PATH, vocabulary, by_word=by_word,
                         shard_bytes=20, keys_per_file=5, partitions=3)
    rows = sorted(digests(spark, store).collect(), key=lambda r: r.start)
    assert [-1 if r.doc_id is None else r.doc_id for r in rows] == sorted(-1 if i is None else i for i in ids)
    want = {}
    for i, x in zip(ids, whole(texts)):
        want.setdefault(i, []).append((len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
    at, got = 0, {}
    for r in rows:
        assert r.start == at
        at += r.n_tokens
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    keys = spark.createDataFrame([(0, 0), (7, 0), (7, 2), (7, 3), (12345, 0), (None, 0)], "doc_id long, occurrence long")
    found = {(r.doc_id, r.occurrence): r.ids for r in fetch(spark, store, keys).collect()}
    assert found[0, 0] == whole(ODD[:1])[0] and found[None, 0] == whole(["no id"])[0]
    assert found[7, 3] is None and found[12345, 0] is None and found[7, 2] is not None
    assert store.entries(spark).select("shard").distinct().count() > 3 and store.index(spark).count() > 2


def test_empty_table(spark):
    store = write_tokens(spark.createDataFrame([], SCHEMA), scratch_path(spark, "t-store"), PATH, 49_408, by_word=True)
    assert digests(spark, store).count() == 0
    assert fetch(spark, store, spark.createDataFrame([(1,)], "doc_id long")).first().ids is None


def test_punctuation_after_letters_is_encoded_once(monkeypatch):
    """Words that differ by the punctuation behind them share their letters' ids."""
    stems = ["harbour", "straße", "Ω", "queue"]
    texts = [" ".join(s + t for s in stems for t in ("", ".%%%", "###", ",***", "!?", "'", "|>", "<", "_"))]
    e, seen = Encoder(PATH, True, 2, 1), []
    plainly = e._ids
    monkeypatch.setattr(e, "_ids", lambda words: seen.extend(words) or plainly(words))
    assert [np.frombuffer(x, "<u2").tolist() for x in e.encode(texts)] == whole(texts)
    assert not [w for w in seen if w.rstrip("%#*!?_.,").lower() in stems and w.lower() not in stems]


def test_a_full_memo_keeps_the_words_at_hand(monkeypatch):
    monkeypatch.setattr(token_store, "MEMO_WORDS", 3)
    monkeypatch.setattr(token_store, "MEMO_TAILS", 1)
    e = Encoder(PATH, True, 2, 1)
    for texts in (["a b c d. e?"], ["c d. x!! y"], ["c, q;"], ["", "z% z# z"]):
        assert [np.frombuffer(x, "<u2").tolist() for x in e.encode(texts)] == whole(texts)
    assert b"a" not in e.known


def test_a_worker_keeps_its_encoder():
    one = token_store.worker_encoder(PATH, True, 2, 1)
    assert token_store.worker_encoder(PATH, True, 2, 1) is one
    assert token_store.worker_encoder(PATH, True, 4, 1) is not one
