"""The pipeline against a plain version of its stages."""

import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from clasp.llm import language
from clasp.llm.decontamination import MIN_MATCH, THRESHOLD, tokens
from clasp.llm.queries import tokenizer_path
from clasp.session import scratch_path
from tests.llm.test_decontamination import plain_tiles
from tests.llm.test_mixing import ORACLE
from tests.llm.test_simhash import roots, signed, slow_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key int, size long"


def corpus():
    r = random.Random(11)
    vocab = {"aa": ["alpha", "arbor", "amber", "acre"], "bb": ["bible", "bubo", "bob", "blub"]}
    item = " ".join(f"secret{i}" for i in range(20))
    rows = []
    for i in range(120):
        lang = "aa" if i % 3 else "bb"
        text = " ".join(r.choice(vocab[lang]) + str(r.randint(0, 30)) for _ in range(r.randint(20, 120)))
        rows.append([i, text, lang, ["s1", "s2", None, "s1"][i % 4]])
    rows[10][1] = rows[11][1] + " \n "
    rows[12][1] = rows[13][1].upper()
    rows[20][1] += " " + item
    rows[21][1] = None
    rows[22][1] = "12 34 ..."
    rows[23][1] = ""
    rows[24][1] = "acre " * 30_000
    rows.append(list(rows[30]))
    rows.append([None, "amber alpha with no id at all", "aa", "s2"])
    return [(*x, 1, "c", 2, 3) for x in rows], [(1, item), (2, None)]


def plain(rows, items, model):
    score = language.Scorer(model)
    kept = [x for x in rows if (s := score(x[1]))[0] != "und" and s[1] >= 0.5]
    root = roots([signed(slow_fingerprint(x[1])) for x in kept])
    first = {}
    for x in sorted(kept, key=lambda x: (x[0] is None, x[0] or 0)):
        first.setdefault(root[signed(slow_fingerprint(x[1]))], x)
    kept = list(first.values())

    def leaks(text):
        return any(sum(t[2] for t in plain_tiles(w, tokens(text), min(MIN_MATCH, len(w)))) >= THRESHOLD * len(w)
                   for _, t in items if (w := tokens(t)))
    kept = [x for x in kept if len(tokens(x[1])) > 5_000 or not leaks(x[1])]
    return kept


@pytest.fixture(scope="module")
def tables(spark):
    d = scratch_path(spark, "t-pipeline")
    rows, items = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, items


def test_stages(spark, tables):
    import duckdb
    import pandas as pd
    d, rows, items = tables
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = plain(rows, items, language.fit(docs))
    assert 21 not in {x[0] for x in kept} and 20 not in {x[0] for x in kept} and 11 not in {x[0] for x in kept}
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        frame = corpus_pipeline.cut(stage(spark, frame, d), "t")
        assert frame.columns == docs.columns
    assert sorted(map(str, frame.collect())) == sorted(map(str, (spark.createDataFrame(kept, SCHEMA).collect())))
    documents = pd.DataFrame([x[:4] for x in kept], columns=["doc_id", "text", "lang", "source"]).astype({"doc_id": "Int64"})
    con = duckdb.connect()
    con.register("documents", documents)
    copies = {}
    for i, size, _, _, taken in con.execute(ORACLE).fetchall():
        copies[i] = taken // size + (2 * (taken % size) >= size and taken % size > 0)
    mixed = corpus_pipeline.cut(corpus_pipeline.mix(spark, frame, d), "t")
    got = {}
    for x in mixed.collect():
        got[x.doc_id] = got.get(x.doc_id, 0) + 1
    assert mixed.columns == docs.columns and got == {i: n for i, n in copies.items() if n}
    t, texts, at = Tokenizer.from_file(tokenizer_path()), {x[0]: x[1] for x in kept}, 0
    out = sorted(corpus_pipeline.run(spark, d).collect(), key=lambda x: x.start)
    assert [x.doc_id for x in out] == sorted((i for i, n in got.items() for _ in range(n)), key=lambda i: (i is not None, i or 0))
    for x in out:
        ids = [*t.encode(texts[x.doc_id], add_special_tokens=False).ids, 1]
        assert (x.start, x.n_tokens, x.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_empty_tables(spark, tables):
    d = scratch_path(spark, "t-pipeline")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0


def test_stage_names_and_registration():
    import __spark_entry__ as E
    assert len(corpus_pipeline.STAGES) == 5 and "pipeline" in E.queries()
    assert [k for k in E.queries() if re.match(r"op\d+_", k)][:2] == ["op1_simhash", "op2_neighbours"]
