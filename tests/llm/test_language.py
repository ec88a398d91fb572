"""Language ID: held-out accuracy and the edge rules."""

import zlib

import pytest

from clasp.llm import language
from clasp.llm.language import LONGEST, UNKNOWN, Model, Scorer, fit, grams, predict, recognised, words

SCHEMA = "doc_id long, text string, lang string, score string, lang_pred int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return fit(docs)


def test_held_out_accuracy(docs, model):
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    right = n = 0
    for r in predict(docs, model).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        lang, text = truth[r.doc_id]
        assert (r.lang_pred == UNKNOWN) == (not any(c.isalpha() for c in text))
        if r.held_out and r.lang_pred != UNKNOWN:
            n, right = n + 1, right + (r.lang_pred == lang)
    assert n > 150 and right > 0.95 * n
    assert recognised(docs, model).count() > 0.97 * docs.count()


def test_edge_rows(spark, model):
    text = "the of and that is with for to this"
    rows = [(2, text, None, "x", 1), (2, text, None, "x", 1), (None, text, "fr", None, None), (4, None, "en", None, None),
            (5, "", "en", None, None), (6, "12 34 -- !", "en", None, None), (7, text + " qqq" * 30_000, "en", None, None),
            (8, "x" * 200_000, "en", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = predict(df, model).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in (2, None, 4, 5, 6)] == ["en", "en", UNKNOWN, UNKNOWN, UNKNOWN]
    assert by[4].score == 0 and by[8].lang_pred in model.languages
    kept = recognised(df, model, 0.0)
    assert kept.columns == df.columns and kept.count() == 5
    none = fit(spark.createDataFrame([], SCHEMA))
    assert {r.lang_pred for r in predict(df, none).collect()} == {UNKNOWN}
    assert predict(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_letters_are_letters(spark, model):
    """Numerals and superscripts are no letters; marks stay in their words."""
    odd = ["\u00bd", "12 \u00b2", "\u2167", "\u0301 \u093f", "_ _", "\u2460 42"]
    out = predict(spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(odd)], SCHEMA), model).collect()
    assert {(r.lang_pred, r.score) for r in out} == {(UNKNOWN, 0.0)}
    hindi = "\u0939\u093f\u0928\u094d\u0926\u0940"
    assert words(f"{hindi} Na\u0131ve e\u0301a o'er 3rd") == [hindi, "na\u0131ve", "\u00e9a", "o", "er", "rd"]


def plain_prediction(model, text):
    """The method in plain loops, without memo or arrays."""
    found = words(text)
    if not found or not model.languages:
        return UNKNOWN, 0.0
    costs = [model.cost(w) or [language.PENALTY] * len(model.languages) for w in found]
    mean = [sum(c[i] for c in costs) / len(costs) for i in range(len(model.languages))]
    share = [10 ** ((min(mean) - m) * min(len(found), language.SURE_WORDS)) for m in mean]
    return model.languages[mean.index(min(mean))], 1 / sum(share)


def test_equals_a_plain_scorer(spark, docs, model):
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in predict(docs, model).collect():
        lang, score = plain_prediction(model, texts[r.doc_id])
        assert r.lang_pred == lang and abs(r.score - score) < 1e-9


def test_a_small_language_keeps_its_words(spark):
    """Fifty labelled rows beside four languages of two thousand, with room for few words."""
    import random
    r = random.Random(3)
    letters = {"aa": "abcd", "bb": "efgh", "cc": "ijkl", "dd": "mnop", "zz": "qrst"}
    word = lambda k: "".join(r.choice(letters[k]) for _ in range(4))
    rows = [(i, " ".join(word(k) for _ in range(30)), k, None, None) for i, k in enumerate(["aa", "bb", "cc", "dd"] * 2000 + ["zz"] * 50)]
    m = fit(spark.createDataFrame(rows, SCHEMA), max_words=500, max_grams=200)
    assert sum(set(w) <= set("qrst") for w in m.tables[0]) >= 60 and len(m.tables[0]) <= 500
    assert Scorer(m)(" ".join(word("zz") for _ in range(20)))[0] == "zz"


def test_held_out_rows_are_not_learned(spark):
    rows = [(i, "alpha beta", "xx", None, None) for i in range(60)] + [
        (i, "gamma", "yy", None, None) for i in range(4000) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert fit(spark.createDataFrame(rows, SCHEMA)).languages == ["xx"]


def test_backoff_goes_from_words_to_shorter_grams():
    tables = [{} for _ in range(LONGEST + 1)]
    tables[0]["known"] = [1.0, 5.0]
    tables[3][" ab"] = [4.0, 2.0]
    tables[1]["a"] = [0.5, 3.0]
    m = Model(["p", "q"], tables)
    assert m.cost("known") == [1.0, 5.0] and m.cost("abz") == [4.0, 2.0] and m.cost("za") == [0.5, 3.0]
    assert m.cost("zzz") is None and grams("ab", 3) == [" ab", "ab "]
    assert Scorer(m)("known known zz")[0] == "p" and Scorer(m)("abz")[0] == "q"
