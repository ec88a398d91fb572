"""Base spans against the plain patterns; what the trees add."""

import hashlib
import random
import re

import pytest

from clasp.llm.pii import KINDS, all_spans, base_spans, candidates, find, fit, joined, luhn, made_up, redact

SCHEMA = "doc_id long, text string, spans string, n_ip int"
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PLAIN[kind], text):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                  "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_base_spans_equal_the_patterns(seed):
    r = random.Random(seed)
    chars = ["a", "Z", "1", "22", "4111 1111 1111 1111", "@", ".", "-", "+", " ", "(", ")", "é", "😀", "255", "256", "%",
             "x@y.z", "+1 (555) 123-4567", "10.0.0.1", "\n", "_", "0000"]
    for _ in range(60):
        t = "".join(r.choice(chars) for _ in range(r.randint(0, 60)))
        assert base_spans(t) == plain(t)


def test_long_runs_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "1 " * 100_000, "@" * 200_000):
        base_spans(t)
        assert len(candidates(t)) <= len(t)


@pytest.fixture(scope="module")
def trees(spark):
    return fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_trees_add_formats_and_leave_decoys(trees):
    r, found, wrong, good, bad = random.Random(99), 0, 0, 0, 0
    for _ in range(600):
        kind, s, personal = made_up(r)
        base, every = all_spans(f"some plain words {s} and more of them", trees)
        if personal:
            good, found = good + 1, found + any(x[0] == kind for x in every)
        else:
            bad, wrong = bad + 1, wrong + any(x not in base for x in every)
        assert set(base) <= set(every)
    assert found > 0.8 * good and wrong < 0.1 * bad


def test_probability_equals_spark(spark, trees):
    assert trees.probability([]).shape == (0,)
    assert all(0.5 <= t for t in trees.thresholds.values()) and set(trees.thresholds) == set(KINDS)


def test_documents(spark, trees):
    mail = "write to ann.lee@mail.example.com or 10.0.0.1, +1 (212) 555-0000; card 4111 1111 1111 1111"
    rows = [(1, mail, "x", 1), (1, mail, "x", 1), (2, None, None, None), (3, "", "", 0), (None, "no data", None, None),
            (4, "é😀 " * 30_000 + "b@c.de", "x", 2)]
    out = find(spark.createDataFrame(rows, SCHEMA), trees).collect()
    assert len(out) == 6
    by = {r.doc_id: r for r in out}
    assert (by[1].n_email, by[1].n_ip, by[1].n_card, by[1].n_phone) == (1, 1, 1, 1)
    assert by[1].base_sha256 == hashlib.sha256(joined(plain(mail)).encode()).hexdigest()
    assert by[1].redacted == "write to <email> or <ip>, <phone>; card <card>"
    assert by[2].spans == "" and by[2].redacted is None and by[3].redacted == "" and by[None].spans == ""
    assert by[4].spans == "email:90000:90006"
    assert find(spark.createDataFrame([], SCHEMA), trees).count() == 0
    assert fit(spark.createDataFrame([], SCHEMA), made=300, iterations=2).nodes


def test_redaction_joins_overlaps():
    assert redact("0123456789", [("ip", 2, 5), ("card", 4, 7), ("phone", 8, 9)]) == "01<ip>7<phone>9"


def test_query_equals_brute_force(spark):
    from clasp.llm.queries import op7_pii
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = op7_pii(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        base = plain(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(b[0] == k for b in base) for k in KINDS]
        assert set(joined(base).split(",")) - {""} <= set(r.spans.split(","))
