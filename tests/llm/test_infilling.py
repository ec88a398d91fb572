"""Fill-in-the-middle against a plain-Python version."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from clasp.llm import infilling

SCHEMA = "doc_id long, text string, form int, output string, _fim_text string"


def plain(i, text, unit=r"[^\n]*\n|[^\n]+", seed=7, percent=100, spm=50, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    units = [m.group() for m in re.finditer(unit, text)]
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if text == "" or any(m in text for m in marks) or h[2] % 100 >= percent:
        return "plain", n, None, None, text
    pre, mid = "".join(units[:a]), "".join(units[a:b])
    suf = text[len(pre) + len(mid):]
    p, s, m = marks
    if h[3] % 100 < spm:
        return "spm", n, len(pre), len(mid), s + suf + p + pre + m + mid
    return "psm", n, len(pre), len(mid), p + pre + s + suf + m + mid


def rows():
    r = random.Random(3)
    texts = [None, "", "\n", "\n\n\n", "no line feed", "a\r\nb\rc\n", "é\U0001f600\nß", "x <P> y\n", "<S>", "a<M>", "< P >\n<\nP>\n",
             "ends with <\n<S\n<", "$1 \\ \\$2\n{3}\n", "\u2028 \x85\nb", "w " * 40_000, "l\n" * 30_000, "long " * 20_000 + "\n" + "tail"]
    texts += ["".join(r.choice(["ab", "\n", " ", "<", "P>", "$", "\\", "日本"]) for _ in range(r.randint(0, 60))) for _ in range(300)]
    out = [(i, t, 1, "c", "d") for i, t in enumerate(texts)]
    return out + [(None, "one\ntwo\n", 1, "c", "d"), (5, texts[5], 1, "c", "d"), (2**62, "u\nv\nw\n", 1, "c", "d")]


@pytest.mark.parametrize("options", [
    {},
    {"unit": r"[^ ]* |[^ ]+", "seed": 11, "percent": 60, "spm_percent": 20},
    {"sentinels": ("\\a$1", "\x01mid", "[end]")},
])
def test_equals_plain(spark, options):
    data = rows()
    done = infilling.infill(spark.createDataFrame(data, SCHEMA).repartition(3), **options)
    marks = options.get("sentinels", infilling.SENTINELS)
    back = done.withColumn("back", infilling.restored(F.col("output"), F.col("form"), marks))
    got = sorted((str(x.doc_id), x.text, x.form, x.n_units, x.prefix_chars, x.middle_chars, x.output, x.back) for x in
                 back.withColumn("text", F.coalesce("text", F.lit(""))).collect())
    want = sorted((str(i), t or "", *plain(i, t, options.get("unit", infilling.LINES), options.get("seed", 7),
                                           options.get("percent", 100), options.get("spm_percent", 50), marks), t or "")
                  for i, t, *_ in data)
    assert got == want and {x[2] for x in got} == {"plain", "psm", "spm"}


def test_other_columns_and_empty_table(spark):
    done = infilling.infill(spark.createDataFrame(rows()[:3], SCHEMA))
    assert done.columns == ["doc_id", "text", "_fim_text", *infilling.PARTS]
    assert infilling.digests(infilling.infill(spark.createDataFrame([], SCHEMA))).count() == 0


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("<P>", "", "<M>"), ("<P<", "<S>", "<M>"), ("a", "ab", "c")])
def test_ambiguous_sentinels(spark, marks):
    with pytest.raises(ValueError):
        infilling.infill(spark.createDataFrame(rows()[:3], SCHEMA), sentinels=marks)


def test_query_equals_sql(spark):
    import duckdb
    from clasp.llm.queries import LLM_ORACLE, LLM_REGISTRY
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    want = con.execute(LLM_ORACLE["op13_infilling"]).fetchall()
    got = [tuple(x) for x in LLM_REGISTRY["op13_infilling"](spark, d).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == 1000


def test_nothing_is_shuffled(spark):
    from clasp.llm.queries import LLM_REGISTRY
    plan = LLM_REGISTRY["op13_infilling"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan
