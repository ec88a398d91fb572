"""Mixing: exact budgets, cases the SQL comparison doesn't reach."""

import duckdb
import pytest

from clasp.llm.mixing import ORACLE, mix, mixed_documents

SCHEMA = "doc_id long, text string, source string, key string, size int"


def rows(n=300):
    out = [(i, " ".join(["w"] * (1 + i * 7 % 50)), [None, "a", "b", "é", "hot", "hot", "hot"][i % 7], "k", 1) for i in range(n)]
    return out + [(5, None, "a", None, None), (6, "", "empty", None, None), (None, "x y", "a", None, None),
                  (7, "same same same", "b", None, None), (7, "same same same", "b", None, None), (9, "w " * 30000, "big", None, None)]


@pytest.mark.parametrize("per_range", [3, 50_000])
def test_equals_sql(spark, per_range):
    df = spark.createDataFrame(rows(), SCHEMA)
    documents = df.toPandas()  # noqa: F841  read by DuckDB
    con = duckdb.connect()
    want = con.execute(ORACLE).fetchall()
    got = [tuple(r) for r in mix(df, rows_per_range=per_range).collect()]
    order = lambda r: tuple((x is None, x) for x in r)
    fixed = lambda rs: sorted(((None if i != i else i, int(s), int(t), round(g, 6), int(k)) for i, s, t, g, k in rs), key=order)
    assert fixed(got) == fixed(want)


def test_budgets(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    by = {}
    for r in mix(df).collect():
        assert 0 <= r.taken <= 3 * r.size
        t = by.setdefault(r.target, [0, r.source_size])
        t[0] += r.taken
    total = sum(s for _, s in by.values())
    assert abs(sum(by) - total) < 1e-6 * total
    for target, (taken, size) in by.items():
        assert abs(taken - target) <= 2 and target <= 3 * size + 1e-9


def test_documents_keep_columns_and_repeat(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    out = mixed_documents(df)
    assert out.columns == df.columns
    n = out.groupBy("doc_id", "text", "source").count().collect()
    assert 0 < max(r["count"] for r in n) <= 6
    again = sorted(map(str, mixed_documents(df.repartition(5), rows_per_range=10).collect()))
    assert again == sorted(map(str, out.collect()))


def test_empty_and_wordless(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    none = mix(spark.createDataFrame([(1, None, None, None, None), (2, " ", "a", None, None)], SCHEMA)).collect()
    assert [(r.size, r.target, r.taken) for r in none] == [(0, 0.0, 0), (0, 0.0, 0)]
