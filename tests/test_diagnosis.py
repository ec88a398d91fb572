"""Reasons of bad records: the decoding facts, each told apart."""

import pytest
from pyspark.sql import functions as F

from clasp.session import scratch_path
from clasp.sources.specs import StreamSpec
from clasp.streaming.diagnosis import Rule, diagnose, fault_counts, split_diagnosed
from clasp.streaming.sinks import idempotent_batch_writer, read_sink, run_until_idle, write_stream
from clasp.streaming.sources import open_stream

RULES = [Rule("Age", "int", low=0, high=150), Rule("Sex", "string", among=("M", "F", "5")), Rule("Oldpeak", "double", required=False, low=-10)]
GOOD = '"Sex":"M","Oldpeak":1.5'
CASES = [
    ('{"Age":40,' + GOOD + "}", []),
    ('{"Age":40,' + GOOD + ',"more":[1,{"Age":2}]}', []),
    ('{"Age":40.5,' + GOOD + "}", [("Age", "wrong type", "40.5")]),
    ('{"Age":40.0,' + GOOD + "}", [("Age", "wrong type", "40.0")]),
    ('{"Age":"40",' + GOOD + "}", [("Age", "wrong type", '"40"')]),
    ('{"Age":true,' + GOOD + "}", [("Age", "wrong type", "true")]),
    ('{"Age":[40],' + GOOD + "}", [("Age", "wrong type", "[40]")]),
    ('{"Age":99999999999,' + GOOD + "}", [("Age", "wrong type", "99999999999")]),
    ('{"Age":151,' + GOOD + "}", [("Age", "out of range", "151")]),
    ('{"Age":null,' + GOOD + "}", [("Age", "null", None)]),
    ("{" + GOOD + "}", [("Age", "absent", None)]),
    ('{"Age":40,"Sex":5,"Oldpeak":0}', []),
    ('{"Age":40,"Sex":"X","Oldpeak":0}', [("Sex", "out of range", '"X"')]),
    ('{"Age":40,"Sex":"M"}', []),
    ('{"Age":40,"Sex":"M","Oldpeak":null}', []),
    ('{"Age":40,"Sex":"M","Oldpeak":"1.5"}', [("Oldpeak", "wrong type", '"1.5"')]),
    ('{"Age":40,"Sex":"M","Oldpeak":NaN}', [("Oldpeak", "not a number", "NaN")]),
    ('{"Age":40,"Sex":"M","Oldpeak":-11}', [("Oldpeak", "out of range", "-11")]),
    ('{"Age":-1,"Sex":null}', [("Age", "out of range", "-1"), ("Sex", "null", None)]),
    ('{"Age":40,"Age":41,"Oldpeak":2}', [("Sex", "unreadable", None)]),
    ("{'Age':40,'Sex':'M'}", []),
    ("no json", [(None, "not an object", "no json")]),
    ("", [(None, "not an object", "")]),
    ("null", [(None, "not an object", "null")]),
    ("[1,2]", [(None, "not an object", "[1,2]")]),
    ('"text"', [(None, "not an object", '"text"')]),
    ("{}", [("Age", "absent", None), ("Sex", "absent", None)]),
]


def test_each_fault_has_its_reason(spark):
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(CASES)] + [(99, None)], "i int, value string").repartition(3)
    got = {x.i: [tuple(f) for f in x.faults] for x in diagnose(df, RULES, keep=["i"]).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)} | {99: [(None, "not an object", None)]}


def test_decoded_values_and_bytes(spark):
    df = spark.createDataFrame([(bytearray(CASES[11][0].encode()),)], "value binary")
    row = diagnose(df, RULES).first()
    assert (row.Age, row.Sex, row.Oldpeak, row["_raw"]) == (40, "5", 0.0, CASES[11][0])


def test_odd_field_names(spark):
    rules = [Rule("a b", "int"), Rule("it's", "string", required=False), Rule("x.y", "int")]
    df = spark.createDataFrame([('{"a b":1,"it\'s":"q","x.y":2}',), ('{"a b":"1","x":{"y":2}}',)], "value string")
    got = sorted([tuple(f) for f in x.faults] for x in diagnose(df, rules).collect())
    assert got == [[], [("a b", "wrong type", '"1"'), ("x.y", "absent", None)]]


def test_stream_goes_on_and_keeps_both_parts(spark):
    path, sink, aside = (scratch_path(spark, x) for x in ("t-diag", "t-diag-sink", "t-diag-aside"))
    spark.createDataFrame([(raw,) for raw, _ in CASES if raw], "value string").write.text(path)
    stream = diagnose(open_stream(spark, StreamSpec(format="text", path=path)), RULES)
    q = write_stream(stream, idempotent_batch_writer(sink, split=split_diagnosed, quarantine_path=aside), scratch_path(spark, "ck"),
                     "t_diagnosis", trigger={"availableNow": True})
    run_until_idle(q)
    assert read_sink(spark, sink).count() == sum(not f for raw, f in CASES if raw)
    bad = read_sink(spark, aside)
    assert bad.count() == sum(bool(f) for raw, f in CASES if raw)
    assert {(x.field, x.reason): x.n for x in fault_counts(bad).where("reason = 'absent'").collect()} == {("Age", "absent"): 2, ("Sex", "absent"): 1}
    assert bad.where(F.col("reason") == "Age out of range, Sex null").count() == 1
