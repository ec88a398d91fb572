"""What is wrong with a record, field by field.

``decode_json`` gives null for a field that is absent, null or of another
type, and ``split_valid`` calls all three missing. Here the text is parsed
once more as a VARIANT, which keeps what was written, so that each fault has
its own reason and the offending value:

``absent``          the object has no such field
``null``            it has, and it is null
``wrong type``      its value doesn't fit the field (``40.5``, ``40.0`` or ``"40"``
                    for an int, ``"1.5"`` for a double)
``not a number``    NaN
``out of range``    a good value outside the rule's bounds or list
``unreadable``      the field has no value and the text isn't strict JSON
                    (repeated keys, single quotes), so more can't be said
``not an object``   no field can be read: no JSON, null, an array, a scalar;
                    one fault of the whole record, its value the text

Decoded values are those of ``decode_json``: a number in a text field is its
text, further keys are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clasp.streaming.decode import decode_json

FAULT = "array<struct<field string, reason string, value string>>"


@dataclass(frozen=True)
class Rule:
    """A field, its type, and what its values must be. A field that isn't
    ``required`` may be absent or null, but not of another type."""
    field: str
    kind: str
    required: bool = True
    low: float | None = None
    high: float | None = None
    among: tuple = ()

    @property
    def path(self) -> str:
        quote = '"' if "'" in self.field else "'"
        return f"$[{quote}{self.field}{quote}]"


def _reason(rule: Rule, strict: Column, kind: Column) -> Column:
    """Null for a good field. ``strict``: the text is a JSON object as the
    standard has it; ``kind``: the type of what was written."""
    value, no = F.col(f"`{rule.field}`"), F.lit(None).cast("string")
    need = F.lit(rule.required)
    out = (F.when(strict & kind.isNull(), F.when(need, "absent").otherwise(no))
           .when(strict & (kind == "VOID"), F.when(need, "null").otherwise(no))
           .when(strict & value.isNull(), "wrong type")
           .when(value.isNull(), F.when(need, "unreadable").otherwise(no)))
    if rule.kind in ("double", "float"):
        out = out.when(F.isnan(value), "not a number")
    if rule.low is not None:
        out = out.when(value < rule.low, "out of range")
    if rule.high is not None:
        out = out.when(value > rule.high, "out of range")
    if rule.among:
        out = out.when(~value.isin(*rule.among), "out of range")
    return out.otherwise(no)


def diagnose(df: DataFrame, rules: list[Rule], value_col: str = "value", keep: list[str] | tuple = ()) -> DataFrame:
    """``keep``, ``_raw`` (the text), the decoded fields and ``faults``, an
    array of ``(field, reason, value)`` in the order of the rules, empty for a
    valid record."""
    schema = ", ".join(f"`{r.field}` {r.kind}" for r in rules)
    rows = decode_json(df, schema, value_col, keep=keep, keep_raw=True).withColumn("_v", F.try_parse_json("_raw"))
    rows = rows.withColumns({
        "_object": F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)),
        "_texts": F.from_json("_raw", "map<string,string>")})
    some = reduce(lambda a, b: a | b, [F.col(f"`{r.field}`").isNotNull() for r in rules])
    whole = ~F.col("_object") & (F.col("_v").isNotNull() | ~some)
    faults = []
    for r in rules:
        written = F.try_variant_get("_v", r.path, "variant")
        kind = F.schema_of_variant(written)
        text = F.when(kind == "STRING", F.to_json(written)).otherwise(F.try_element_at("_texts", F.lit(r.field)))
        reason = _reason(r, F.col("_object"), kind)
        text = F.when(reason == "not a number", "NaN").when(reason.isin("absent", "null"), F.lit(None)).otherwise(text)
        faults.append(F.when(reason.isNotNull(), F.struct(F.lit(r.field).alias("field"), reason.alias("reason"), text.alias("value"))))
    record = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit("not an object").alias("reason"),
                              F.col("_raw").alias("value")))
    out = F.when(whole, record).otherwise(F.array_compact(F.array(*faults))).cast(FAULT)
    return rows.withColumn("faults", out).drop("_v", "_object", "_texts")


def split_diagnosed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without ``_raw`` and ``faults``, and the rest with both
    and a ``reason`` that lists the faults."""
    valid = df.where(F.size("faults") == 0).drop("faults", "_raw")
    said = F.transform("faults", lambda f: F.concat_ws(" ", f["field"], f["reason"]))
    return valid, df.where(F.size("faults") > 0).withColumn("reason", F.array_join(said, ", "))


def fault_counts(bad: DataFrame) -> DataFrame:
    """How often each fault with each value was met."""
    return (bad.select(F.explode("faults").alias("f")).groupBy("f.field", "f.reason", "f.value")
            .agg(F.count(F.lit(1)).alias("n")))
