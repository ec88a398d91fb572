"""Record decoding and validity split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Accept times with or without a fraction of up to six digits.
READ_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def decode_json(df: DataFrame, schema: StructType | str, value_col: str = "value",
                keep: list[str] | tuple = (), keep_raw: bool = False,
                corrupt_col: str | None = None) -> DataFrame:
    """Bytes or text -> JSON struct -> top-level columns. A value
    that is not a JSON object gives nulls in every field (PERMISSIVE); a
    field whose JSON type does not fit (``40.5`` into int) is null alone.
    ``corrupt_col`` adds a column with the text of records that can't be
    read whole."""
    raw, options = F.col(value_col).cast("string"), dict(READ_OPTIONS)
    if corrupt_col:
        fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = StructType([*fields.fields, StructField(corrupt_col, StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_col
    parsed = df.select(*keep, raw.alias("_raw"), F.from_json(raw, schema, options).alias("data"))
    out = parsed.select(*keep, *(["_raw"] if keep_raw else []), "data.*")
    return out


def split_valid(df: DataFrame, required: list[str], raw_col: str | None = "_raw"
                ) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``required`` fields are all present, and the rest
    with a ``reason`` listing the missing fields (a quarantine table), so a
    malformed record cannot stop the stream (Q3). A number that isn't one
    (NaN) counts as missing, and its reason says so."""
    kinds = dict(df.dtypes)
    missing = F.array_compact(F.array(*[
        F.when(F.col(c).isNull(), F.lit(c)) if kinds[c] not in ("double", "float")
        else F.when(F.col(c).isNull(), F.lit(c)).when(F.isnan(c), F.lit(f"{c}=NaN"))
        for c in required]))
    tagged = df.withColumn("_missing", missing)
    valid = tagged.where(F.size("_missing") == 0).drop("_missing")
    bad_cols = ([raw_col] if raw_col and raw_col in df.columns else []) + [
        c for c in df.columns if c != raw_col]
    invalid = (tagged.where(F.size("_missing") > 0)
               .select(*bad_cols, F.concat_ws(",", "_missing").alias("reason")))
    return valid, invalid
