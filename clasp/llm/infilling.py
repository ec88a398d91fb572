"""Fill-in-the-middle texts by one counted-quantifier match a row.

A text is a run of units (by default lines with their line feeds).
``regexp_count`` gives the number n of units. Two hashes of the row's id,
reduced mod n + 1, give the cuts a <= b. The pattern of a row is then

    ((?:unit){a}+)((?:unit){b-a}+)(.*)

whose possessive counted groups capture prefix and middle without ever
giving a unit back, so a match takes time in proportion to the text and no
stack, and one ``regexp_replace`` writes the three parts out in the wanted
order. The reordered text is

    psm   P prefix S suffix M middle
    spm   S suffix P prefix M middle

with P, S, M the sentinels; ``plain`` leaves the text as it is. Everything
is built-in expressions on the row: nothing is shuffled.

Cases: a null text is empty; an empty text has no units and is plain. A text
that holds a sentinel is plain, so each sentinel of a reordered text stands
in it once and :func:`restored` gives the text back exactly. A null id counts
as empty. Rows are independent: ties and repeated rows each get their own
row, equal ids and texts equal results, an empty table none. All columns of
``docs`` are kept; the new ones replace columns of the same names. Texts of
any length are cut whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clasp.llm.common import free_prefix

LINES = r"[^\n]*\n|[^\n]+"
SENTINELS = ("<P>", "<S>", "<M>")
PARTS = ("form", "n_units", "prefix_chars", "middle_chars", "output")


def _checked(sentinels: tuple[str, str, str]) -> tuple[str, str, str]:
    """Sentinels can be found again if none can start inside another: the
    first character of each stands nowhere but in first place."""
    heads = {s[:1] for s in sentinels}
    if len(set(sentinels)) < 3 or "" in sentinels or any(c in heads for s in sentinels for c in s[1:]):
        raise ValueError(f"sentinels must differ, and start with characters that they hold nowhere else: {sentinels}")
    if any(a != b and a.startswith(b) for a in sentinels for b in sentinels):
        raise ValueError(f"no sentinel may start with another: {sentinels}")
    return sentinels


def _hashes(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a row's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _literal(sentinel: str) -> str:
    """For the replacement text of a regular expression."""
    return re.sub(r"([\\$])", r"\\\1", sentinel)


def infill(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = LINES, seed: int = 7,
           percent: int = 100, spm_percent: int = 50, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``docs`` with ``form``, ``n_units``, ``prefix_chars``, ``middle_chars``
    (code points; null if plain) and ``output``.

    ``unit`` is a regular expression of one unit, without capturing groups,
    whose leftmost matches follow each other without gaps; what follows the
    last is suffix. ``percent`` of the ids are reordered, ``spm_percent`` of
    those suffix first.
    """
    p, s, m = _checked(sentinels)
    own = free_prefix(docs, "_fim")
    names = [c for c in docs.columns if c.lower() not in PARTS]
    h1, h2, h3, h4 = _hashes(F.col(id_col), seed)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = F.lit(False)
    for x in sentinels:
        marked = marked | F.contains(text, F.lit(x))
    plain = (text == "") | marked | (h3 % 100 >= percent)
    # one struct of own names; columns of docs may have any others
    rows = docs.select(*names, F.struct(
        text.alias("text"), F.regexp_count(text, F.lit(unit)).cast("long").alias("n"), h1.alias("h1"), h2.alias("h2"),
        F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm").alias("form")).alias(own))
    text, n, form = F.col(f"{own}.text"), F.col(f"{own}.n"), F.col(f"{own}.form")
    one, two = F.col(f"{own}.h1") % (n + 1), F.col(f"{own}.h2") % (n + 1)
    a, b = F.least(one, two), F.greatest(one, two)

    def units(count: Column) -> Column:
        return F.concat(F.lit(f"((?:{unit}){{"), count.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit(r"(?s)\A"), units(a), units(b - a), F.lit(r"(.*)\z"))
    order = F.when(form == "psm", F.lit(f"{_literal(p)}$1{_literal(s)}$3{_literal(m)}$2")).otherwise(
        F.lit(f"{_literal(s)}$3{_literal(p)}$1{_literal(m)}$2"))
    rows = rows.select(*names, form.alias("form"), n.alias("n_units"),
                       F.when(form == "plain", text).otherwise(F.regexp_replace(text, pattern, order)).alias("output"))
    prefix, middle, _ = _parts(F.col("output"), F.col("form"), sentinels)
    known = F.col("form") != "plain"
    return rows.select(*names, "form", "n_units", F.when(known, F.length(prefix)).cast("long").alias("prefix_chars"),
                       F.when(known, F.length(middle)).cast("long").alias("middle_chars"), "output")


def _parts(output: Column, form: Column, sentinels: tuple[str, str, str]) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of a reordered text."""
    p, s, m = (F.lit(x) for x in _checked(sentinels))
    front, middle = F.split_part(output, m, F.lit(1)), F.split_part(output, m, F.lit(2))
    head, tail = F.split_part(front, s, F.lit(1)), F.split_part(front, s, F.lit(2))  # psm: P prefix, suffix; spm: empty, suffix P prefix
    psm = form == "psm"
    prefix = F.split_part(F.when(psm, head).otherwise(tail), p, F.lit(2))
    suffix = F.when(psm, tail).otherwise(F.split_part(tail, p, F.lit(1)))
    return prefix, middle, suffix


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The exact text, from a row's output and form alone."""
    prefix, middle, suffix = _parts(output, form, sentinels)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))


def digests(done: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Id, counts and the SHA-256 of each output and of the text rebuilt from it."""
    return done.select(F.col(id_col), F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
g AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n,
         ('0x' || substr(x, 1, 8))::BIGINT % (len(u) + 1) AS c1, ('0x' || substr(x, 9, 8))::BIGINT % (len(u) + 1) AS c2,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR ('0x' || substr(x, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || substr(x, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:least(c1, c2)], '') AS a,
         array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS b,
         array_to_string(u[greatest(c1, c2) + 1:n], '') AS z FROM g)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || b
                        ELSE '<S>' || z || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
