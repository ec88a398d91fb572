"""SQL forms of the text feature stages (M1, M2).

``ml.feature.Tokenizer`` lower-cases and splits on Java ``\\s``
(space, tab, newline, vertical tab, form feed, carriage return); trailing
empty tokens are dropped, inner ones kept. The expressions below reproduce
that as plain column functions so counts can run without an ML stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clasp.functions.stopwords import ENGLISH_STOP_WORDS

# Fixed value: the whitespace class of Java's \s, written out so the SQL
# oracle (RE2) uses the same set.
WHITESPACE_CLASS = "[ \\t\\n\\x0B\\f\\r]"
WHITESPACE = " \t\n\x0b\f\r"


def tokens_expr(text: Column | str) -> Column:
    """Tokens as the Tokenizer makes them (inner empties kept, trailing
    empties dropped; a text without any blank stays one token)."""
    t = F.col(text) if isinstance(text, str) else text
    lower = F.lower(t)
    kept = F.rtrim(lower, F.lit(WHITESPACE))  # trailing blanks make only trailing empties
    return F.when((kept == "") & (lower != ""), F.array().cast("array<string>")).otherwise(F.split(kept, WHITESPACE_CLASS, -1))


def nonempty_tokens_expr(text: Column | str) -> Column:
    """Tokens without the empty strings left by repeated blanks."""
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), WHITESPACE_CLASS, -1), lambda x: x != F.lit(""))


def drop_stop_words_expr(tokens: Column | str, stop_words: list[str] | None = None) -> Column:
    """Remove stop words (case-insensitive, duplicates of other words kept)."""
    words = [w.lower() for w in (stop_words or ENGLISH_STOP_WORDS)]
    arr = F.array(*[F.lit(w) for w in words])
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.filter(t, lambda x: ~F.array_contains(arr, F.lower(x)))


def counted_tokens(tokens: Column) -> Column:
    """Distinct tokens with their number, as ``array<struct<term, n>>``: the
    tokens sorted, and the lengths of the runs of equal ones. Nothing is
    exploded or shuffled for it."""
    def once(value: Column, body) -> Column:  # the value is computed once, however often it is used
        return F.transform(F.array(value), body)[0]

    def runs(a: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(a)), lambda i: (i == 1) | (F.element_at(a, i) != F.element_at(a, F.greatest(i - 1, F.lit(1)))))
        return once(starts, lambda b: F.transform(b, lambda i, j: F.struct(
            F.element_at(a, i).alias("term"), (F.coalesce(F.get(b, j + 1), F.size(a) + 1) - i).cast("bigint").alias("n"))))
    return F.when(F.size(tokens) > 0, once(F.array_sort(tokens), runs)).otherwise(F.array().cast("array<struct<term: string, n: bigint>>"))
