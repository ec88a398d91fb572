"""Column-expression helpers (§2.13 value semantics). All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_even(x: ColumnOrName, digits: int) -> Column:
    """Round half to even, the rule Python's ``round`` and ``format`` apply.
    Ties that are exact in binary (3.125 -> 3.12) agree with Python; values
    whose decimal text is a tie but whose binary value is not (2.675) follow
    the decimal text."""
    return F.bround(_c(x), digits)


def round_like_python(x: ColumnOrName, digits: int) -> Column:
    """Python's ``round(x, digits)`` on doubles: the exact binary value is
    rounded half to even (``round(2.675, 2) == 2.67``, ``round(0.125, 2)
    == 0.12``), which neither ``round`` nor ``bround`` do (they round the
    shortest decimal text).

    Exact, with built-ins only: ``|x| = m / 2**s`` with ``m`` an integer
    (scaling by a power of two is exact), so ``x * 10**digits`` is the
    fraction ``m * 10**digits / 2**s``; its quotient and remainder are
    integer arithmetic, and the remainder against half the divisor picks
    the rounding. Values below 2**-8 (and non-finite ones) use ``bround``:
    for ``digits <= 2`` they are far from any tie."""
    v = _c(x).cast("double")
    a = F.abs(v)
    shift = (F.lit(53) - F.floor(F.log2(a))).cast("int")
    num = ((a * F.pow(F.lit(2.0), shift)).cast("bigint").cast("decimal(38,0)")
           * F.lit(10 ** digits).cast("decimal(38,0)"))
    den = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift).cast("decimal(38,0)")
    # exact integral quotient and remainder of decimals
    q = F.call_function("div", num, den)
    twice_r = (num % den) * 2
    up = (twice_r > den) | ((twice_r == den) & (q % 2 == 1))
    exact = F.signum(v) * ((q + up.cast("bigint")).cast("double") / F.lit(float(10 ** digits)))
    usable = (a >= F.lit(2.0 ** -8)) & (a < F.lit(2.0 ** 40)) & ~F.isnan(v)
    return F.when(usable, exact + F.lit(0.0)).otherwise(F.bround(v, digits))


def safe_ratio_pct(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    """``round(num / den * 100, digits)`` as Python computes it, and ``0``
    when ``den`` is 0 (A7)."""
    n, d = _c(num), _c(den)
    return (F.when(d > 0, round_like_python(n.cast("double") / d * F.lit(100.0), digits))
            .otherwise(F.lit(0.0)))


pct = safe_ratio_pct


# What Python's int() and float() read (underscores between
# digits; no hexadecimal, no type suffix).
_DIGITS = "[0-9]+(_[0-9]+)*"
INT_TEXT = rf"^\s*[+-]?{_DIGITS}\s*$"
FLOAT_TEXT = (rf"^\s*[+-]?((?i)inf(inity)?|nan|({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?)\s*$")


def guess_scalar(s: str) -> Column:
    """Guess one text value as Python would: int, else float, else
    text. Returns ``struct(kind, i, d, s)``; ``i`` is the integer's digits as
    text (any length, exact), ``d`` the number as a double."""
    text = F.col(s)
    plain = F.regexp_replace(F.trim(F.regexp_replace(text, r"\s", " ")), "_", "")
    is_int, is_float = text.rlike(INT_TEXT), text.rlike(FLOAT_TEXT)
    digits = F.regexp_replace(F.regexp_replace(plain, r"^([+-]?)0*([0-9])", "$1$2"), r"^[+]", "")
    digits = F.when(digits == "-0", "0").otherwise(digits)
    kind = (F.when(text.isNull(), F.lit("null")).when(is_int, F.lit("int"))
            .when(is_float, F.lit("double")).otherwise(F.lit("string")))
    number = F.when(is_int | is_float, plain.try_cast("double"))
    return F.struct(kind.alias("kind"), F.when(is_int, digits).alias("i"), number.alias("d"), text.alias("s"))


def parse_ts(x: ColumnOrName, fmt: str | None = None) -> Column:
    """Parse to timestamp, unparseable -> null (pandas ``errors='coerce'``)."""
    s = _c(x).cast("string")
    out = F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)
    return out.cast("timestamp_ntz")


def format_ts(x: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """P10: timestamp -> text for output."""
    return F.date_format(_c(x), fmt)


def format_ts_pystr(x: ColumnOrName) -> Column:
    """P10: timestamp text as Python's ``str(datetime)`` writes it:
    ``YYYY-MM-DD HH:MM:SS`` plus ``.ffffff`` only when there is a fraction."""
    t = _c(x)
    frac = F.date_format(t, "SSSSSS")
    return (F.when(t.isNull(), F.lit(None).cast("string"))
            .when(frac == F.lit("000000"), F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def map_values_expr(x: ColumnOrName, mapping: dict) -> Column:
    """Value map; a value missing from the map becomes null."""
    expr = None
    for k, v in mapping.items():
        cond = _c(x) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr if expr is not None else F.lit(None)
