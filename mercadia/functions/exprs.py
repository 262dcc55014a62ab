"""Column expressions shared by the models. All are built-in Spark functions
(JVM-side, inside whole-stage codegen); none is a Python UDF.

Arithmetic is exact decimal wherever the result is rounded, so half-way cases
round half away from zero exactly like a NUMERIC database would.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RAW = "decimal(28,8)"       # a source amount as it came
_MICROS_PER_DAY = 86_400_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Source double → NUMERIC rounded to cents (half away from zero)."""
    return round_to(c, 2).cast(MONEY)


def round_to(c, scale: int) -> Column:
    """ROUND(x::numeric, scale) for a double or decimal input.

    A double goes through decimal(28,8) first (its shortest decimal form for the
    values sources carry), so the rounding itself is decimal HALF_UP. Digits after
    the eighth are rounded before; values of 10**20 and more raise.
    """
    c = _c(c)
    return F.round(c.cast("decimal(28,8)"), scale)


def exact(c) -> Column:
    """A source amount as decimal(28,8), not rounded to cents: sums add raw amounts
    and round once, at the end."""
    return _c(c).cast(RAW)


def times(total, n) -> Column:
    """A raw total counted ``n`` times, exactly: totals below 10**18, ``n`` below 10**10."""
    return _c(total).cast("decimal(26,8)") * _c(n).cast("decimal(10,0)")


def ratio(num, den, scale: int, factor: int = 1) -> Column:
    """ROUND(num * factor / NULLIF(den, 0), scale) in decimal arithmetic.

    Operands keep eight fractional digits (as ``exact`` amounts have) and sixteen
    integer ones; more overflow, which raises. The quotient has ten or more
    fractional digits before the final rounding. NULL where an operand is NULL or
    the denominator is 0.
    """
    n, d = (_c(x).cast("decimal(24,8)") for x in (num, den))
    return F.round((n if factor == 1 else n * F.lit(Decimal(factor))) / F.nullif(d, F.lit(0)), scale)


def safe_pct(num, den, scale: int = 2) -> Column:
    """ROUND(num * 100.0 / NULLIF(den, 0), scale); null when den is 0 or null."""
    return ratio(num, den, scale, factor=100)


def avg_exact(c, scale: int) -> Column:
    """ROUND(AVG(x), scale) as exact SUM/COUNT (aggregate expression)."""
    c = _c(c)
    return F.round(F.sum(c.cast("decimal(20,4)")) / F.nullif(F.count(c), F.lit(0)), scale)


def pg_initcap(c) -> Column:
    """INITCAP(LOWER(x)) with word starts after any non-alphanumeric character.

    Spark's own ``initcap`` only starts a word after a space ('mogi-guacu' →
    'Mogi-guacu'); here runs of letters/digits and runs of anything else are
    split apart and each run gets its first character upper-cased.
    """
    runs = F.regexp_extract_all(F.lower(_c(c)), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), 1)
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.left(w, F.lit(1))),
                                                              F.substring(w, 2, 1 << 30))), "")


def blank_to_null(c) -> Column:
    """NULLIF(TRIM(x), ''): trims spaces only (tabs and line breaks stay)."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def _micros_between(later, earlier) -> Column:
    return F.timestamp_diff("MICROSECOND", _c(earlier), _c(later))


def elapsed_days(later, earlier, scale: int = 1) -> Column:
    """ROUND(EXTRACT(EPOCH FROM later - earlier) / 86400.0, scale): fractional days."""
    micros = _micros_between(later, earlier).cast("decimal(20,0)")
    return F.round(micros / F.lit(Decimal(_MICROS_PER_DAY)), scale)


def interval_days(later, earlier) -> Column:
    """EXTRACT(DAY FROM later - earlier): whole days, truncated toward zero."""
    micros = _micros_between(later, earlier).cast("decimal(38,18)")
    return (micros / F.lit(Decimal(_MICROS_PER_DAY))).cast("bigint")


def month_start(ts) -> Column:
    """DATE_TRUNC('month', ts)::date (a DATE; stays zone-free for timestamp_ntz)."""
    return F.trunc(_c(ts).cast("date"), "month")


def month_index(ts) -> Column:
    """YEAR*12 + MONTH: consecutive integers for consecutive calendar months."""
    return F.year(_c(ts)) * 12 + F.month(_c(ts))
