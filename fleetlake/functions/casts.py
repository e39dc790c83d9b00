"""Casts of readings and timestamps (SF1, SF3, SF5; decision D5).

Spark 4 runs ANSI by default, where ``cast('900.5' as int)`` raises.  The
reference relied on the lenient, truncating cast, so the default here is:
parse as double, truncate toward zero, unparsable → NULL.  ``strict=True``
raises on the first value that does not parse (JVM-side ``raise_error``).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_number(col, strict: bool = False) -> Column:
    """String → double ("1e3" is one); NULL for blanks; NULL (lenient) or error (strict) otherwise."""
    raw = F.nullif(F.trim(_c(col)), F.lit(""))
    # the JVM parser also takes a type suffix ("900d"), which is no number here
    parsed = F.when(~raw.rlike("[dDfF]$"), raw.try_cast("double"))
    if not strict:
        return parsed
    return F.when(raw.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("unparsable number: "), raw))
                  ).otherwise(parsed)


def to_int(col, strict: bool = False) -> Column:
    """String → int by truncation toward zero (900.7 → 900, -0.9 → 0)."""
    num = to_number(col, strict)
    as_int = num.try_cast("int")
    if not strict:
        return as_int
    return F.when(num.isNotNull() & as_int.isNull(),
                  F.raise_error(F.lit("number out of int range"))).otherwise(as_int)


def parse_timestamp(col, fmt: str = "M/d/yyyy H:mm", strict: bool = False) -> Column:
    """Wall-clock text → ``timestamp_ntz`` (zone-free, D6).

    Validity is tested with ``try_to_timestamp``; only valid rows reach the
    NTZ parser (CASE evaluates one branch per row), so bad text is NULL when
    lenient and an error when strict.
    """
    c = F.trim(_c(col))
    ok = F.try_to_timestamp(c, F.lit(fmt)).isNotNull()
    parsed = F.when(ok, F.to_timestamp_ntz(c, F.lit(fmt)))
    if not strict:
        return parsed
    return F.when(c.isNotNull() & ~ok,
                  F.raise_error(F.concat(F.lit("unparsable timestamp: "), c))).otherwise(parsed)


def format_timestamp(col, fmt: str = "M/d/yyyy H:mm") -> Column:
    return F.date_format(_c(col), fmt)


def parse_date(col, fmt: str = "M/d/yyyy", strict: bool = False) -> Column:
    c = F.trim(_c(col))
    parsed = F.try_to_date(c, fmt)
    if not strict:
        return parsed
    return F.when(c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("unparsable date: "), c))).otherwise(parsed)
