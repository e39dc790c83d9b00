"""Calendar attributes of a wall-clock timestamp (SF2-SF4, SV2).

All helpers keep ``timestamp_ntz`` in and out; no session-zone conversion is
involved (``date_trunc`` would return a zoned timestamp, so day and half-hour
floors are built from the date part instead).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(col) -> Column:
    """Smart key ``yyyyMMddHHmm`` as bigint (minute precision, F11)."""
    return F.date_format(_c(col), "yyyyMMddHHmm").cast("bigint")


def floor_day(col) -> Column:
    return F.to_date(_c(col)).cast("timestamp_ntz")


def floor_minutes(col, minutes: int = 30) -> Column:
    """Floor to a multiple of ``minutes`` within the day (30 → half-hour grid)."""
    c = _c(col)
    mins = F.hour(c) * 60 + F.minute(c)
    floored = F.floor(mins / minutes) * minutes
    return floor_day(c) + F.make_dt_interval(mins=floored.cast("int"))


def floor_to(col, grain: str) -> Column:
    """Truncate to ``hour``/``day``/``month``/``year`` keeping ``timestamp_ntz``."""
    c = _c(col)
    if grain == "hour":
        return floor_day(c) + F.make_dt_interval(hours=F.hour(c))
    if grain == "day":
        return floor_day(c)
    if grain == "month":
        return F.trunc(c, "month").cast("timestamp_ntz")
    if grain == "year":
        return F.trunc(c, "year").cast("timestamp_ntz")
    raise ValueError(f"unknown grain {grain!r}")


def calendar_columns(col) -> dict[str, Column]:
    """Attributes of ``dim_datetime`` (SF2-SF4)."""
    c = _c(col)
    return {
        "date_key": date_key(c),
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "hour": F.hour(c),
    }
