"""The availability fact (PF10-PF14, J1, SF5; findings F7-F10, F15).

Wide cells → typed readings (lenient int casts, D5) → derating default 0 →
calendar attributes → reactor key lookup → outage flags.

``date_key`` and ``year`` are computed from ``date_time`` directly: they are
pure functions of it, so this equals the reference's left join against the
calendar dimension (a NULL timestamp yields NULL attributes either way) but
saves a shuffle join; ``join_calendar=True`` performs the join instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetlake.functions.calendar import date_key
from fleetlake.functions.casts import to_int
from fleetlake.functions.flags import is_derated, is_unavailable
from fleetlake.operators.joins import lookup_join
from fleetlake.schemas import FACT_COLUMNS


def typed_cells(wide: DataFrame, strict: bool = False) -> DataFrame:
    return wide.select(
        "reactor_name", "date_time",
        to_int("power_available", strict).alias("power_available"),
        to_int("derating", strict).alias("derating"),
        "unavailability_type", "unavailability_cause", "additional_info")


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """NULL → default per named column (PF14; the reference fills ``derating`` only)."""
    return df.fillna(defaults or {"derating": 0})


def fact_availability(wide: DataFrame, reactors: DataFrame, strict: bool = False,
                      calendar: DataFrame | None = None, null_safe: bool = False) -> DataFrame:
    fact = fill_defaults(typed_cells(wide, strict))
    if calendar is not None:
        fact = lookup_join(fact, calendar.select("date_time", "date_key", "year"), "date_time")
    else:
        fact = fact.withColumns({"date_key": date_key("date_time"),
                                 "year": F.year("date_time").cast("int")})
    fact = lookup_join(fact, reactors.select("reactor_id", F.col("reactor").alias("reactor_name")),
                       "reactor_name", null_safe=null_safe)
    fact = fact.withColumns({"is_unavailable": is_unavailable(), "is_derated": is_derated()})
    return fact.select(*FACT_COLUMNS)
