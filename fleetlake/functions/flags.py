"""Outage state of a reading and the two flags (PF10-PF13; findings F9, F10).

A reading is in one of three states.  What it produces decides first, the rest of
the row second:

    power      outage type   derating   state
    0          present       any        "out"
    0          absent        any        "limited"
    above 0    any           above 0    "limited"
    anything else, no power reading     "normal"
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

OUT, LIMITED, NORMAL = "out", "limited", "normal"


def is_unavailable(power="power_available", outage_type="unavailability_type") -> Column:
    """Nothing is produced and an outage says why."""
    return F.when((F.col(power) == 0) & F.col(outage_type).isNotNull(), True).otherwise(False)


def is_derated(power="power_available", derating="derating", outage_type="unavailability_type") -> Column:
    """Nothing is produced without an outage, or less than could be."""
    return (F.when(F.col(power) == 0, F.col(outage_type).isNull())
             .when((F.col(power) > 0) & (F.col(derating) > 0), True).otherwise(False))


def outage_state(power="power_available", derating="derating", outage_type="unavailability_type") -> Column:
    return (F.when(is_unavailable(power, outage_type), OUT)
             .when(is_derated(power, derating, outage_type), LIMITED).otherwise(NORMAL))


def downtime_mw(rated="rated_power", power="power_available", unavailable="is_unavailable") -> Column:
    """Capacity lost while unavailable: max(rated − available, 0); 0 otherwise."""
    lost = F.greatest(F.col(rated) - F.col(power), F.lit(0))
    return F.when(F.col(unavailable), lost).otherwise(F.lit(0))
