"""Long → wide reassembly of the readings (A6, J2, PF7; findings F7, F8; D7).

``long_to_wide`` is one aggregation keyed on (date_time, reactor_name): each
parameter's value is the greatest (seq, value) among that parameter's rows, so
the latest reading of a duplicated cell wins, equal or missing ``seq`` are
decided by the value, and a single hash shuffle replaces the reference's five
filtered branches and four joins.  Aggregates combine map-side, so a hot key does
not pile up in one task.  ``seq`` is optional.  The base-row rule of the join form
is kept: only keys with a ``power_available`` row survive.

``long_to_wide_join_form`` is the reference's shape (filter per parameter, left
joins on both keys), kept as a cross-check.  Readings are combined per cell first
(map-side) and the cells written once; the five branches then read that small
table, and AQE may split a hot key of their joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from fleetlake.schemas import PARAMETERS
from fleetlake.session import checkpoint_dir

KEYS = ("date_time", "reactor_name")


def _latest(value: str, seq: str | None, when=None):
    """Value of the greatest (seq, value); a missing seq counts as the smallest."""
    pair = F.struct(F.col(seq) if seq else F.lit(None).cast("bigint"), F.col(value).alias("v"))
    return F.max(pair if when is None else F.when(when, pair))["v"]


def latest_per_cell(readings: DataFrame, keys=KEYS, parameter: str = "parameter",
                    value: str = "value", seq: str | None = "seq") -> DataFrame:
    """One row per (keys, parameter): the latest value and the duplicate count."""
    seq = seq if seq in readings.columns else None
    return (readings.groupBy(*keys, parameter)
                    .agg(_latest(value, seq).alias(value), F.count(F.lit(1)).alias("n_readings")))


def long_to_wide(readings: DataFrame, parameters=PARAMETERS, base: str | None = "power_available",
                 keys=KEYS, parameter: str = "parameter", value: str = "value",
                 seq: str | None = "seq") -> DataFrame:
    p = F.col(parameter)
    seq = seq if seq in readings.columns else None
    aggs = [_latest(value, seq, p == name).alias(name) for name in parameters]
    if base is None:
        return readings.groupBy(*keys).agg(*aggs)
    aggs.append(F.count_if(p == base).alias("_n_base"))
    return (readings.groupBy(*keys).agg(*aggs)
                    .filter(F.col("_n_base") > 0).drop("_n_base"))


def long_to_wide_join_form(readings: DataFrame, parameters=PARAMETERS, keys=KEYS,
                           parameter: str = "parameter", value: str = "value",
                           seq: str | None = "seq") -> DataFrame:
    checkpoint_dir(readings.sparkSession)
    cells = latest_per_cell(readings, keys, parameter, value, seq).checkpoint(eager=True)
    branch = {name: cells.filter(F.col(parameter) == name).select(*keys, F.col(value).alias(name))
              for name in parameters}
    base, *rest = parameters
    return reduce(lambda acc, name: acc.join(branch[name], list(keys), "left"), rest, branch[base])
