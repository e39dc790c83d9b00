"""Star-schema dimensions and the bridge (findings F1-F3; decisions D1-D3).

Default mode (D1): a dimension's natural key is every attribute used to tell
its rows apart, and every lookup joins on all of them (null-safely, so an
unknown member keeps its own key).  One row per plant — conflicting coordinates
resolve to the smallest (lat, lon) and are listed by ``quality.duplicate_keys``.

``compat=True`` reproduces the reference's shape: row-distinct dimensions
joined on a partial key, which fans out reactors (F1).  The bridge is built on
the full keys in either mode; its fan-out is reported as counts (F2).
Where the reference's choice was arbitrary (which duplicate survives, ties in
the id order) a total order is imposed so results are reproducible.

Surrogate ids come from ``keys.surrogate_key`` (dense, ordered, distributed), or from
another ``number`` function, as ``registry.Registry.number`` for ids that stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetlake.functions.calendar import calendar_columns
from fleetlake.operators.joins import lookup_join
from fleetlake.operators.keys import distinct_rows, keep_one_per_key, surrogate_key


def dim_plant(assets: DataFrame, compat: bool = False, number=surrogate_key) -> DataFrame:
    cols = ["plant", "lat", "lon"]
    base = (distinct_rows(assets, cols) if compat
            else keep_one_per_key(assets.select(*cols), ["plant"], ["lat", "lon"]))
    return number(base, cols, "plant_id") \
        .select(*cols, "plant_id")


def dim_reactor(assets: DataFrame, plants: DataFrame, compat: bool = False, number=surrogate_key) -> DataFrame:
    reactors = keep_one_per_key(assets.select("reactor", "plant", "grid_connection"), ["reactor"])
    if not compat:
        joined = lookup_join(reactors, plants.select("plant", "plant_id"), "plant",
                             null_safe=True)
        keyed = number(joined.select("reactor", "plant_id", "grid_connection"),
                       ["reactor", "plant_id", "grid_connection"], "reactor_id")
        return keyed.select("reactor_id", "reactor", "plant_id", "grid_connection")
    # Reference shape (F1): joining on plant alone gives a reactor one row per
    # coordinate row of its plant; rows were numbered, then one per reactor
    # kept.  The survivor is the reactor's first row (smallest plant_id) and its
    # id counts all fanned rows before it — a weighted position, computed from
    # per-plant counts without materialising the fan-out.
    per_plant = plants.groupBy("plant").agg(F.min("plant_id").alias("plant_id"),
                                            F.count(F.lit(1)).alias("_rows"))
    joined = lookup_join(reactors, per_plant, "plant")
    weighted = joined.select("reactor", "plant_id", "grid_connection",
                             F.coalesce(F.col("_rows"), F.lit(1)).alias("_rows"))
    keyed = surrogate_key(weighted, ["reactor", "plant_id", "grid_connection"], "reactor_id",
                          weight="_rows")
    return keyed.select("reactor_id", "reactor", "plant_id", "grid_connection")


def dim_model(assets: DataFrame, number=surrogate_key) -> DataFrame:
    base = distinct_rows(assets, ["model", "rated_power"])
    return number(base, ["model", "rated_power"], "model_id") \
        .select("model_id", "model", "rated_power")


def dim_cooling(assets: DataFrame, number=surrogate_key) -> DataFrame:
    base = distinct_rows(assets, ["cooling", "cooling_source"])
    return number(base, ["cooling", "cooling_source"], "cooling_id") \
        .select("cooling_id", "cooling", "cooling_source")


def dim_datetime(readings: DataFrame, column: str = "date_time") -> DataFrame:
    """Calendar dimension: distinct timestamps and their attributes (A3, SF2-SF4)."""
    return (distinct_rows(readings, [column])
            .select(F.col(column).alias("date_time"))
            .withColumns(calendar_columns("date_time")))


def bridge(assets: DataFrame, reactors: DataFrame, models: DataFrame, coolings: DataFrame) -> DataFrame:
    """reactor_id → model_id, cooling_id (the many-to-many resolver).

    Joins on the full natural keys (D1), so each reactor has exactly one row."""
    per_reactor = keep_one_per_key(
        assets.select("reactor", "model", "rated_power", "cooling", "cooling_source"), ["reactor"])
    out = lookup_join(per_reactor, reactors.select("reactor_id", "reactor"), "reactor", null_safe=True)
    out = lookup_join(out, models.select("model_id", "model", "rated_power"), ["model", "rated_power"],
                      null_safe=True)
    out = lookup_join(out, coolings.select("cooling_id", "cooling", "cooling_source"),
                      ["cooling", "cooling_source"], null_safe=True)
    return out.select("reactor_id", "model_id", "cooling_id")


def bridge_fanout(assets: DataFrame, reactors: DataFrame) -> DataFrame:
    """How many rows the reference's partial-key bridge gives each reactor (F2).

    The reference joined model and cooling on one attribute each, so a reactor
    got one bridge row per (rated_power of its model) × (source of its
    cooling).  The product itself grows quadratically, so it is reported as
    counts from per-attribute aggregates instead of being emitted."""
    per_reactor = keep_one_per_key(assets.select("reactor", "model", "cooling"), ["reactor"])
    model_rows = distinct_rows(assets, ["model", "rated_power"]).groupBy("model") \
        .agg(F.count(F.lit(1)).alias("model_rows"))
    cooling_rows = distinct_rows(assets, ["cooling", "cooling_source"]).groupBy("cooling") \
        .agg(F.count(F.lit(1)).alias("cooling_rows"))
    out = lookup_join(per_reactor, reactors.select("reactor_id", "reactor"), "reactor")
    out = lookup_join(out, model_rows, "model")
    out = lookup_join(out, cooling_rows, "cooling")
    m = F.coalesce(F.col("model_rows"), F.lit(1))
    c = F.coalesce(F.col("cooling_rows"), F.lit(1))
    return out.select("reactor_id", m.alias("model_rows"), c.alias("cooling_rows"),
                      (m * c).alias("bridge_rows"))
