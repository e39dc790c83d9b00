"""Fixture views over the driver's parquet tables.

The reference's own inputs (three CSV files about a reactor fleet) are not
available, so its three tables are derived from the TPC-H-like tables with
plain Spark joins and projections.  Every view reads whole tables; its work
grows with them.

* ``assets``   — the asset ("reactors list") table: one row per customer
  (reactor = c_name, plant = nation name, coordinates from region / nation
  keys, model / rated power / cooling source from the part with the same key,
  cooling = market segment).  ``coordinate_variants=True`` gives plants 0 and
  1 a second surveyed coordinate for their BUILDING-segment assets — the shape
  behind the reference's dimension fan-out (F1).
* ``readings`` — the long entity-time-parameter-value series: one row per
  event at day grain; the event type picks the parameter, ``event_id``
  orders duplicate readings.
* ``outage_log`` — a multi-year series for year/month analytics: one row per
  order (date, priority as outage type, total price as MW).
* ``damaged_documents`` — ``documents`` with mojibake induced in every string
  column (the table itself holds none).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlake.functions.calendar import floor_day
from fleetlake.functions.text import induce_mojibake, string_columns
from fleetlake.operators.joins import lookup_join
from fleetlake.schemas import FORCED, PLANNED

# event type → parameter of the long series (fixture definition)
EVENT_PARAMETER = {
    "view": "power_available",
    "click": "derating",
    "error": "unavailability_type",
    "purchase": "unavailability_cause",
    "signup": "additional_info",
}
GRID_EPOCH = "1977-01-01"
COORDINATE_VARIANT_PLANTS = (0, 1)
COORDINATE_VARIANT_SEGMENT = "BUILDING"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def assets(spark: SparkSession, sf_dir: str, coordinate_variants: bool = False) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("c_custkey"),
                                            "p_brand", "p_size", "p_type")
    # nation is a plain file scan: Catalyst's file-size check broadcasts it
    joined = c.join(n, c.c_nationkey == n.n_nationkey)
    joined = joined.join(p, "c_custkey", "left")
    lat: Column = (F.col("n_regionkey") * 10.0).cast("double")
    if coordinate_variants:
        variant = F.col("n_nationkey").isin(*COORDINATE_VARIANT_PLANTS) & \
            (F.col("c_mktsegment") == COORDINATE_VARIANT_SEGMENT)
        lat = F.when(variant, lat + 0.5).otherwise(lat)
    return joined.select(
        F.col("c_name").alias("reactor"),
        F.col("n_name").alias("plant"),
        lat.alias("lat"),
        (F.col("n_nationkey") * 1.0).cast("double").alias("lon"),
        F.date_add(F.lit(GRID_EPOCH).cast("date"), (F.col("c_custkey") % 3650).cast("int"))
         .alias("grid_connection"),
        F.col("p_brand").alias("model"),
        F.col("p_size").alias("rated_power"),
        F.col("c_mktsegment").alias("cooling"),
        F.col("p_type").alias("cooling_source"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"),
                                                    F.col("c_name").alias("reactor_name"))
    et, v = F.col("event_type"), F.col("value")
    parameter = F.lit(None).cast("string")
    for kind, name in reversed(list(EVENT_PARAMETER.items())):
        parameter = F.when(et == kind, F.lit(name)).otherwise(parameter)
    value = (F.when(et == "view", F.when(v < 10, F.lit("0")).otherwise(v.cast("string")))
              .when(et == "click", F.when(v < 5, F.lit("0")).otherwise(v.cast("string")))
              .when(et == "error", F.when(F.col("event_id") % 10 == 0, F.lit(FORCED)).otherwise(F.lit(PLANNED)))
              .otherwise(F.col("props")))
    typed = ev.select(floor_day("ts").alias("date_time"), "user_id",
                      parameter.alias("parameter"), value.alias("value"), F.col("event_id").alias("seq"))
    return (lookup_join(typed, names, "user_id")
            .select("date_time", "reactor_name", "parameter", "value", "seq"))


def outage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderdate").alias("date_time"),
                    F.col("o_orderpriority").alias("outage_type"),
                    F.col("o_totalprice").cast("decimal(18,2)").alias("mw"))


def damaged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    targets = set(string_columns(d))
    return d.select(*[induce_mojibake(c).alias(c) if c in targets else F.col(c) for c in d.columns])
