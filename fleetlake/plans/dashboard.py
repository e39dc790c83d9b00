"""Dashboard measures (BI1-BI11) over the written gold tables.

This is how the star schema is consumed: every measure reads the gold fact
and reaches rated power and plant through dim_reactor → bridge → dim_model /
dim_plant, exactly as a BI tool would.  Tables read back carry file
statistics, so Catalyst picks broadcast joins for the small dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlake.operators import analytics
from fleetlake.settings import Settings


def gold_star(spark: SparkSession, settings: Settings = Settings()) -> dict[str, DataFrame]:
    g = lambda name: spark.table(settings.table("gold", name))
    return {name: g(name) for name in ("fact_availability", "dim_reactor", "dim_plant", "dim_model",
                                       "bridge_reactor_model_cooling")}


def fact_capacity(spark: SparkSession, settings: Settings = Settings()) -> DataFrame:
    """The fact with rated power and plant, through the bridge."""
    t = gold_star(spark, settings)
    capacity = analytics.reactor_capacity(t["dim_reactor"], t["bridge_reactor_model_cooling"],
                                          t["dim_model"], t["dim_plant"])
    return analytics.with_capacity(t["fact_availability"], capacity)


def measures(spark: SparkSession, settings: Settings = Settings(), grain: str = "day",
             top_k: int = 10) -> dict[str, DataFrame]:
    fact = gold_star(spark, settings)["fact_availability"]
    fc = fact_capacity(spark, settings)
    return {
        "kpi_reactor_count": analytics.kpi_reactor_count(fact),
        "kpi_availability": analytics.kpi_availability(fc),
        "power_over_time": analytics.power_over_time(fact, grain),
        "availability_over_time": analytics.availability_over_time(fc, grain),
        "downtime_by_year_type": analytics.downtime_by_year_type(fc),
        "outage_split": analytics.outage_split(fc),
        "top_plants_downtime": analytics.top_plants_downtime(fc, top_k),
        "plant_map": analytics.plant_map(fc),
        "availability_seasonality": analytics.availability_seasonality(fc),
        "availability_yoy": analytics.availability_yoy(fc),
        "worst_asset_slice": analytics.worst_asset_slice(fc, fact),
    }
