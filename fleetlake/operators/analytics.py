"""Dashboard measures over the gold star schema (the reference's dashboard; BI1-BI11).

The dashboard's measure definitions are not in the reference tree; the ones
adopted here (SURVEY §2.8) are:

* availability rate   = Σ power_available / Σ rated_power over readings with both
* uptime share        = share of readings not flagged unavailable
* downtime (MW)       = max(rated_power − power_available, 0) while unavailable

Ratios divide exact integer (or decimal) sums once, so they are reproducible
bit for bit.  Every measure is a grouped aggregation with map-side combine;
windows appear only over already-aggregated rows whose count is bounded by a
domain (outage types, calendar years).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fleetlake.functions.calendar import floor_to
from fleetlake.functions.flags import downtime_mw
from fleetlake.operators.joins import lookup_join
from fleetlake.schemas import FORCED, PLANNED


def reactor_capacity(reactors: DataFrame, bridge: DataFrame, models: DataFrame, plants: DataFrame) -> DataFrame:
    """reactor_id → rated_power and plant attributes, through the bridge (default mode)."""
    out = lookup_join(reactors.select("reactor_id", "plant_id"), bridge.select("reactor_id", "model_id"),
                      "reactor_id")
    out = lookup_join(out, models.select("model_id", "rated_power"), "model_id")
    out = lookup_join(out, plants.select("plant_id", "plant", "lat", "lon"), "plant_id")
    return out.select("reactor_id", "rated_power", "plant_id", "plant", "lat", "lon")


def with_capacity(fact: DataFrame, capacity: DataFrame) -> DataFrame:
    out = lookup_join(fact, capacity, "reactor_id")
    return out.withColumn("downtime_mw", downtime_mw())


def _rated_pair():
    ok = F.col("power_available").isNotNull() & F.col("rated_power").isNotNull()
    return (F.sum(F.when(ok, F.col("power_available"))).cast("bigint"),
            F.sum(F.when(ok, F.col("rated_power"))).cast("bigint"))


def _rate(num, den):
    return F.try_divide(num.cast("double"), den.cast("double"))


def kpi_reactor_count(fact: DataFrame) -> DataFrame:
    """BI1: reactors reporting."""
    return fact.agg(F.count_distinct("reactor_id").alias("n_reactors"))


def kpi_availability(fc: DataFrame) -> DataFrame:
    """BI2: fleet availability rate (ratio of sums and mean of ratios) and uptime share."""
    p, r = _rated_pair()
    ratio = F.try_divide(F.col("power_available").cast("double"), F.col("rated_power").cast("double"))
    return (fc.agg(p.alias("power_sum"), r.alias("rated_sum"),
                   F.round(F.avg(ratio), 9).alias("mean_ratio"),
                   F.count_if(~F.col("is_unavailable")).alias("n_up"),
                   F.count(F.lit(1)).alias("n_readings"))
              .select("power_sum", "rated_sum", "n_readings", "mean_ratio",
                      _rate(F.col("power_sum"), F.col("rated_sum")).alias("availability_rate"),
                      _rate(F.col("n_up"), F.col("n_readings")).alias("uptime_share")))


def power_over_time(fact: DataFrame, grain: str = "day") -> DataFrame:
    """BI3: total available power per period."""
    return (fact.groupBy(floor_to("date_time", grain).alias("period"))
                .agg(F.sum("power_available").cast("bigint").alias("total_power"),
                     F.count(F.lit(1)).alias("n_readings")))


def availability_over_time(fc: DataFrame, grain: str = "day") -> DataFrame:
    """BI4: availability rate per period."""
    p, r = _rated_pair()
    return (fc.groupBy(floor_to("date_time", grain).alias("period"))
              .agg(p.alias("power_sum"), r.alias("rated_sum"))
              .select("period", _rate(F.col("power_sum"), F.col("rated_sum")).alias("availability_rate")))


#: grains of the dashboard's time axis, the finest first
GRAINS = ("hour", "day", "month", "year")


def time_hierarchy(fc: DataFrame) -> DataFrame:
    """BI3, BI4, BI9 at every grain in one pass: ``level, period, n_readings, total_power,
    availability_rate``.

    The fact is aggregated by hour; grouping sets then roll the hours up, so the rows
    that are repeated for each level are hours, not readings."""
    p, r = _rated_pair()
    hourly = fc.groupBy(floor_to("date_time", "hour").alias("hour")).agg(
        F.count(F.lit(1)).alias("n_readings"), F.sum("power_available").cast("bigint").alias("total_power"),
        p.alias("power_sum"), r.alias("rated_sum"))
    levels = hourly.withColumns({g: floor_to("hour", g) for g in GRAINS[1:]})
    sums = levels.groupingSets([[g] for g in GRAINS], *GRAINS).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("n_readings", "total_power", "power_sum", "rated_sum")],
        *[F.grouping(g).alias(f"no_{g}") for g in GRAINS])
    level, period = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")
    for g in GRAINS:
        level = F.when(F.col(f"no_{g}") == 0, g).otherwise(level)
        period = F.when(F.col(f"no_{g}") == 0, F.col(g)).otherwise(period)
    return sums.select(level.alias("level"), period.alias("period"), "n_readings", "total_power",
                       _rate(F.col("power_sum"), F.col("rated_sum")).alias("availability_rate"))


def downtime_pivot(fc: DataFrame, types=(PLANNED, FORCED)) -> DataFrame:
    """BI5 as the dashboard's table: a row a year, a column of lost MW for each outage
    type and one for any other; the list of types is closed, so one aggregation does."""
    lost = F.col("downtime_mw")
    columns = [F.sum(F.when(F.col("unavailability_type") == t, lost)).cast("bigint").alias(t) for t in types]
    other = F.sum(F.when(~F.col("unavailability_type").isin(*types), lost)).cast("bigint").alias("other")
    return fc.filter(F.col("is_unavailable")).groupBy("year").agg(*columns, other, F.sum(lost).cast("bigint").alias("total"))


def plant_folders(fact: DataFrame, reactors: DataFrame, plant_id: int) -> DataFrame:
    """Years and reactors of one plant that have rows in the fact: the folders of its slice."""
    chosen = reactors.filter(F.col("plant_id") == plant_id).select("reactor_id")
    return fact.join(chosen, "reactor_id", "left_semi").select("year", "reactor_id").distinct()


def plant_slice(fact: DataFrame, reactors: DataFrame, plant_id: int) -> DataFrame:
    """BI11 over the fact as the reference stores it, in folders by year and reactor: the
    reactors of one plant choose the folders at run time (dynamic partition pruning)."""
    chosen = reactors.filter(F.col("plant_id") == plant_id).select("reactor_id", "reactor")
    return (fact.join(chosen, "reactor_id").groupBy("reactor_id", "reactor", "year")
            .agg(F.count(F.lit(1)).alias("n_readings"), F.sum("power_available").cast("bigint").alias("total_power"),
                 F.count_if("is_unavailable").alias("n_unavailable")))


def downtime_by_year_type(fc: DataFrame) -> DataFrame:
    """BI5: lost MW by year and outage type (unavailable readings)."""
    return (fc.filter(F.col("is_unavailable"))
              .groupBy("year", "unavailability_type")
              .agg(F.sum("downtime_mw").cast("bigint").alias("downtime_mw"),
                   F.count(F.lit(1)).alias("n_outages")))


def outage_split(fc: DataFrame) -> DataFrame:
    """BI6: planned vs forced, share of lost MW and of outage readings."""
    per_type = (fc.filter(F.col("is_unavailable"))
                  .groupBy("unavailability_type")
                  .agg(F.sum("downtime_mw").cast("bigint").alias("downtime_mw"),
                       F.count(F.lit(1)).alias("n_outages")))
    everything = Window.partitionBy()  # over the few per-type rows only
    return per_type.select(
        "unavailability_type", "downtime_mw", "n_outages",
        _rate(F.col("downtime_mw"), F.sum("downtime_mw").over(everything)).alias("mw_share"),
        _rate(F.col("n_outages"), F.sum("n_outages").over(everything)).alias("count_share"))


def top_plants_downtime(fc: DataFrame, k: int = 10) -> DataFrame:
    """BI7: the k plants with the most lost MW (TakeOrdered; ties by name)."""
    return (fc.groupBy("plant").agg(F.sum("downtime_mw").cast("bigint").alias("downtime_mw"))
              .orderBy(F.col("downtime_mw").desc(), F.col("plant").asc_nulls_last())
              .limit(k))


def plant_map(fc: DataFrame) -> DataFrame:
    """BI8: per-plant coordinates, lost MW and availability (map feed)."""
    p, r = _rated_pair()
    return (fc.groupBy("plant", "lat", "lon")
              .agg(F.sum("downtime_mw").cast("bigint").alias("downtime_mw"),
                   p.alias("power_sum"), r.alias("rated_sum"))
              .select("plant", "lat", "lon", "downtime_mw",
                      _rate(F.col("power_sum"), F.col("rated_sum")).alias("availability_rate")))


def downtime_by_year_type_log(log: DataFrame) -> DataFrame:
    """BI5 over a multi-year outage log (date_time, outage_type, mw decimal)."""
    return (log.groupBy(F.year("date_time").cast("int").alias("year"), "outage_type")
               .agg(F.sum("mw").cast("double").alias("total_mw"),
                    F.count(F.lit(1)).alias("n_outages")))


def mw_over_time(log: DataFrame, grain: str = "month") -> DataFrame:
    """BI3 over the outage log: lost MW per period at any grain."""
    return (log.groupBy(floor_to("date_time", grain).alias("period"))
               .agg(F.sum("mw").cast("double").alias("total_mw"), F.count(F.lit(1)).alias("n_outages")))


def seasonality(log: DataFrame) -> DataFrame:
    """BI9: month-of-year profile of lost MW."""
    return (log.groupBy(F.month("date_time").cast("int").alias("month"))
               .agg(F.sum("mw").alias("_sum"), F.count(F.lit(1)).alias("n_outages"))
               .select("month", "n_outages", F.col("_sum").cast("double").alias("total_mw"),
                       (F.col("_sum").cast("double") / F.col("n_outages")).alias("avg_mw")))


def yoy_change(log: DataFrame) -> DataFrame:
    """BI10: year-over-year change of lost MW (window over per-year rows only)."""
    per_year = (log.groupBy(F.year("date_time").cast("int").alias("year"))
                   .agg(F.sum("mw").cast("double").alias("total_mw")))
    prev = F.lag("total_mw").over(Window.orderBy("year"))
    return (per_year.withColumn("prev_total_mw", prev)
                    .withColumn("change_ratio",
                                F.try_divide(F.col("total_mw") - F.col("prev_total_mw"),
                                             F.col("prev_total_mw"))))


def availability_seasonality(fc: DataFrame) -> DataFrame:
    """BI9: availability rate by month of the year."""
    p, r = _rated_pair()
    return (fc.groupBy(F.month("date_time").alias("month"))
              .agg(p.alias("power_sum"), r.alias("rated_sum"), F.count(F.lit(1)).alias("n_readings"))
              .select("month", "n_readings", _rate(F.col("power_sum"), F.col("rated_sum")).alias("availability_rate")))


def availability_yoy(fc: DataFrame) -> DataFrame:
    """BI10: availability rate by year and its change (window over the few years only)."""
    p, r = _rated_pair()
    rates = (fc.groupBy(F.year("date_time").alias("year")).agg(p.alias("power_sum"), r.alias("rated_sum"))
               .select("year", _rate(F.col("power_sum"), F.col("rated_sum")).alias("availability_rate")))
    before = F.lag("availability_rate").over(Window.orderBy("year"))
    return rates.select("year", "availability_rate", before.alias("previous_rate"),
                        (F.col("availability_rate") - before).alias("change"))


def asset_slice(fact: DataFrame, reactor_id: int) -> DataFrame:
    """BI11: one reactor's readings (a literal filter: prunes folders and row groups)."""
    return fact.filter(F.col("reactor_id") == F.lit(reactor_id))


def worst_asset(fc: DataFrame) -> int | None:
    """The reactor with most lost MW (one row to the driver)."""
    row = (fc.groupBy("reactor_id").agg(F.sum("downtime_mw").alias("lost"))
             .filter(F.col("reactor_id").isNotNull())
             .orderBy(F.desc("lost"), "reactor_id").first())
    return row["reactor_id"] if row else None


def worst_asset_slice(fc: DataFrame, fact: DataFrame) -> DataFrame:
    """BI11 driven by the data: the readings of the reactor with most lost MW."""
    worst = (fc.groupBy("reactor_id").agg(F.sum("downtime_mw").alias("_d"))
               .filter(F.col("reactor_id").isNotNull())
               .orderBy(F.col("_d").desc(), F.col("reactor_id").asc())
               .limit(1).select("reactor_id"))
    return fact.join(worst, "reactor_id", "left_semi").select(*fact.columns)
