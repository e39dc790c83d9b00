"""Incremental refresh of the availability fact (IO7, A6, D7).

A full load rewrites everything for a handful of late readings.  Here the silver
readings and the fact are partitioned by period (a day, month or year of the reading).
A late batch is appended to its periods; then only these are read, re-aggregated in
full (the latest reading of a cell may be an old or a late one) and replaced by a
dynamic partition overwrite.  All other files stay as they are, untouched and unread.

The touched periods are collected: they are values of the calendar, not rows, and as
literals they prune the partitions before any file is listed.  Running a batch again
appends its readings once more, which changes no cell (equal readings tie) and so gives
the same fact: a run that failed half way is simply repeated.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlake.operators import dims, facts, pivot
from fleetlake.plans.layers import READINGS
from fleetlake.schemas import FACT_COLUMNS
from fleetlake.settings import Settings
from fleetlake.sinks.tables import create_database

PERIODS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
_NO_TIME = "none"  # the period of readings without a time


def period(column: str = "date_time", grain: str = "month") -> Column:
    """The partition value of a reading: its day, month or year as text."""
    return F.coalesce(F.date_format(column, PERIODS[grain]), F.lit(_NO_TIME)).alias("period")


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _save(df: DataFrame, table: str, settings: Settings, order, mode: str) -> None:
    """Partitioned by period, sorted inside it; neighbours in the order share files."""
    laid_out = df.repartitionByRange("period", *order).sortWithinPartitions("period", *order)
    writer = laid_out.write.format(settings.table_format).mode(mode).partitionBy("period")
    path = settings.location(table)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def _fact_of(readings: DataFrame, reactors: DataFrame, settings: Settings, grain: str) -> DataFrame:
    fact = facts.fact_availability(pivot.long_to_wide(readings), reactors, strict=settings.strict,
                                   null_safe=not settings.compat)
    return fact.withColumn("period", period("date_time", grain))


def load_readings(spark: SparkSession, readings: DataFrame, settings: Settings = Settings(), grain: str = "month") -> None:
    """First load of the silver readings, partitioned by period."""
    create_database(spark, settings.silver_db, settings.location(settings.silver_db))
    _save(readings.withColumn("period", period("date_time", grain)), settings.table("silver", READINGS), settings,
          ["reactor_name", "date_time"], "overwrite")


def load_fact(spark: SparkSession, settings: Settings = Settings(), grain: str = "month") -> None:
    """The fact of all readings and its calendar, partitioned by period."""
    readings = spark.table(settings.table("silver", READINGS))
    reactors = spark.table(settings.table("gold", "dim_reactor"))
    _save(_fact_of(readings, reactors, settings, grain), settings.table("gold", "fact_availability"), settings,
          ["reactor_id", "date_time"], "overwrite")
    calendar = dims.dim_datetime(readings)
    path = settings.location(settings.table("gold", "dim_datetime"))
    writer = calendar.write.format(settings.table_format).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(settings.table("gold", "dim_datetime"))


def touched_periods(late: DataFrame, grain: str = "month") -> list[str]:
    """Periods that a batch reaches; at most as many as the calendar has."""
    return sorted(r[0] for r in late.select(period("date_time", grain)).distinct().collect())


def refresh_fact(spark: SparkSession, late: DataFrame, settings: Settings = Settings(), grain: str = "month") -> list[str]:
    """Add ``late`` readings and bring the fact and the calendar up to date; returns the
    periods that were written anew."""
    silver, gold = settings.table("silver", READINGS), settings.table("gold", "fact_availability")
    calendar = settings.table("gold", "dim_datetime")
    periods = touched_periods(late, grain)
    if not periods:
        return []
    columns = spark.table(silver).columns
    missing = [c for c in columns if c not in late.columns and c != "period"]
    if missing:
        raise ValueError(f"late readings lack {', '.join(missing)}")
    _save(late.withColumn("period", period("date_time", grain)).select(*columns), silver, settings,
          ["reactor_name", "date_time"], "append")

    readings = spark.table(silver).filter(F.col("period").isin(periods))
    reactors = spark.table(settings.table("gold", "dim_reactor"))
    fact = _fact_of(readings, reactors, settings, grain).select(*spark.table(gold).columns)
    laid_out = fact.repartitionByRange("period", "reactor_id", "date_time") \
        .sortWithinPartitions("period", "reactor_id", "date_time")
    with _dynamic_overwrite(spark):
        laid_out.write.mode("overwrite").insertInto(gold)

    known = spark.table(calendar)
    times = dims.dim_datetime(late.select("date_time"))
    new = times.join(known.select(F.col("date_time").alias("known")), times["date_time"].eqNullSafe(F.col("known")),
                     "left_anti").select(*known.columns)
    # the new rows are decided before the table they are compared with changes
    new.checkpoint(eager=True).write.mode("append").insertInto(calendar)
    return periods


def fact_rows(spark: SparkSession, settings: Settings = Settings()) -> DataFrame:
    return spark.table(settings.table("gold", "fact_availability")).select(*FACT_COLUMNS)


__all__ = ["fact_rows", "load_fact", "load_readings", "period", "refresh_fact", "touched_periods"]
