"""Incremental refresh of the fact: touched periods are rewritten, others aren't read."""

import pytest

from fleetlake.operators import dims
from fleetlake.plans import catalog_store as store, refresh
from fleetlake.sinks.tables import create_database, overwrite_table
from fleetlake.sources import fixtures

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def loaded(spark):
    settings = store.scratch_settings(spark, "refresh-test")
    create_database(spark, settings.gold_db, settings.location(settings.gold_db))
    assets = fixtures.assets(spark, SF).checkpoint()
    overwrite_table(dims.dim_reactor(assets, dims.dim_plant(assets)), settings.table("gold", "dim_reactor"), settings)
    readings = fixtures.readings(spark, SF).checkpoint()
    late = readings.filter("seq % 5 = 0 AND day(date_time) BETWEEN 10 AND 12")
    refresh.load_readings(spark, readings.exceptAll(late), settings, "day")
    refresh.load_fact(spark, settings, "day")
    return settings, readings, late


def rows(df):
    return sorted(map(str, df.collect()))


def full(spark, settings, readings):
    reactors = spark.table(settings.table("gold", "dim_reactor"))
    return rows(refresh._fact_of(readings, reactors, settings, "day").drop("period"))


def places(spark, settings):
    return {(r["period"], r["path"], r["at"]) for r in store._files(spark, settings).collect()}


def test_two_batches_equal_one(spark, loaded):
    settings, readings, late = loaded
    assert rows(refresh.fact_rows(spark, settings)) != full(spark, settings, readings)
    before = places(spark, settings)
    touched = refresh.refresh_fact(spark, late, settings, "day")
    assert len(touched) == 3 and [t[-2:] for t in touched] == ["10", "11", "12"]
    assert rows(refresh.fact_rows(spark, settings)) == full(spark, settings, readings)
    after = places(spark, settings)
    assert {p for p in before if p[0] not in touched} == {p for p in after if p[0] not in touched}
    assert not {p for p in before if p[0] in touched} & after
    times = spark.table(settings.table("gold", "dim_datetime"))
    assert times.count() == times.select("date_time").distinct().count() == readings.select("date_time").distinct().count()


def test_running_a_batch_again_changes_nothing(spark, loaded):
    settings, readings, late = loaded
    refresh.refresh_fact(spark, late, settings, "day")
    refresh.refresh_fact(spark, late, settings, "day")
    assert rows(refresh.fact_rows(spark, settings)) == full(spark, settings, readings)


def test_a_new_period_and_readings_without_a_time(spark, loaded):
    settings, readings, late = loaded
    more = spark.sql("SELECT TIMESTAMP_NTZ '2031-01-02 00:00:00' AS date_time, 'r' AS reactor_name, "
                     "'power_available' AS parameter, '5' AS value, 1L AS seq "
                     "UNION ALL SELECT NULL, 'r', 'power_available', '6', 2L")
    assert refresh.refresh_fact(spark, more, settings, "day") == ["2031-01-02", "none"]
    refresh.refresh_fact(spark, late, settings, "day")
    assert rows(refresh.fact_rows(spark, settings)) == full(spark, settings, readings.unionByName(more))


def test_an_empty_batch(spark, loaded):
    settings, readings, late = loaded
    before = places(spark, settings)
    assert refresh.refresh_fact(spark, late.filter("false"), settings, "day") == []
    assert places(spark, settings) == before


def test_missing_columns_are_refused_before_anything_is_written(spark, loaded):
    settings, _, late = loaded
    n = spark.table(settings.table("silver", "readings")).count()
    with pytest.raises(ValueError, match="lack"):
        refresh.refresh_fact(spark, late.drop("value"), settings, "day")
    assert spark.table(settings.table("silver", "readings")).count() == n


def test_only_touched_periods_are_read(spark, loaded):
    settings, _, late = loaded
    periods = refresh.touched_periods(late, "day")
    read = spark.table(settings.table("silver", "readings")).filter(refresh.F.col("period").isin(periods))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [period" in plan
    assert len(read.inputFiles()) < len(spark.table(settings.table("silver", "readings")).inputFiles())
