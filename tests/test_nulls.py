"""NULL natural keys (D1) and unmatched lookups (F15-like) in the star build."""

import datetime as dt

from fleetlake.operators import dims, facts, pivot

SCHEMA = ("reactor string, plant string, lat double, lon double, grid_connection date, model string, "
          "rated_power int, cooling string, cooling_source string")


def assets(spark):
    d = dt.date(1980, 1, 1)
    return spark.createDataFrame([
        ("r1", "p1", 1.0, 1.0, d, "m1", 900, "c1", "river"),
        ("r2", None, None, None, d, None, None, "c1", "river"),   # unknown plant and model
        ("r3", "p1", 1.0, 1.0, d, "m1", 900, "c1", "river"),
    ], SCHEMA)


def test_null_members_get_keys_in_default_mode(spark):
    a = assets(spark)
    plants = dims.dim_plant(a)
    by_plant = {r.plant: r.plant_id for r in plants.collect()}
    assert set(by_plant) == {"p1", None} and by_plant["p1"] == 1 and by_plant[None] == 2   # nulls last
    reactors = {r.reactor: r for r in dims.dim_reactor(a, plants).collect()}
    assert reactors["r2"].plant_id == by_plant[None]
    b = {r.reactor_id: r for r in dims.bridge(a, dims.dim_reactor(a, plants), dims.dim_model(a),
                                              dims.dim_cooling(a)).collect()}
    assert all(r.model_id is not None and r.cooling_id is not None for r in b.values())


def test_compat_leaves_null_plant_unmatched(spark):
    a = assets(spark)
    plants = dims.dim_plant(a, compat=True)
    reactors = {r.reactor: r for r in dims.dim_reactor(a, plants, compat=True).collect()}
    assert reactors["r2"].plant_id is None and reactors["r1"].plant_id is not None


def test_fact_with_unknown_reactor(spark):
    a = assets(spark)
    reactors = dims.dim_reactor(a, dims.dim_plant(a))
    t = dt.datetime(2015, 1, 1, 0, 30)
    readings = spark.createDataFrame([
        (t, "r1", "power_available", "0", 1), (t, "r1", "unavailability_type", "fortuite", 2),
        (t, "ghost", "power_available", "5", 3),
    ], "date_time timestamp_ntz, reactor_name string, parameter string, value string, seq long")
    fact = {r.reactor_name: r for r in facts.fact_availability(pivot.long_to_wide(readings), reactors).collect()}
    assert fact["ghost"].reactor_id is None and not fact["ghost"].is_derated and not fact["ghost"].is_unavailable
    assert fact["r1"].reactor_id == 1 and fact["r1"].is_unavailable is True and fact["r1"].derating == 0
    assert fact["r1"].date_key == 201501010030 and fact["r1"].year == 2015
