"""Dimensions: golden reactor listing, compat fan-out shape (F1), bridge."""

import datetime as dt

from fleetlake.operators import dims
from fleetlake.operators.quality import duplicate_keys

# The saved listing of reactors (FIXTURES §B), in order
GOLDEN = [
    "belleville_1", "belleville_2",
    "blayais_1", "blayais_2", "blayais_3", "blayais_4",
    "bugey_2", "bugey_3", "bugey_4", "bugey_5",
    "cattenom_1", "cattenom_2", "cattenom_3", "cattenom_4",
    "chinon_1", "chinon_2", "chinon_3", "chinon_4",
    "chooz_1", "chooz_2",
    "civaux_1", "civaux_2",
    "cruas_1", "cruas_2", "cruas_3", "cruas_4",
    "dampierre_1", "dampierre_2", "dampierre_3", "dampierre_4",
    "fessenheim_1", "fessenheim_2",
    "flamanville_1", "flamanville_2",
    "golfech_1", "golfech_2",
    "gravelines_1", "gravelines_2", "gravelines_3", "gravelines_4", "gravelines_5", "gravelines_6",
    "nogent_1", "nogent_2",
    "paluel_1", "paluel_2", "paluel_3", "paluel_4",
    "penly_1", "penly_2",
    "st_alban_1", "st_alban_2",
    "st_laurent_1", "st_laurent_2",
    "tricastin_1", "tricastin_2", "tricastin_3", "tricastin_4",
]
SCHEMA = ("reactor string, plant string, lat double, lon double, grid_connection date, model string, "
          "rated_power int, cooling string, cooling_source string")


def golden_assets(spark, variants=("fessenheim", "flamanville")):
    rows = []
    plants = sorted({name.rpartition("_")[0] for name in GOLDEN})
    for name in GOLDEN:
        plant, _, number = name.rpartition("_")
        i, n = plants.index(plant), int(number)
        lat = 45.0 + i + (0.5 if plant in variants and n % 2 == 0 else 0.0)
        rows.append((name, plant, lat, 2.0 + i, dt.date(1980, 1, n),
                     "P4" if n % 2 else "CP1", 1300 if n % 2 else 900, "dry", "river"))
    rows.append(("gravelines_1", "gravelines", 50.0, 2.0, dt.date(1980, 1, 1), "CP1", 900, "dry", "sea"))
    return spark.createDataFrame(rows, SCHEMA)


def test_default_mode_dense_keys(spark):
    a = golden_assets(spark)
    plants = dims.dim_plant(a)
    reactors = dims.dim_reactor(a, plants).orderBy("reactor_id").collect()
    assert len(reactors) == 58
    assert [r.reactor_id for r in reactors] == list(range(1, 59))
    assert sorted({r.plant_id for r in reactors}) == list(range(1, 20))
    names = [r.reactor for r in reactors]
    assert names == sorted(names)
    assert duplicate_keys(a.select("plant", "lat", "lon").distinct(), ["plant"]).count() == 3


def test_compat_mode_reproduces_fanout_gaps(spark):
    a = golden_assets(spark).filter("reactor != 'gravelines_1' OR cooling_source = 'river'")
    plants = dims.dim_plant(a, compat=True)
    assert plants.count() == 21                     # two plants with two coordinate rows
    reactors = {r.reactor: r for r in dims.dim_reactor(a, plants, compat=True).collect()}
    assert len(reactors) == 58
    ids = [reactors[f"fessenheim_{n}"].reactor_id for n in (1, 2)] + \
          [reactors[f"flamanville_{n}"].reactor_id for n in (1, 2)]
    assert ids == [31, 33, 35, 37]                  # the gaps of the saved listing
    assert reactors["golfech_1"].reactor_id == 39
    assert max(r.reactor_id for r in reactors.values()) == 62
    assert max(r.plant_id for r in reactors.values()) == 21


def test_bridge_one_row_per_reactor(spark):
    a = golden_assets(spark)
    plants = dims.dim_plant(a)
    reactors = dims.dim_reactor(a, plants)
    b = dims.bridge(a, reactors, dims.dim_model(a), dims.dim_cooling(a))
    assert b.count() == 58 and b.select("reactor_id").distinct().count() == 58
    assert b.filter("model_id IS NULL OR cooling_id IS NULL").count() == 0
    fan = {r.reactor_id: r.bridge_rows for r in dims.bridge_fanout(a, reactors).collect()}
    assert set(fan.values()) == {2}                 # one extra cooling source → 2 rows each


def test_dim_datetime_attributes(spark):
    df = spark.createDataFrame([(dt.datetime(2015, 3, 7, 13, 30),), (dt.datetime(2015, 3, 7, 13, 30),)],
                               "date_time timestamp_ntz")
    r = dims.dim_datetime(df).collect()
    assert len(r) == 1
    assert (r[0].date_key, r[0].year, r[0].month, r[0].day, r[0].hour) == (201503071330, 2015, 3, 7, 13)
