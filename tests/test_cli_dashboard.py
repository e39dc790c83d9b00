"""CLI build → gold tables → dashboard measures equal the in-memory star's."""

import tempfile

from fleetlake import cli
from fleetlake.operators import analytics
from fleetlake.plans import dashboard
from fleetlake.plans.star import gold
from fleetlake.sources import fixtures
from fleetlake.sources.csv import write_csv
from conftest import SF_SMALL


def rows(df):
    return sorted(tuple(repr(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def test_build_then_dashboard(spark):
    root = tempfile.mkdtemp(prefix="fleetlake-cli-")
    write_csv(fixtures.assets(spark, SF_SMALL), f"{root}/assets")
    write_csv(fixtures.readings(spark, SF_SMALL), f"{root}/readings")
    dbs = ["--bronze-db", "c_bronze", "--silver-db", "c_silver", "--gold-db", "c_gold",
           "--warehouse", f"{root}/tables", "--show", "3"]
    tables = cli.main(["build", "--assets", f"{root}/assets", "--readings", f"{root}/readings", *dbs], spark)
    assert set(tables) >= {"fact_availability", "dim_reactor", "bridge_reactor_model_cooling"}

    board = cli.main(["dashboard", *dbs], spark)
    fc = dashboard.fact_capacity(spark, gold(spark, SF_SMALL))
    assert rows(board["kpi_availability"]) == rows(analytics.kpi_availability(fc))
    assert rows(board["top_plants_downtime"]) == rows(analytics.top_plants_downtime(fc, 10))
    assert rows(board["outage_split"]) == rows(analytics.outage_split(fc))
    assert rows(board["plant_map"]) == rows(analytics.plant_map(fc))

    shown = cli.main(["query", "seasonality", "--sf-dir", SF_SMALL, "--show", "2"], spark)
    assert shown["seasonality"].count() == 12
