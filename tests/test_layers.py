"""Bronze → silver → gold over CSV written from the sf0.001 fixtures, run twice."""

import tempfile

from fleetlake.plans import layers
from fleetlake.schemas import FACT_COLUMNS
from fleetlake.settings import Settings
from fleetlake.sources import fixtures
from fleetlake.sources.csv import write_csv
from conftest import SF_SMALL


def snapshot(spark, tables):
    out = {}
    for name, qualified in tables.items():
        df = spark.table(qualified)
        out[name] = sorted(tuple(repr(x) for x in r) for r in df.select(*sorted(df.columns)).collect())
    return out


def test_layers_are_deterministic_and_idempotent(spark):
    root = tempfile.mkdtemp(prefix="fleetlake-layers-")
    settings = Settings(bronze_db="t_bronze", silver_db="t_silver", gold_db="t_gold", warehouse=f"{root}/tables")
    a_csv, r_csv = f"{root}/src/assets", f"{root}/src/readings"
    # damage the readings' text on the way in; bronze must repair it
    from fleetlake.functions.text import induce_mojibake
    readings = fixtures.readings(spark, SF_SMALL)
    write_csv(fixtures.assets(spark, SF_SMALL), a_csv)
    write_csv(readings.withColumn("value", induce_mojibake("value")), r_csv)

    first = layers.run_layers(spark, a_csv, r_csv, settings)
    snap1 = snapshot(spark, first)
    second = layers.run_layers(spark, a_csv, r_csv, settings)
    assert snapshot(spark, second) == snap1

    report = layers.quality.residual_report(spark.table(settings.table("bronze", "readings"))).collect()[0]
    assert report.n_bad_rows == 0
    fact = spark.table(first["fact_availability"])
    assert set(FACT_COLUMNS) == set(fact.columns)
    assert fact.filter("unavailability_type = 'planifiée'").count() > 0  # repaired accent
    assert fact.count() == fixtures.readings(spark, SF_SMALL).filter("parameter = 'power_available'") \
        .select("date_time", "reactor_name").distinct().count()


def test_gate_runs_before_any_gold_write(spark):
    import pytest
    from test_dims import golden_assets

    root = tempfile.mkdtemp(prefix="fleetlake-gate-")
    a_csv, r_csv = f"{root}/src/assets", f"{root}/src/readings"
    write_csv(golden_assets(spark).filter("cooling_source = 'river'"), a_csv)
    write_csv(fixtures.readings(spark, SF_SMALL), r_csv)
    bad = Settings(bronze_db="g_bronze", silver_db="g_silver", gold_db="g_gold_bad",
                   warehouse=f"{root}/tables", compat=True, expected_reactors=57)
    with pytest.raises(ValueError, match="row-count gate"):
        layers.run_layers(spark, a_csv, r_csv, bad)
    assert not spark.catalog.databaseExists("g_gold_bad")     # nothing written (F14)

    ok = bad.with_(gold_db="g_gold_ok", expected_reactors=58)
    tables = layers.run_layers(spark, a_csv, r_csv, ok)
    ids = sorted(r.reactor_id for r in spark.table(tables["dim_reactor"]).collect())
    assert len(ids) == 58 and ids[-1] == 62                  # compat keeps the fan-out gaps
