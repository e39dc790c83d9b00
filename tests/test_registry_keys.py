"""Lasting surrogate keys: ids stay, new members are dense, nulls are members."""

import pytest

from fleetlake.operators import dims
from fleetlake.operators.registry import NATURAL_KEYS, Registry, register
from fleetlake.plans import catalog_store as store, layers
from fleetlake.session import scratch_database
from fleetlake.sources import fixtures


@pytest.fixture()
def settings(spark):
    found = store.scratch_settings(spark, "keys-test")
    found = found.with_(registry_db=found.gold_db.replace("gold_", "keys_"))
    scratch_database(spark, found.warehouse.rsplit("/", 1)[0], found.registry_db)
    return found


def ids(spark, settings, rows, keys=("a", "b")):
    df = spark.createDataFrame(rows, "a string, b int")
    Registry(spark, settings)
    found = register(spark, df, f"{settings.registry_db}.k", list(keys), "id", settings)
    return {tuple(r[k] for k in keys): r["id"] for r in found.collect()}


def test_ids_stay(spark, settings):
    first = ids(spark, settings, [("x", 1), ("y", 2), ("x", 1), (None, 3)])
    assert first == {("x", 1): 1, ("y", 2): 2, (None, 3): 3}
    second = ids(spark, settings, [("a", 1), ("y", 2), (None, None), ("z", None)])
    assert {k: second[k] for k in first} == first
    assert sorted(second.values()) == [1, 2, 3, 4, 5, 6]
    assert second["a", 1] == 4 and second["z", None] == 5 and second[None, None] == 6  # key order, nulls last
    assert ids(spark, settings, [("x", 1), (None, None)]) == second  # nothing new, nothing appended


def test_empty_members(spark, settings):
    assert ids(spark, settings, []) == {}
    assert ids(spark, settings, [("x", 1)]) == {("x", 1): 1}


def test_first_build_equals_plain_numbering(spark, settings):
    a = fixtures.assets(spark, "/root/testdata/sf0.001").checkpoint()
    number = Registry(spark, settings).number
    plants = dims.dim_plant(a)
    for plain, kept in ((plants, dims.dim_plant(a, number=number)),
                        (dims.dim_reactor(a, plants), dims.dim_reactor(a, plants, number=number)),
                        (dims.dim_model(a), dims.dim_model(a, number)), (dims.dim_cooling(a), dims.dim_cooling(a, number))):
        assert sorted(map(str, plain.collect())) == sorted(map(str, kept.collect()))


def test_moved_reactors_keep_their_id(spark, settings):
    """Attributes may change; the natural key decides."""
    number = Registry(spark, settings).number
    schema = "reactor string, plant string, lat double, lon double, grid_connection date"

    def reactors(rows):
        a = spark.createDataFrame(rows, schema).checkpoint()
        return {r["reactor"]: (r["reactor_id"], r["plant_id"])
                for r in dims.dim_reactor(a, dims.dim_plant(a, number=number), number=number).collect()}

    assert reactors([("r2", "p", 1.0, 1.0, None), ("r1", "q", 2.0, 2.0, None)]) == {"r1": (1, 2), "r2": (2, 1)}
    assert reactors([("r0", "a", 1.0, 1.0, None), ("r1", "p", 5.0, 5.0, None)]) == {"r0": (3, 3), "r1": (1, 1)}


def test_layers_with_a_registry(spark, settings):
    """Two builds of the gold layer: the facts of both use the same ids."""
    sf = "/root/testdata/sf0.001"
    assets, readings = fixtures.assets(spark, sf), fixtures.readings(spark, sf)
    found = []
    for part in (assets.filter("reactor NOT LIKE '%3'"), assets.filter("reactor NOT LIKE '%4'")):
        store._silver(spark, settings, part, readings)
        layers.build_gold(spark, settings)
        found.append({r["reactor"]: r["reactor_id"] for r in spark.table(settings.table("gold", "dim_reactor")).collect()})
        in_fact = spark.table(settings.table("gold", "fact_availability")).select("reactor_name", "reactor_id").distinct().collect()
        assert all(found[-1].get(r["reactor_name"]) == r["reactor_id"] for r in in_fact)
    both = found[0].keys() & found[1].keys()
    assert both and all(found[0][k] == found[1][k] for k in both)
    new = [found[1][k] for k in sorted(found[1].keys() - found[0].keys())]
    assert new == list(range(len(found[0]) + 1, len(found[0]) + 1 + len(new)))


def test_compat_is_refused(spark, settings):
    with pytest.raises(ValueError, match="exclude"):
        store._silver(spark, settings, fixtures.assets(spark, "/root/testdata/sf0.001"),
                      fixtures.readings(spark, "/root/testdata/sf0.001"))
        layers.build_gold(spark, settings.with_(compat=True))
    assert set(NATURAL_KEYS) == {"plant_id", "reactor_id", "model_id", "cooling_id"}
