"""Time hierarchy, downtime pivot, pruned folders and folded keys."""

import pytest
from pyspark.sql import functions as F

from fleetlake.functions.text import fold_key
from fleetlake.operators import analytics
from fleetlake.plans import catalog, dashboard
from fleetlake.plans.star import gold

SF = "/root/testdata/sf0.001"


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hierarchy_equals_each_grain(spark):
    fc = dashboard.fact_capacity(spark, gold(spark, SF)).withColumn(
        "date_time", F.col("date_time") + F.make_dt_interval(hours=F.col("reactor_id") % 24, mins=F.col("reactor_id") % 60))
    found = analytics.time_hierarchy(fc).collect()
    assert {r["level"] for r in found} == set(analytics.GRAINS)
    for grain in analytics.GRAINS:
        want = {r["period"]: (r["n_readings"], r["total_power"]) for r in analytics.power_over_time(fc, grain).collect()}
        rates = {r["period"]: r["availability_rate"] for r in analytics.availability_over_time(fc, grain).collect()}
        got = {r["period"]: r for r in found if r["level"] == grain}
        assert {k: (r["n_readings"], r["total_power"]) for k, r in got.items()} == want
        assert {k: r["availability_rate"] for k, r in got.items()} == rates


def test_hierarchy_scans_the_fact_once(spark):
    plan = plan_of(analytics.time_hierarchy(dashboard.fact_capacity(spark, gold(spark, SF))))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "power_available" in line]
    assert len(scans) == 1 and plan.count("Expand") == 1


def test_hierarchy_without_times(spark):
    fc = spark.createDataFrame([(None, 5, 10), (None, None, 10)], "date_time timestamp_ntz, power_available int, rated_power int")
    found = {r["level"]: (r["period"], r["n_readings"], r["total_power"], r["availability_rate"])
             for r in analytics.time_hierarchy(fc).collect()}
    assert found == {g: (None, 2, 5, 0.5) for g in analytics.GRAINS}
    assert analytics.time_hierarchy(fc.filter("false")).count() == 0


def test_pivot_has_one_shuffle_and_all_types(spark):
    rows = [(2015, True, "planifiée", 5), (2015, True, "fortuite", 7), (2015, True, "autre", 1), (2016, True, "fortuite", 2),
            (2016, False, "planifiée", 9), (2016, True, None, 4)]
    fc = spark.createDataFrame(rows, "year int, is_unavailable boolean, unavailability_type string, downtime_mw int")
    df = analytics.downtime_pivot(fc)
    assert plan_of(df).count("Exchange hashpartitioning") == 1
    assert {r["year"]: tuple(r)[1:] for r in df.collect()} == {2015: (5, 7, 1, 13), 2016: (None, 2, None, 6)}


def test_only_the_plants_folders_are_read(spark):
    fact = spark.table(catalog.stored_by_reactor(spark, SF))
    reactors = catalog._gold(spark, SF, "dim_reactor")
    df = analytics.plant_slice(fact, reactors, catalog.PLANT_SLICED)
    plan = plan_of(df)
    assert "dynamicpruning" in plan.lower()
    mine = {r["reactor_id"] for r in reactors.filter(F.col("plant_id") == catalog.PLANT_SLICED).collect()}
    assert {r["reactor_id"] for r in df.collect()} <= mine


def small_tables(spark, root, reactors):
    """Tables of one customer, part and view event for each reactor, on 5 plants."""
    ids = spark.range(reactors)
    spark.range(5).selectExpr("CAST(id AS INT) AS n_nationkey", "concat('NATION_', id) AS n_name", "0 AS n_regionkey").write.parquet(f"{root}/nation.parquet")
    ids.selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", "CAST(id % 5 AS INT) AS c_nationkey",
                   "CAST(0 AS DOUBLE) AS c_acctbal", "'BUILDING' AS c_mktsegment").write.parquet(f"{root}/customer.parquet")
    ids.selectExpr("id AS p_partkey", "'p' AS p_name", "'b' AS p_brand", "'t' AS p_type", "1 AS p_size",
                   "CAST(0 AS DOUBLE) AS p_retailprice").write.parquet(f"{root}/part.parquet")
    ids.selectExpr("id AS event_id", "TIMESTAMP_NTZ'2024-01-01 01:00:00' AS ts", "id AS user_id", "'view' AS event_type",
                   "CAST(20 + id AS DOUBLE) AS value", "'' AS props").write.parquet(f"{root}/events.parquet")


def test_slice_lists_only_the_plants_folders(spark, tmp_path):
    small_tables(spark, tmp_path, 300)
    sf = f"file://{tmp_path}"
    gold(spark, sf)
    sc = spark.sparkContext
    sc.setJobGroup("t_slice_folders", "")
    try:
        found = catalog.QUERIES["plant_slice_by_reactor_folders"](spark, sf).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    status = sc.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("t_slice_folders") for s in status.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) < 100  # 60 of the 300 folders are the plant's; a listing has a task for each
    # the third plant by name
    assert {(r["reactor"], r["year"], r["n_readings"], r["total_power"], r["n_unavailable"]) for r in found} == \
        {(f"Customer#{i}", 2024, 1, 20 + i, 0) for i in range(2, 300, 5)}


@pytest.mark.parametrize("text, folded", [
    ("Ñandú", "nandu"), ("ñandú", "nandu"), ("PÀLUEL_1", "paluel_1"), ("plain", "plain"), ("MiXeD 7", "mixed 7"),
    ("Åse Øst", "ase ost"), ("Œuvre Straße", "œuvre straße"), ("", ""), (None, None), ("Ελλάδα 漢", "ελλάδα 漢")])
def test_fold_key(spark, text, folded):
    got = spark.createDataFrame([(text,)], "t string").select(fold_key("t").alias("f"))
    assert got.schema["f"].dataType.simpleString() == "string"
    assert got.first()[0] == folded


def test_folded_spellings_share_one_group(spark):
    names = ["Bugéy_1", "BUGEY_1", "bugey_1", "Bugéy_1", "Bugëy_1", "bugey_2"]
    df = spark.createDataFrame([(n,) for n in names], "t string").groupBy(fold_key("t").alias("k")).count()
    assert {r["k"]: r["count"] for r in df.collect()} == {"bugey_1": 5, "bugey_2": 1}


def test_both_ways_of_folding_agree(spark):
    """Composed letters fold by translate as they do by the collation beside another sign."""
    from fleetlake.functions.text import _ACCENTED

    texts = [c for c in _ACCENTED] + [c.upper() for c in _ACCENTED if len(c.upper()) == 1]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", fold_key("t").alias("a"), fold_key(F.concat("t", F.lit("漢"))).alias("b")).collect()
    assert [(r["t"], r["a"]) for r in got if r["a"] + "漢" != r["b"]] == []
