"""Physical-plan guards for the scale-relevant choices (read from explain)."""

import contextlib
import datetime as dt
import io

from fleetlake.operators.joins import lookup_join
from fleetlake.operators.keys import keep_one_per_key, surrogate_key
from fleetlake.operators.pivot import long_to_wide
from fleetlake.plans.catalog import QUERIES
from fleetlake.plans.star import Star
from conftest import SF_SMALL


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree_of(df) -> str:
    return plan_of(df).split("\n\n")[0]


def skewed_readings(spark, n=3000):
    # one reactor holds a third of all readings
    rows = []
    for i in range(n):
        reactor = "hot" if i % 3 == 0 else f"r{i % 97}"
        rows.append((dt.datetime(2015, 1, 1 + i % 28), reactor,
                     ("power_available", "derating", "unavailability_type")[i % 3 - 1], str(i % 50), i))
    return spark.createDataFrame(rows, "date_time timestamp_ntz, reactor_name string, parameter string, "
                                       "value string, seq long")


def test_pivot_pre_aggregates_before_shuffle(spark):
    df = long_to_wide(skewed_readings(spark))
    assert tree_of(df).count("Exchange") == 1                # one shuffle for the whole pivot
    assert "partial_max(" in plan_of(df)                   # map-side combine before it


def test_keep_one_is_an_aggregate_not_a_window(spark):
    plan = plan_of(keep_one_per_key(skewed_readings(spark), ["reactor_name"]))
    assert "partial_min" in plan and "Window" not in plan


def test_distributed_key_has_no_single_partition_exchange(spark):
    df = skewed_readings(spark).select("reactor_name", "seq")
    plan = plan_of(surrogate_key(df, ["reactor_name", "seq"], "id"))
    assert "SinglePartition" not in plan and "Window" not in plan


def final_plan(df) -> str:
    df.collect()  # AQE's plan of this very frame
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_dimension_lookups_are_broadcast_and_scans_pruned(spark):
    fact = Star(spark, SF_SMALL).fact
    plan = final_plan(fact).split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan   # customer: 2 of 5 columns


def test_lookup_starts_no_job(spark):
    tracker, facts = spark.sparkContext.statusTracker(), skewed_readings(spark)
    names = facts.groupBy("reactor_name").agg({"seq": "max"})
    before = len(tracker.getJobIdsForGroup())
    lookup_join(facts, names, "reactor_name")
    lookup_join(facts, names, "reactor_name", null_safe=True)
    assert len(tracker.getJobIdsForGroup()) == before


def test_join_form_reads_the_source_once(spark):
    plan = final_plan(QUERIES["long_to_wide_join_form"](spark, SF_SMALL)).split("== Initial Plan ==")[0]
    assert "FileScan" not in plan and "events" not in plan   # five branches over the written cells
    assert plan.count("Scan ExistingRDD") == 5


def test_stored_slice_is_pruned(spark):
    plan = plan_of(QUERIES["stored_asset_slice"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(reactor_id), EqualTo(reactor_id," in plan
    assert "Exchange" not in plan and "Join" not in plan


def test_measures_run_few_jobs_before_their_own(spark):
    QUERIES["plant_map"](spark, SF_SMALL)  # the gold tables are there
    tracker = spark.sparkContext.statusTracker()
    for name in ("kpi_reactor_count", "kpi_availability", "plant_map", "availability_yoy", "outage_split"):
        before = len(tracker.getJobIdsForGroup())
        QUERIES[name](spark, SF_SMALL)
        assert len(tracker.getJobIdsForGroup()) - before < 10
