"""Table sinks: reference (year, reactor_id) layout and the clustered layout."""

import datetime as dt
import os
import tempfile

import pytest

from fleetlake.settings import Settings
from fleetlake.sinks.tables import create_database, drop_tables, overwrite_partitioned, read_folders, use_database, write_fact


def sample(spark):
    rows = [(r, dt.datetime(2015 + (i % 2), 1, 1 + i % 28), i, 2015 + (i % 2))
            for r in range(1, 6) for i in range(20)]
    return spark.createDataFrame(rows, "reactor_id int, date_time timestamp_ntz, power_available int, year int")


def test_reference_layout_partition_folders(spark):
    root = tempfile.mkdtemp(prefix="fleetlake-sink-")
    create_database(spark, "t_sink")
    df = sample(spark)
    overwrite_partitioned(df, "t_sink.ref_layout", ("year", "reactor_id"), path=f"{root}/ref")
    years = sorted(d for d in os.listdir(f"{root}/ref") if d.startswith("year="))
    assert years == ["year=2015", "year=2016"]
    assert len([d for d in os.listdir(f"{root}/ref/year=2015") if d.startswith("reactor_id=")]) == 5
    back = spark.table("t_sink.ref_layout")
    assert back.filter("reactor_id = 3").count() == 20
    assert sorted(back.columns) == sorted(df.columns)


def test_written_folders_are_not_listed_anew(spark):
    root = tempfile.mkdtemp(prefix="fleetlake-sink-")
    create_database(spark, "t_sink")
    df = spark.range(400).selectExpr("CAST(nullif(id % 200, 0) AS INT) AS reactor_id", "CAST(id AS INT) AS power_available", "2015 AS year")
    sc = spark.sparkContext
    sc.setJobGroup("t_sink_many", "")
    try:
        overwrite_partitioned(df, "t_sink.many", ("year", "reactor_id"), path=f"{root}/many")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    status = sc.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("t_sink_many") for s in status.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages) < 200  # a listing has a task for each of the 200 folders
    assert len([d for d in os.listdir(f"{root}/many/year=2015") if d.startswith("reactor_id=")]) == 200
    back = spark.table("t_sink.many").select(*df.columns)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    overwrite_partitioned(df.filter("reactor_id = 3"), "t_sink.many", ("year", "reactor_id"), path=f"{root}/many")
    assert os.listdir(f"{root}/many/year=2015") == ["reactor_id=3"] and spark.table("t_sink.many").count() == 2


def test_only_chosen_folders_are_listed(spark):
    root = tempfile.mkdtemp(prefix="fleetlake-sink-")
    create_database(spark, "t_sink")
    df = spark.range(400).selectExpr("CAST(nullif(id % 200, 0) AS INT) AS reactor_id", "CAST(id AS INT) AS power_available",
                                     "IF(id < 200, 2015, NULL) AS year")
    overwrite_partitioned(df, "t_sink.chosen", ("year", "reactor_id"), path=f"{root}/chosen")
    with pytest.raises(Exception, match="SHOW PARTITIONS"):  # the driver's own catalog keeps no folders
        spark.sql("SHOW PARTITIONS t_sink.chosen")
    mine = df.filter("reactor_id % 5 = 3 OR reactor_id IS NULL")
    sc = spark.sparkContext
    sc.setJobGroup("t_sink_chosen", "")
    try:
        back = read_folders(spark, "t_sink.chosen", mine.select("reactor_id", "year"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    status = sc.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("t_sink_chosen") for s in status.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages) <= 82  # a listing has a task for each folder
    assert len(back.inputFiles()) == 82 and back.dtypes[1:] == [("year", "int"), ("reactor_id", "int")]
    back = back.select(*df.columns)
    assert back.exceptAll(mine).count() == 0 and mine.exceptAll(back).count() == 0
    none = read_folders(spark, "t_sink.chosen", mine.select("reactor_id", "year").filter("false"))
    assert none.count() == 0 and none.columns == spark.table("t_sink.chosen").columns
    with pytest.raises(ValueError, match="has folders by"):
        read_folders(spark, "t_sink.chosen", mine.select("reactor_id"))


def test_folders_are_chosen_by_integers(spark):
    root = tempfile.mkdtemp(prefix="fleetlake-sink-")
    create_database(spark, "t_sink")
    overwrite_partitioned(spark.createDataFrame([(1, "a b")], "n int, kind string"), "t_sink.kinds", ("kind",), path=f"{root}/kinds")
    with pytest.raises(ValueError, match="kind"):
        read_folders(spark, "t_sink.kinds", spark.table("t_sink.kinds").select("kind"))


def test_scratch_folders_without_checksum_files(spark):
    root = tempfile.mkdtemp(prefix="fleetlake-sink-")
    create_database(spark, "t_sink")
    df = sample(spark)
    layout = Settings(fact_partitions=("year", "reactor_id"), fact_cluster_by=())
    files = {}
    for name, settings in (("with", layout), ("without", layout.with_(checksum_files=False))):
        write_fact(df, f"t_sink.crc_{name}", settings, path=f"{root}/{name}")
        files[name] = [f for d, _, found in os.walk(f"{root}/{name}/year=2015") for f in found]
        back = spark.table(f"t_sink.crc_{name}").select(*df.columns)
        assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    assert len(files["without"]) == 5 and not any(f.endswith(".crc") for f in files["without"])
    assert len(files["with"]) == 10 and sum(f.endswith(".crc") for f in files["with"]) == 5


def test_clustered_layout_round_trip(spark):
    root = tempfile.mkdtemp(prefix="fleetlake-sink-")
    create_database(spark, "t_sink")
    df = sample(spark)
    write_fact(df, "t_sink.clustered", Settings(), path=f"{root}/cl")
    assert sorted(os.listdir(f"{root}/cl"))[-2:] == ["year=2015", "year=2016"]
    back = spark.table("t_sink.clustered").select(*df.columns)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    # one reactor's rows are read with a pushed-down filter
    plan = back.filter("reactor_id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "reactor_id" in plan


def test_use_and_drop(spark):
    root = tempfile.mkdtemp(prefix="fleetlake-sink-")
    create_database(spark, "t_use")
    write_fact(sample(spark), "t_use.f", Settings(), path=f"{root}/f")
    current = spark.catalog.currentDatabase()
    try:
        use_database(spark, "t_use")
        assert spark.sql("SELECT * FROM f").count() == 100      # bare name resolves
        drop_tables(spark, ["t_use.f", "t_use.missing"])           # IF EXISTS semantics
        assert not spark.catalog.tableExists("t_use.f")
    finally:
        use_database(spark, current)
