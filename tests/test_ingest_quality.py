"""Bad records, mixed headers, counted casts and the listing of files."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from fleetlake import schemas
from fleetlake.operators import quality
from fleetlake.plans import catalog_store as store, layers
from fleetlake.sources.csv import good_rows, header_groups, read_csv_checked, rejected_rows
from fleetlake.sources.tables import file_listing
from fleetlake.streaming.ingest import ingest_available

AB = StructType([StructField("a", IntegerType()), StructField("b", StringType())])


def folder(**files):
    d = tempfile.mkdtemp(prefix="fleetlake-files-")
    for name, text in files.items():
        with open(os.path.join(d, f"{name}.csv"), "w", encoding="utf-8") as f:
            f.write(text)
    return d


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


# -- headers ---------------------------------------------------------------------------


def test_header_groups(spark):
    d = folder(x="a,b\n1,2\n", y="b,a\r\n3,4\r\n", z="a,b\n", none="", bom="﻿a,b\n5,6\n")
    groups = {h: [os.path.basename(f) for f in files] for h, files in header_groups(spark, d).items()}
    assert groups == {"a,b": ["bom.csv", "x.csv", "z.csv"], "b,a": ["y.csv"]}


def test_columns_are_bound_by_each_header(spark):
    d = folder(x="a,b\n1,one\n", y="b,c,a\ntwo,-,2\n", z="a\n3\n")
    checked = read_csv_checked(spark, d, AB, optional=("b",))
    assert plain(good_rows(checked)) == [(1, "one"), (2, "two"), (3, None)]
    assert rejected_rows(checked).count() == 0
    with pytest.raises(ValueError, match="no column b"):
        read_csv_checked(spark, d, AB)


def test_names_with_blanks_and_escapes(spark):
    d = folder(**{"a b+c%41": "b,a\nx,1\n", "plain": "a,b\n2,y\n"})
    assert plain(good_rows(read_csv_checked(spark, d, AB))) == [(1, "x"), (2, "y")]


def test_no_file_has_a_line(spark):
    checked = read_csv_checked(spark, folder(none=""), AB)
    assert good_rows(checked).count() == 0 and good_rows(checked).columns == ["a", "b"]


# -- records -----------------------------------------------------------------------------


def test_rejects(spark):
    d = folder(x='a,b\n1,one\n2\n3,three,more\nx4,four\n"5","fi,ve"\n,none\n')
    for strict in (False, True):
        checked = read_csv_checked(spark, d, AB, reject_unparsable=strict)
        good, bad = plain(good_rows(checked)), rejected_rows(checked).collect()
        assert good == sorted([(1, "one"), (5, "fi,ve"), (None, "none")] + ([] if strict else [(None, "four")]), key=str)
        assert len(good) + len(bad) == 6 == good_rows(checked).count() + rejected_rows(checked).count()
        reasons = {r["record"]: r["reason"] for r in bad}
        assert reasons["2"] == reasons["3,three,more"] == "malformed record"
        assert reasons.get("x4,four") == ("unparsable a" if strict else None)
        assert all(r["file"].endswith("/x.csv") for r in bad)


def test_narrow_use_still_finds_malformed_records(spark):
    """No filter or pruned column may hide a record with a wrong number of fields."""
    d = folder(x="a,b\n" + "".join(f"{i},x{',more' if i % 4 == 0 else ''}\n" for i in range(100)))
    checked = read_csv_checked(spark, d, AB)
    assert good_rows(checked).select("a").count() == good_rows(checked).count() == 75
    assert good_rows(checked).agg(F.sum("a")).first()[0] == sum(i for i in range(100) if i % 4)


def test_ingest_sets_rejects_apart(spark):
    settings = store.scratch_settings(spark, "ingest-test")
    store.create_database(spark, settings.bronze_db, settings.location(settings.bronze_db))
    name = settings.table("bronze", "readings")
    d = folder(x="value,reactor_name,parameter,date_time\n900,r,power_available,1/1/2015 0:30\nshort,r\n800,r,power_available,soon\n",
               y="date_time,reactor_name,parameter,value,seq\n1/1/2015 1:00,r,power_available,700,x\n1/1/2015 1:30,r,power_available,600,7\n")
    report = layers.ingest_csv(spark, d, name, settings, schemas.READINGS_CSV)
    assert sorted((r["value"], str(r["date_time"]), r["seq"]) for r in spark.table(name).collect()) == [
        ("600", "2015-01-01 01:30:00", 7), ("700", "2015-01-01 01:00:00", None), ("800", "None", None), ("900", "2015-01-01 00:30:00", None)]
    assert [(r["reason"], r["record"]) for r in spark.table(f"{name}_rejects").collect()] == [("malformed record", "short,r")]
    counts = {r["column_name"]: (r["n_values"], r["n_failed"]) for r in report.collect()}
    assert counts == {"seq": (2, 1), "date_time": (4, 1)}
    # a clean source leaves an empty table of rejects
    layers.ingest_csv(spark, folder(x="date_time,reactor_name,parameter,value\n1/1/2015 0:30,r,p,1\n"), name, settings, schemas.READINGS_CSV)
    assert spark.table(name).count() == 1 and spark.table(f"{name}_rejects").count() == 0


def test_stream_takes_any_header_and_sets_rejects_apart(spark):
    d = folder(x="value,reactor_name,parameter,date_time\n900,r,power_available,1/1/2015 0:30\nshort,r\n", none="")
    root = tempfile.mkdtemp(prefix="fleetlake-mixed-")
    kw = dict(timestamp_cols=("date_time",))
    ingest_available(spark, d, schemas.READINGS_CSV, f"{root}/out", f"{root}/ckpt", **kw)
    with open(os.path.join(d, "second.csv"), "w", encoding="utf-8") as f:
        f.write("seq,date_time,reactor_name,parameter,value\n5,1/1/2015 1:00,r,power_available,700\n")
    ingest_available(spark, d, schemas.READINGS_CSV, f"{root}/out", f"{root}/ckpt", **kw)
    ingest_available(spark, d, schemas.READINGS_CSV, f"{root}/out", f"{root}/ckpt", **kw)
    got = spark.read.parquet(f"{root}/out")
    assert sorted((r["value"], r["seq"]) for r in got.collect()) == [("700", 5), ("900", None)]
    assert [r["record"] for r in spark.read.parquet(f"{root}/out_rejects").collect()] == ["short,r"]


# -- counted casts -------------------------------------------------------------------------


def test_observed_casts(spark):
    df = spark.createDataFrame([("1",), (" ",), ("",), (None,), ("x",), (" 2 ",)], "t string")
    parsed = df.withColumn("n", F.col("t").try_cast("int"))
    parsed, seen = quality.observe_casts(parsed, {"n": (F.col("t"), F.col("n"))})
    parsed.write.parquet(tempfile.mkdtemp(prefix="fleetlake-obs-") + "/t")
    report = quality.cast_report(spark, {"t": seen}, {"t": ["n"]})
    assert plain(report) == [("t", "n", 3, 1)]


def test_layers_count_failures(spark):
    settings = store.scratch_settings(spark, "counts-test")
    assets = folder(x="reactor,plant,lat,lon,grid_connection,model,rated_power,cooling,cooling_source\n"
                      "r_1,p,47.5,2.8,10/14/1987,P4,many,dry,river\nr_2,p,47.5,2.8,someday,P4,900,dry,river\n")
    readings = folder(x="date_time,reactor_name,parameter,value\n1/1/2015 0:30,r_1,power_available,oops\n"
                        "1/1/2015 0:30,r_1,unavailability_type,fortuite\n1/1/2015 1:30,r_2,power_available,900\n")
    layers.build_bronze(spark, assets, readings, settings)
    layers.build_silver(spark, settings)
    counts = {(r["table_name"], r["column_name"]): (r["n_values"], r["n_failed"])
              for r in spark.table(settings.table("bronze", "cast_failures")).collect()}
    assert counts["assets", "rated_power"] == (2, 1) and counts["assets", "grid_connection"] == (2, 1)
    assert counts["assets", "lat"] == (2, 0) and counts["readings", "date_time"] == (3, 0)
    assert plain(spark.table(settings.table("silver", "cast_failures"))) == [("readings", "value_num", 2, 1)]
    report = layers.bronze_report(spark, settings)
    assert {r["table_name"] for r in report.collect()} == {"assets", "readings"}


def test_residual_reports(spark):
    a = spark.createDataFrame([("Ã©", "x"), ("ok", "Ã¨"), ("Ã©", "Ã©")], "s string, t string")
    b = spark.createDataFrame([(1,)], "n int")
    assert plain(quality.residual_reports({"a": a, "b": b})) == [
        ("a", "*", 3, 3), ("a", "s", 3, 2), ("a", "t", 3, 2), ("b", "*", 1, 0)]


# -- files ---------------------------------------------------------------------------------


def test_listing(spark):
    d = folder(**{"x": "a,b\n1,2\n3,4\n", "head": "a,b\n", "none": "", "a b+c%": "a,b\n1,2\n"})
    os.makedirs(f"{d}/deep/er")
    with open(f"{d}/deep/er/notes.txt", "w") as f:
        f.write("hello")
    rows = spark.read.option("header", "true").csv(d)
    found = {r["name"]: (r["size"], r["n_rows"]) for r in file_listing(spark, d, rows).collect()}
    assert found == {"x.csv": (12, 2), "head.csv": (4, 0), "none.csv": (0, 0), "a b+c%.csv": (8, 1), "notes.txt": (5, 0)}
    times = [r["modification_time"] for r in file_listing(spark, d).collect()]
    assert len(times) == 5 and all(times)
    assert file_listing(spark, d, glob="*.txt").count() == 1


def test_listing_reads_no_content(spark):
    plan = file_listing(spark, folder(x="a\n1\n"))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1].split("\n")[0]
