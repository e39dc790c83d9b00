"""CSV ingest options (IO1-IO5) in explicit-schema and inference modes."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from fleetlake import schemas
from fleetlake.plans.layers import silver_readings
from fleetlake.sources.csv import read_csv

LIST_CSV = """reactor,plant,lat,lon,grid_connection,model,rated_power,cooling,cooling_source
 belleville_1 , belleville ,47.51,2.87,10/14/1987,P4,1310,dry,river
belleville_2,belleville,47.51,2.87,7/6/1988,P4,1310,dry,river
"""
READINGS_CSV = """date_time,reactor_name,parameter,value,seq
1/1/2015 0:30,belleville_1,power_available,1310,1
12/31/2015 23:30,belleville_1,unavailability_type,planifiée,2
"""


def write(text):
    d = tempfile.mkdtemp(prefix="fleetlake-csv-")
    with open(os.path.join(d, "part.csv"), "w", encoding="utf-8") as f:
        f.write(text)
    return d


def test_inferred_types_with_formats(spark):
    df = read_csv(spark, write(LIST_CSV))                # inference mode
    types = dict(df.dtypes)
    assert types["grid_connection"] == "date" and types["lat"] == "double"
    assert types["rated_power"] == "int"
    row = df.orderBy("reactor").first()
    assert row.reactor == "belleville_1" and row.plant == "belleville"   # trimmed
    assert row.grid_connection == dt.date(1987, 10, 14)
    r = read_csv(spark, write(READINGS_CSV))
    assert dict(r.dtypes)["date_time"].startswith("timestamp")
    assert r.filter("parameter = 'unavailability_type'").first().value == "planifiée"   # UTF-8


def test_explicit_schema(spark):
    df = read_csv(spark, write(READINGS_CSV), schemas.READINGS_CSV)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "string", "string", "string", "bigint"]
    assert df.count() == 2


def test_bronze_ingest_of_unknown_schema(spark):
    from fleetlake.plans.layers import ingest_csv
    from fleetlake.settings import Settings
    from fleetlake.sinks.tables import create_database

    damaged = "1/1/2015 0:30,Ã©tÃ©,3\n1/1/2015 1:00,ok,\n"
    path = write("date_time,note,n\n" + damaged)
    root = tempfile.mkdtemp(prefix="fleetlake-bronze-")
    create_database(spark, "t_bronze_x")
    ingest_csv(spark, path, "t_bronze_x.availability", Settings(warehouse=root))
    df = spark.table("t_bronze_x.availability")
    assert dict(df.dtypes)["date_time"] == "timestamp_ntz"
    rows = sorted(df.collect(), key=lambda r: r.date_time)
    assert rows[0].date_time == dt.datetime(2015, 1, 1, 0, 30) and rows[0].note == "été" and rows[0].n == 3


def test_rebalanced_ingest_of_gzip_source(spark):
    import gzip
    from fleetlake.plans.layers import ingest_csv
    from fleetlake.settings import Settings
    from fleetlake.sinks.tables import create_database

    d = tempfile.mkdtemp(prefix="fleetlake-gz-")
    body = "date_time,reactor_name,parameter,value,seq\n" + "".join(
        f"1/{1 + i % 28}/2015 0:30,r{i % 5},power_available,{i},{i}\n" for i in range(2000))
    with gzip.open(os.path.join(d, "part.csv.gz"), "wt", encoding="utf-8") as f:
        f.write(body)
    create_database(spark, "t_bronze_gz")
    settings = Settings(warehouse=tempfile.mkdtemp(prefix="fleetlake-gzw-"), ingest_rebalance=True)
    ingest_csv(spark, d, "t_bronze_gz.readings", settings, schemas.READINGS_CSV)
    df = spark.table("t_bronze_gz.readings")
    assert df.count() == 2000 and dict(df.dtypes)["date_time"] == "timestamp_ntz"


def test_columns_are_found_by_name(spark):
    text = ("plant,remark,reactor,model,rated_power,lat,lon,cooling,cooling_source,grid_connection\n"
            "p,x,r_1,P4,900,47.5,2.8,dry,river,10/14/1987\n")
    df = read_csv(spark, write(text), schemas.ASSET_LIST)
    assert df.columns == [f.name for f in schemas.ASSET_LIST]
    assert df.first().asDict() == dict(reactor="r_1", plant="p", lat=47.5, lon=2.8, model="P4", rated_power=900,
                                       cooling="dry", cooling_source="river", grid_connection=dt.date(1987, 10, 14))


def test_missing_columns(spark):
    path = write("value,date_time,reactor_name,parameter\n900,1/1/2015 0:30,r,power_available\n")
    with pytest.raises(ValueError, match="seq"):
        read_csv(spark, path, schemas.READINGS_CSV)
    row = read_csv(spark, path, schemas.READINGS_CSV, optional=("seq",)).first()
    assert (row.reactor_name, row.value, row.seq) == ("r", "900", None)
    with pytest.raises(ValueError, match="parameter"):
        read_csv(spark, write("date_time,reactor_name,value\n1,2,3\n"), schemas.READINGS_CSV, optional=("seq",))


def test_files_with_another_header_are_refused(spark):
    path = write("a,b\n1,2\n")
    with open(os.path.join(path, "part2.csv"), "w", encoding="utf-8") as f:
        f.write("b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, StructType([StructField("a", StringType()), StructField("b", StringType())])).collect()


def test_blank_and_folded_keys(spark):
    readings = spark.createDataFrame([("  PALUEL_1 ",), ("Pàluel_1",), ("  ",), (None,)], "reactor_name string") \
        .selectExpr("timestamp_ntz'2015-01-01' AS date_time", "reactor_name", "'x' AS parameter", "' ' AS value", "1L AS seq")
    plain = [r.reactor_name for r in silver_readings(readings).collect()]
    assert plain == ["PALUEL_1", "Pàluel_1", None, None]
    folded = [r.reactor_name for r in silver_readings(readings, fold_keys=True).collect()]
    assert folded == ["paluel_1", "paluel_1", None, None]
