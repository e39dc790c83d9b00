"""Available-now incremental bronze ingest: new files only, exactly once."""

import os
import tempfile

from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.functions.casts import format_timestamp
from fleetlake.functions.text import induce_mojibake
from fleetlake.sources import fixtures
from fleetlake.streaming.ingest import ingest_available
from conftest import SF_SMALL


def land(df, folder):
    (df.coalesce(1).write.mode("overwrite").option("header", "true").csv(folder))


def test_incremental_ingest(spark):
    root = tempfile.mkdtemp(prefix="fleetlake-stream-")
    landing, out, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/ckpt"
    os.makedirs(landing)
    readings = fixtures.readings(spark, SF_SMALL).select(
        format_timestamp("date_time").alias("date_time"), "reactor_name", "parameter",
        induce_mojibake("value").alias("value"), "seq")
    first, second = readings.filter("seq % 2 = 0"), readings.filter("seq % 2 = 1")
    land(first, f"{landing}/batch1")

    kw = dict(timestamp_cols=("date_time",))
    ingest_available(spark, f"{landing}/*", schemas.READINGS_CSV, out, ckpt, **kw)
    assert spark.read.parquet(out).count() == first.count()

    ingest_available(spark, f"{landing}/*", schemas.READINGS_CSV, out, ckpt, **kw)  # nothing new
    assert spark.read.parquet(out).count() == first.count()

    land(second, f"{landing}/batch2")
    ingest_available(spark, f"{landing}/*", schemas.READINGS_CSV, out, ckpt, **kw)
    got = spark.read.parquet(out)
    assert got.count() == readings.count()
    assert got.select("seq").distinct().count() == readings.count()
    assert got.filter(F.col("value") == "planifiée").count() > 0          # repaired
    assert dict(got.dtypes)["date_time"] == "timestamp_ntz"
