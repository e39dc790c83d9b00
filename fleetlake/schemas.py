"""Explicit schemas of the layer tables.

CSV sources are read with these instead of ``inferSchema`` (which costs an extra
pass over the data); the inferring mode stays available in ``sources.csv``.
Wall-clock timestamps are kept as ``timestamp_ntz`` (D6).
"""

from pyspark.sql import types as T

# the asset ("reactors list") table
ASSET_LIST = T.StructType([
    T.StructField("reactor", T.StringType()),
    T.StructField("plant", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("grid_connection", T.DateType()),
    T.StructField("model", T.StringType()),
    T.StructField("rated_power", T.IntegerType()),
    T.StructField("cooling", T.StringType()),
    T.StructField("cooling_source", T.StringType()),
])

# the long entity-time-parameter-value series ("availability_full");
# ``seq`` orders duplicate readings of one cell
READINGS = T.StructType([
    T.StructField("date_time", T.TimestampNTZType()),
    T.StructField("reactor_name", T.StringType()),
    T.StructField("parameter", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("seq", T.LongType()),
])

# CSV layout of the readings: the timestamp arrives as text (M/d/yyyy H:mm)
READINGS_CSV = T.StructType([
    T.StructField("date_time", T.StringType()),
    T.StructField("reactor_name", T.StringType()),
    T.StructField("parameter", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("seq", T.LongType()),
])

ASSET_LIST_CSV = T.StructType([
    f if f.name != "grid_connection" else T.StructField("grid_connection", T.StringType())
    for f in ASSET_LIST.fields
])

FACT = T.StructType([
    T.StructField("reactor_name", T.StringType()),
    T.StructField("date_time", T.TimestampNTZType()),
    T.StructField("power_available", T.IntegerType()),
    T.StructField("derating", T.IntegerType()),
    T.StructField("unavailability_type", T.StringType()),
    T.StructField("unavailability_cause", T.StringType()),
    T.StructField("additional_info", T.StringType()),
    T.StructField("date_key", T.LongType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("reactor_id", T.IntegerType()),
    T.StructField("is_unavailable", T.BooleanType()),
    T.StructField("is_derated", T.BooleanType()),
])

FACT_COLUMNS = [f.name for f in FACT.fields]

# closed tag domain of ``parameter`` — fixed values
PARAMETERS = ("power_available", "derating", "unavailability_type",
              "unavailability_cause", "additional_info")

# those whose value is a number
NUMERIC_PARAMETERS = ("power_available", "derating")

# outage types (planned, forced) — fixed values
PLANNED = "planifiée"
FORCED = "fortuite"
