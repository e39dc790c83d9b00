"""Pivot edge cases (F7, F8, D7) and key operators (A2, W1, §4.3)."""

import datetime as dt
import random

from pyspark.sql import Window, functions as F

from fleetlake.operators.keys import keep_one_per_key, sort_exprs, surrogate_key, total_order
from fleetlake.operators.pivot import long_to_wide, long_to_wide_join_form

T0 = dt.datetime(2015, 1, 1, 0, 30)
T1 = dt.datetime(2015, 1, 1, 1, 0)
SCHEMA = "date_time timestamp_ntz, reactor_name string, parameter string, value string, seq long"


def test_pivot_rules(spark):
    rows = [
        (T0, "a", "power_available", "900", 1),
        (T0, "a", "derating", "10", 2),
        (T0, "a", "derating", "20", 3),            # duplicate cell: latest wins (D7)
        (T0, "a", "mystery", "x", 4),              # unknown parameter ignored
        (T1, "a", "derating", "5", 5),             # no power row: dropped (F7)
        (T0, "b", "power_available", None, 6),     # power row with NULL value kept
        (T0, "b", "unavailability_type", "fortuite", 7),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.date_time, r.reactor_name): r.asDict() for r in long_to_wide(df).collect()}
    assert set(got) == {(T0, "a"), (T0, "b")}
    assert got[(T0, "a")]["derating"] == "20" and got[(T0, "a")]["power_available"] == "900"
    assert got[(T0, "b")]["power_available"] is None
    assert got[(T0, "b")]["unavailability_type"] == "fortuite"


def test_pivot_equals_join_form(spark):
    rnd = random.Random(7)
    params = ["power_available", "derating", "unavailability_type", "unavailability_cause", "additional_info"]
    rows, seq = [], 0
    for day in range(5):
        for reactor in "abcdef":
            for p in params:
                for _ in range(rnd.randint(0, 2)):
                    seq += 1
                    rows.append((T0 + dt.timedelta(days=day), reactor, p, str(rnd.randint(0, 99)), seq))
    df = spark.createDataFrame(rows, SCHEMA)
    a = long_to_wide(df)
    b = long_to_wide_join_form(df).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() > 0


def test_keep_one_per_key_nulls_last(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", "b", 2), ("k", "a", 3), ("j", None, 4)],
                               "key string, v string, w int")
    got = {r.key: (r.v, r.w) for r in keep_one_per_key(df, ["key"]).collect()}
    assert got == {"k": ("a", 3), "j": (None, 4)}


def by_window(df, order):
    """The ids of one window over all rows, for comparison."""
    return df.withColumn("id", F.row_number().over(Window.orderBy(*sort_exprs(total_order(df, order)))).cast("int"))


def test_distributed_key_equals_window(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["x", "y", None]), rnd.randint(0, 50), rnd.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, n int, r double")
    a = surrogate_key(df, ["g", "n"], "id", num_partitions=13)
    assert a.exceptAll(by_window(df, ["g", "n"])).count() == 0
    ids = sorted(r.id for r in a.select("id").collect())
    assert ids == list(range(1, 3001))


def test_weighted_key(spark):
    df = spark.createDataFrame([("a", 2), ("b", 1), ("c", 3), ("d", 1)], "k string, w long")
    got = {r.k: r.id for r in surrogate_key(df, ["k"], "id", num_partitions=3, weight="w").collect()}
    assert got == {"a": 1, "b": 3, "c": 4, "d": 7}


def test_pivot_without_seq_and_with_ties(spark):
    rows = [(T0, "a", "power_available", "900"), (T0, "a", "power_available", "0"),
            (T0, "a", "unavailability_type", "fortuite"), (T1, "b", "power_available", "7")]
    df = spark.createDataFrame(rows, "date_time timestamp_ntz, reactor_name string, parameter string, value string")
    for frame in (df, df.withColumn("seq", F.lit(None).cast("long")), df.withColumn("seq", F.lit(3).cast("long"))):
        for form in (long_to_wide, long_to_wide_join_form):
            got = {r.reactor_name: (r.power_available, r.unavailability_type) for r in form(frame).collect()}
            assert got == {"a": ("900", "fortuite"), "b": ("7", None)}


def test_distributed_key_with_aqe_coalescing(spark):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 400), rnd.random()) for _ in range(5000)]
    df = spark.createDataFrame(rows, "n int, r double")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        a = surrogate_key(df, ["n"], "id")
        n_parts = a.select(F.spark_partition_id().alias("p")).distinct().count()
        b = by_window(df, ["n"])
        assert a.exceptAll(b).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert 1 < n_parts < 50


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert long_to_wide(empty).count() == 0
    assert keep_one_per_key(empty, ["reactor_name"]).count() == 0
    keyed = surrogate_key(empty.select("reactor_name", "seq"), ["reactor_name"], "id")
    assert keyed.count() == 0 and "id" in keyed.columns
