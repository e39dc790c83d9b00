"""Rows in a total order over range partitions, and their ranks within a key.

No key's rows meet in one task: a range partition holds a stretch of the order, and a
rank is the place inside that stretch plus the count of the key's earlier ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import FILE_BYTES, stored


def range_count(df: DataFrame, n_bytes: int) -> int:
    """Range partitions for about ``n_bytes``: all cores have work, none gets too much."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return min(max(2 * cores, -(-n_bytes // FILE_BYTES)), 1 << 24)


def in_order(df: DataFrame, columns: list[str], name: str, n_bytes: int) -> DataFrame:
    """``df`` written in the order of ``columns`` (nulls first) with ``pid``, the range
    partition, and ``mid``, a number that ascends with the order.

    Rows that agree in all columns are interchangeable, so a task that runs again
    gives the same table."""
    keys = [F.col(c).asc_nulls_first() for c in columns]
    ranged = df.repartitionByRange(range_count(df, n_bytes), *keys).sortWithinPartitions(*keys)
    return stored(ranged.select("*", F.spark_partition_id().alias("pid"),
                                F.monotonically_increasing_id().alias("mid")), name, n_bytes)


def with_rank(ordered: DataFrame, key: str) -> DataFrame:
    """``rank`` (from 0) of each row among those of its ``key``, which leads the order
    and isn't null, and ``total``, their number.

    The runs of a key are at most one for each range partition."""
    runs = ordered.groupBy(key, "pid").agg(F.min("mid").alias("first_mid"), F.count("*").alias("n"))
    of_key = Window.partitionBy(key)
    earlier = of_key.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(key, "pid", "first_mid", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                       F.sum("n").over(of_key).alias("total"))
    return (ordered.join(runs, [key, "pid"])
            .withColumn("rank", F.col("before") + F.col("mid") - F.col("first_mid"))
            .drop("pid", "mid", "first_mid", "before"))


__all__ = ["in_order", "range_count", "with_rank"]
