"""De-duplication and surrogate keys (A1-A3, W1; decisions D2, D3; SURVEY §4.3).

* ``distinct_rows`` / ``keep_one_per_key`` are aggregations, so Spark combines
  map-side first: a key holding a third of all rows costs one partial row per
  map task, never a whole group in one task.
* ``keep_one_per_key`` is deterministic (the reference kept an arbitrary row,
  F3): the survivor is the smallest row under a total order over the given
  columns, then all remaining columns, nulls last.
* ``surrogate_key`` numbers rows 1..n in that total order without moving all
  rows into one partition: range-partition by the order, number rows inside
  each partition, checkpoint (so the partition assignment is fixed even if an
  executor is lost and a stage re-runs), then add the running row count of all
  earlier partitions.  Those counts are one number per range partition (AQE
  sizes the partitions from measured bytes and only merges neighbours, so
  partition order stays key order) — thousands at most, not one per row — so
  they are collected once and inlined as constants (the scheme of
  ``RDD.zipWithIndex``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlake.session import checkpoint_dir

_RECORD_BITS = 33  # monotonically_increasing_id: partition id above bit 33


def sort_exprs(columns, nulls_last: bool = True) -> list[Column]:
    return [F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc() for c in columns]


def total_order(df: DataFrame, order) -> list[str]:
    order = list(order)
    return order + [c for c in df.columns if c not in order]


def distinct_rows(df: DataFrame, columns=None) -> DataFrame:
    """Row-level distinct over ``columns`` (A1, A3)."""
    return (df.select(*columns) if columns else df).distinct()


def keep_one_per_key(df: DataFrame, keys, order=None) -> DataFrame:
    """One row per key: the smallest by ``order`` then remaining columns."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ranked = [c for c in (list(order) if order else []) if c in rest]
    ranked += [c for c in rest if c not in ranked]
    # nulls last: each field is preceded by its is-null flag (false < true)
    packed = F.struct(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")).alias(f"f{i}")
                        for i, c in enumerate(ranked)])
    best = df.groupBy(*keys).agg(F.min(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.f{i}.v").alias(c) for i, c in enumerate(ranked)]) \
               .select(*df.columns)


def surrogate_key(df: DataFrame, order, name: str, num_partitions: int | None = None,
                  weight: str | None = None) -> DataFrame:
    """Append ``name`` = dense 1..n int over the total order (D3).

    With ``weight`` the key is 1 + the sum of the weights of all earlier rows:
    the position a row would have if it were repeated ``weight`` times, which
    is how the reference's fanned-out numbering is reproduced without
    materialising the fan-out (compat ``dim_reactor``)."""
    cols = total_order(df, order)
    spark = df.sparkSession
    checkpoint_dir(spark)
    exprs = sort_exprs(cols)
    # without an explicit count AQE sizes the range partitions from measured
    # bytes; coalescing merges neighbours only, so partition order = key order
    ranged = df.repartitionByRange(num_partitions, *exprs) if num_partitions else df.repartitionByRange(*exprs)
    staged = (ranged
                .sortWithinPartitions(*exprs)
                .select("*", F.spark_partition_id().alias("_pid"),
                        F.monotonically_increasing_id().alias("_mid"))
                .checkpoint(eager=True))
    size = F.lit(1) if weight is None else F.col(weight)
    # one row per range partition, collected once and inlined as constants
    totals = {r["_pid"]: r["_n"] for r in staged.groupBy("_pid").agg(F.sum(size).alias("_n")).collect()}
    offsets, running = [], 0
    for pid in range(max(totals, default=-1) + 1):
        offsets.append(running)
        running += int(totals.get(pid) or 0)
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets] or [F.lit(0).cast("long")]),
                          F.col("_pid") + 1)
    if weight is None:
        local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _RECORD_BITS)
    else:
        # running weight inside one range partition (AQE-sized, never a whole table)
        inside = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
        local = F.coalesce(F.sum(size).over(inside), F.lit(0))
    return staged.select(*df.columns, (offset + local + 1).cast("int").alias(name))
