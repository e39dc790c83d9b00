"""Data-quality operators (DQ1-DQ5, PF9, A4, A5, A7) and counts of casts that failed.

All reports are single-pass aggregations returning a DataFrame; nothing is
collected except by ``enforce_row_count``, which reads one aggregated row.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from fleetlake.functions.text import residual_flag, string_columns


def residual_report(df: DataFrame, columns=None, compat: bool = False) -> DataFrame:
    """Rows still carrying damage markers: any column and per string column (DQ1).

    With no string columns the report is all zeros (DQ2)."""
    cols = list(columns) if columns is not None else string_columns(df)
    flags = {c: F.coalesce(residual_flag(c, compat), F.lit(False)) for c in cols}
    any_bad = reduce(lambda a, b: a | b, flags.values()) if flags else F.lit(False)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(any_bad).alias("n_bad_rows"),
                  *[F.count_if(flag).alias(f"n_bad_{c}") for c, flag in flags.items()])


def residual_reports(tables: dict[str, DataFrame], compat: bool = False) -> DataFrame:
    """The residual report of every table in long form: a row for each string column,
    and one with column ``*`` for rows damaged in any of them (DQ1)."""
    reports = []
    for name, df in tables.items():
        cols = string_columns(df)
        counted = residual_report(df, cols, compat)
        lines = [F.struct(F.lit(c).alias("column_name"), F.col(n).alias("n_bad"))
                 for c, n in [("*", "n_bad_rows"), *[(c, f"n_bad_{c}") for c in cols]]]
        reports.append(counted.select(F.lit(name).alias("table_name"), "n_rows", F.explode(F.array(*lines)).alias("line"))
                       .select("table_name", "line.column_name", "n_rows", "line.n_bad"))
    return reduce(DataFrame.unionByName, reports)


def observe_casts(df: DataFrame, casts: dict[str, tuple[Column, Column]], name: str = "casts") -> tuple[DataFrame, Observation]:
    """``df`` and an observation that counts, while ``df`` is written, the values of each
    cast (name → text, parsed) and those that failed: text that isn't blank and gave NULL.

    The counts are complete when the write is; no second pass is made.  ``df`` must not
    be range-partitioned on the way to the write: its sampling would count rows again."""
    seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    metrics = []
    for column, (text, parsed) in casts.items():
        filled = F.coalesce(F.trim(text) != "", F.lit(False))
        metrics += [F.count_if(filled).alias(f"{column}.values"),
                    F.count_if(filled & parsed.isNull()).alias(f"{column}.failed")]
    return df.observe(seen, *metrics), seen


def cast_report(spark: SparkSession, counted: dict[str, Observation], columns: dict[str, list[str]]) -> DataFrame:
    """``table_name, column_name, n_values, n_failed`` from finished observations by table."""
    rows = [(table, c, seen.get[f"{c}.values"], seen.get[f"{c}.failed"])
            for table, seen in counted.items() for c in columns[table]]
    return spark.createDataFrame(rows, "table_name string, column_name string, n_values long, n_failed long")


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys occurring more than once, with their multiplicity (A7, DQ4)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def row_count_gate(df: DataFrame, key: str, expected: int | None = None) -> DataFrame:
    """One row: rows, distinct keys, expected, and whether the gate passes (DQ3).

    Passing needs every key exactly once and, if given, ``expected`` rows."""
    # a NULL key is a member of its own (D1), so it is counted as one
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 (F.count_distinct(F.col(key)) + F.coalesce(F.max(F.col(key).isNull().cast("long")), F.lit(0)))
                 .alias("n_keys"))
    ok = F.col("n_rows") == F.col("n_keys")
    if expected is not None:
        ok = ok & (F.col("n_rows") == F.lit(expected))
    return agg.select("n_rows", "n_keys", F.lit(expected).cast("bigint").alias("expected"),
                      ok.alias("passed"))


def enforce_row_count(df: DataFrame, key: str, expected: int | None = None) -> int:
    """Raise (with the duplicate listing) unless the gate passes; run before any write."""
    row = row_count_gate(df, key, expected).first()
    if not row["passed"]:
        dups = [r.asDict() for r in duplicate_keys(df, [key]).limit(20).collect()]
        raise ValueError(f"row-count gate failed on {key}: {row['n_rows']} rows, "
                         f"{row['n_keys']} distinct, expected {expected}; duplicates e.g. {dups}")
    return row["n_rows"]
