"""Rows equal in all fields: found, reduced to one with their number, dealt out again.

However many copies a row has, no task holds them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: copies that one task makes of a row at a time, about
COPIES = 4096


def measured(rows: DataFrame) -> tuple[int, bool]:
    """Bytes of all texts (and one for each row), and whether some rows of ``rows``
    (doc_id, text) are equal.  Rows are told apart by a 64-bit hash; if two agree by
    chance, a grouping more is done, with the same result."""
    alike = rows.groupBy(F.xxhash64("doc_id", F.col("doc_id").isNull(), "text").alias("row")).agg(
        F.sum(F.octet_length("text") + 1).alias("size"), F.count("*").alias("n"))
    found = alike.agg(F.sum("size").alias("total"), F.max("n").alias("most")).first()
    return found["total"] or 0, (found["most"] or 0) > 1


def reduced(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number ``n``."""
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


def in_parts(rows: DataFrame, copies: int = COPIES) -> DataFrame:
    """Each row once for at most ``copies`` of its ``n``: ``part`` is the number of
    that share, ``n`` its size."""
    parts = rows.withColumn("part", F.explode(F.expr(f"sequence(0L, (n - 1) div {copies})")))
    return parts.withColumn("n", F.least(F.lit(copies).cast("long"), F.col("n") - F.col("part") * copies))


def multiplied(rows: DataFrame, *by: str) -> DataFrame:
    """Every row ``n`` times, without ``n``; ``by`` and the share deal the copies to tasks."""
    parts = in_parts(rows).repartition(F.xxhash64(*by), "part")
    return parts.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("n", "part", "copy")


__all__ = ["in_parts", "measured", "multiplied", "reduced"]
