"""Persistent surrogate keys (W1, F3): a registry of natural keys and the ids they were given.

Numbering a dimension anew on every build moves all ids behind an inserted member, and
facts written before point to the wrong one.  A registry keeps each id for good:
members it doesn't know (a null-safe anti-join) are numbered densely, in key order,
from the stored maximum on and appended; members that went keep their row and get the
same id when they come back.

The registry is a plain table that only grows by appends of one job each, so a failed
build leaves it as it was or complete, and running a build again adds nothing.  One
writer at a time is assumed, as for the gold tables themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlake.operators.keys import surrogate_key
from fleetlake.settings import Settings
from fleetlake.sinks.tables import create_database


def _same(left: DataFrame, right: DataFrame, keys):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def unseen(members: DataFrame, registry: DataFrame, keys) -> DataFrame:
    """Natural keys of ``members`` that ``registry`` doesn't hold, each once."""
    found = members.select(*keys).distinct()
    return found.join(registry, _same(found, registry, keys), "left_anti")


def numbered_from(new: DataFrame, keys, name: str, highest: int) -> DataFrame:
    """``new`` keys numbered densely from ``highest`` + 1 in key order."""
    numbered = surrogate_key(new, keys, name)
    return numbered.withColumn(name, (F.col(name) + F.lit(highest)).cast("int"))


def register(spark: SparkSession, members: DataFrame, table: str, keys, name: str,
             settings: Settings = Settings()) -> DataFrame:
    """Give every natural key of ``members`` its id; returns the registry table.

    Ids handed out before stay; new members are appended behind the highest."""
    keys = list(keys)
    if not spark.catalog.tableExists(table):
        first = surrogate_key(members.select(*keys).distinct(), keys, name)
        _append(first.select(*keys, name), table, settings)
        return spark.table(table)
    registry = spark.table(table)
    highest = registry.agg(F.max(name)).first()[0] or 0
    # checkpointed by surrogate_key before the append, so the read of the registry is over
    new = numbered_from(unseen(members, registry, keys), keys, name, highest)
    if not new.isEmpty():
        _append(new.select(*keys, name), table, settings)
    return spark.table(table)


def _append(rows: DataFrame, table: str, settings: Settings) -> None:
    writer = rows.write.format(settings.table_format).mode("append")
    path = settings.location(table)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def with_registered_key(df: DataFrame, registry: DataFrame, keys, name: str) -> DataFrame:
    """``df`` with the ids that the registry holds for its natural keys."""
    held = registry.select(*[F.col(k).alias(f"_{k}") for k in keys], name)
    on = reduce(lambda a, b: a & b, [df[k].eqNullSafe(held[f"_{k}"]) for k in keys])
    return df.join(held, on, "left").select(*df.columns, name)


#: what tells the members of a dimension apart, by the name of its id
NATURAL_KEYS = {"plant_id": ["plant"], "reactor_id": ["reactor"], "model_id": ["model", "rated_power"],
                "cooling_id": ["cooling", "cooling_source"]}


class Registry:
    """The registries of all dimensions, one table ``<database>.<id name>`` each."""

    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.settings, self.database = spark, settings, settings.registry_db
        create_database(spark, self.database, settings.location(self.database))

    def number(self, df: DataFrame, order, name: str) -> DataFrame:
        """Like ``surrogate_key``, with the ids that members keep (``order`` plays no part)."""
        keys = NATURAL_KEYS[name]
        held = register(self.spark, df, f"{self.database}.{name}", keys, name, self.settings)
        return with_registered_key(df, held, keys, name)


__all__ = ["NATURAL_KEYS", "Registry", "numbered_from", "register", "unseen", "with_registered_key"]
