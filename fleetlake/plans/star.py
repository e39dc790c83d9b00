"""The star schema of the fixture views.

``Star`` assembles it lazily for queries about single operators; only the keyed
dimensions run jobs when they are first used (range bounds, checkpoint and the
counts of ``surrogate_key``).

``gold`` writes it once for each session and input through ``plans.layers`` and
returns the settings that name the tables.  Measures read these tables back, as a
BI tool would: no job runs before their own plan, and file statistics choose the
joins.  The tables are dropped when the driver's Python ends, and rebuilt when a
file of the input changes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from fleetlake.operators import dims, facts, pivot
from fleetlake.plans import layers
from fleetlake.session import checkpoint_dir, scratch_database, scratch_path
from fleetlake.settings import Settings
from fleetlake.sinks.tables import create_database, overwrite_table
from fleetlake.sources import fixtures

_GOLD: dict[tuple, Settings] = {}


@dataclass
class Star:
    spark: SparkSession
    sf_dir: str
    settings: Settings = Settings()

    @cached_property
    def assets(self) -> DataFrame:
        # read by several consumers: materialise the three-way join once in the
        # shared checkpoint folder instead of recomputing it for each
        checkpoint_dir(self.spark)
        return fixtures.assets(self.spark, self.sf_dir).checkpoint(eager=True)

    @cached_property
    def readings(self) -> DataFrame:
        return fixtures.readings(self.spark, self.sf_dir)

    @cached_property
    def plants(self) -> DataFrame:
        return dims.dim_plant(self.assets)

    @cached_property
    def reactors(self) -> DataFrame:
        return dims.dim_reactor(self.assets, self.plants)

    @cached_property
    def models(self) -> DataFrame:
        return dims.dim_model(self.assets)

    @cached_property
    def coolings(self) -> DataFrame:
        return dims.dim_cooling(self.assets)

    @cached_property
    def bridge(self) -> DataFrame:
        return dims.bridge(self.assets, self.reactors, self.models, self.coolings)

    @cached_property
    def wide(self) -> DataFrame:
        return pivot.long_to_wide(self.readings)

    @cached_property
    def fact(self) -> DataFrame:
        return facts.fact_availability(self.wide, self.reactors, strict=self.settings.strict,
                                       null_safe=not self.settings.compat)


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Length and time of each file that the star reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = []
    for name in ("customer", "nation", "part", "events"):
        path = hadoop.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.listStatus(path):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(found)


def gold(spark: SparkSession, sf_dir: str) -> Settings:
    """Settings of the gold tables of ``sf_dir``, written on first use."""
    key = (spark.sparkContext.applicationId, _stamp(spark, sf_dir))
    if key not in _GOLD:
        root = scratch_path(spark, "gold")
        tag = root.rsplit("-", 1)[-1]
        settings = Settings(silver_db=f"silver_{tag}", gold_db=f"gold_{tag}", warehouse=f"{root}/tables")
        for name in (settings.silver_db, settings.gold_db):
            scratch_database(spark, root, name)
        create_database(spark, settings.silver_db, settings.location(settings.silver_db))
        overwrite_table(fixtures.assets(spark, sf_dir), settings.table("silver", layers.ASSETS), settings)
        overwrite_table(fixtures.readings(spark, sf_dir), settings.table("silver", layers.READINGS), settings)
        layers.build_gold(spark, settings)
        _GOLD[key] = settings
    return _GOLD[key]
