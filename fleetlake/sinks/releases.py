"""Atomic publish of the gold tables (IO6, IO7, IO9, F14).

A table overwrite drops the old files before the new ones are complete, and seven tables
written one after another are a mixture until the last is done.  Here every build
writes its tables into a database and folder of its own, ``<gold>__<build>``.  Nobody
reads them until ``publish`` moves the pointer: one property of the gold database, set
by one catalog statement.  A build that fails or is killed changes nothing; its folder
stays unreferenced until ``retire`` removes it.

Readers ask for the pointer once (``published``) and use the settings they get for all
tables, so they see one build, also while the next one is published.  Plain SQL users
read ``<gold>.<table>``: a view on the current build's table, replaced as a whole.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession, functions as F

from fleetlake.settings import Settings
from fleetlake.sinks.tables import create_database

#: property of the gold database that names the database of the current build
POINTER = "fleetlake.current_build"
#: ... and of a build's database: when it was published, a number that ascends
ORDER = "fleetlake.published_as"


def _properties(spark: SparkSession, database: str) -> dict[str, str]:
    """The database's properties, read in one statement."""
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED `{database}`")
    text = rows.filter(F.col("info_name") == "Properties").select("info_value").first()
    return dict(re.findall(r"\(([^(),]+),([^()]*)\)", (text and text[0]) or ""))


def _set_property(spark: SparkSession, database: str, name: str, value: str) -> None:
    spark.sql(f"ALTER DATABASE `{database}` SET DBPROPERTIES ('{name}' = '{value}')")


def begin(spark: SparkSession, settings: Settings) -> Settings:
    """Settings of a new build: the same, with a gold database and folder of its own."""
    create_database(spark, settings.gold_db, settings.location(settings.gold_db))
    build = settings.with_(gold_db=f"{settings.gold_db}__{uuid.uuid4().hex[:12]}")
    create_database(spark, build.gold_db, build.location(build.gold_db))
    return build


def builds(spark: SparkSession, settings: Settings) -> list[str]:
    """Databases of all builds, the published ones first in the order of their publishing."""
    prefix = f"{settings.gold_db}__"
    found = [d.name for d in spark.catalog.listDatabases() if d.name.startswith(prefix)]
    order = {d: _properties(spark, d).get(ORDER) for d in found}
    return sorted(found, key=lambda d: (order[d] is None, int(order[d] or 0), d))


def current(spark: SparkSession, settings: Settings) -> str | None:
    """The database of the published build, if there is one."""
    if not spark.catalog.databaseExists(settings.gold_db):
        return None
    return _properties(spark, settings.gold_db).get(POINTER)


def published(spark: SparkSession, settings: Settings) -> Settings:
    """Settings under which all gold tables are those of one published build."""
    name = current(spark, settings)
    if name is None:
        raise LookupError(f"nothing is published in {settings.gold_db}")
    return settings.with_(gold_db=name)


def publish(spark: SparkSession, settings: Settings, build: Settings, tables) -> None:
    """Make ``build`` the one that readers see; every table must be there."""
    missing = [t for t in tables if not spark.catalog.tableExists(build.table("gold", t))]
    if missing:
        raise ValueError(f"build {build.gold_db} lacks {', '.join(missing)}")
    numbers = [int(_properties(spark, d).get(ORDER) or 0) for d in builds(spark, settings)]
    _set_property(spark, build.gold_db, ORDER, str(1 + max(numbers, default=0)))
    _set_property(spark, settings.gold_db, POINTER, build.gold_db)  # the commit
    point_views(spark, settings, tables)


def point_views(spark: SparkSession, settings: Settings, tables) -> None:
    """Let the gold database's views follow the pointer (also after an interrupted publish)."""
    build = published(spark, settings)
    for t in tables:
        spark.sql(f"CREATE OR REPLACE VIEW {settings.table('gold', t)} AS SELECT * FROM {build.table('gold', t)}")


def retire(spark: SparkSession, settings: Settings, keep: int = 2) -> list[str]:
    """Remove builds but the newest ``keep`` published ones and the current one, with
    their files; returns the databases removed.  Nothing may be building meanwhile."""
    names = builds(spark, settings)
    done = [d for d in names if _properties(spark, d).get(ORDER)]
    held = {*done[len(done) - min(keep, len(done)):], current(spark, settings)}
    gone = [d for d in names if d not in held]
    for d in gone:
        place = spark.catalog.getDatabase(d).locationUri
        spark.sql(f"DROP DATABASE `{d}` CASCADE")
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return gone


__all__ = ["begin", "builds", "current", "point_views", "publish", "published", "retire"]
