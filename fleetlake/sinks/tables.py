"""Table sinks and DDL (IO6, IO7, IO9-IO12).

* ``overwrite_table``: whole-table overwrite in the configured format (D9).
* ``overwrite_partitioned``: partitioned overwrite.  Rows are first
  rebalanced on the partition columns (``REBALANCE`` hint): AQE sizes the
  write tasks from measured shuffle sizes and splits a partition value that
  holds a large share of the rows over several tasks, so one hot reactor does
  not become one straggler task or one huge file, while each task still
  writes few partition folders.  The table is created empty and filled after
  that: a table made and filled in one step lists every folder anew.  A
  metastore is told the partitions that were written; the in-memory catalog
  would keep each in the driver, so there the table's readers list the folders.
* ``read_folders``: the rows of chosen partition folders.  Only these are
  listed, where a table without static filters has all of them, with their
  files, listed into the driver.
* ``overwrite_clustered``: partition folders only on low-cardinality columns
  (``year``), rows range-partitioned and sorted by the cluster columns
  (``reactor_id, date_time``) inside each folder.  File count follows data
  volume (AQE sizes the range partitions), not key cardinality; readers
  filtering one reactor skip files and row groups by their min/max
  statistics; a hot reactor is split across tasks by ``date_time``.
* DDL only touches names it is given; dropping is an explicit reset step,
  never part of a build (F14).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlake.settings import Settings

TRACKED = "spark.sql.hive.manageFilesourcePartitions"  # of tables made while it is true the catalog keeps the partitions
INTEGERS = ("tinyint", "smallint", "int", "bigint")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Hadoop's local file system without .crc files; other file systems don't read these options
NO_CHECKSUM_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def use_database(spark: SparkSession, name: str) -> None:
    """Make ``name`` the current database (unqualified names resolve there)."""
    spark.catalog.setCurrentDatabase(name)


def drop_tables(spark: SparkSession, names) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def overwrite_table(df: DataFrame, name: str, settings: Settings = Settings(),
                    path: str | None = None) -> None:
    w = df.write.format(settings.table_format).mode("overwrite")
    path = path or settings.location(name)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def overwrite_partitioned(df: DataFrame, name: str, partition_cols, settings: Settings = Settings(),
                          path: str | None = None) -> None:
    cols = list(partition_cols)
    spark = df.sparkSession
    w = df.limit(0).write.format(settings.table_format).mode("overwrite").partitionBy(*cols)
    path = path or settings.location(name)
    if path:
        w = w.option("path", path)
    balanced = df.hint("rebalance", *cols)
    if spark.conf.get("spark.sql.catalogImplementation") == "hive":
        w.saveAsTable(name)
        balanced.select(*spark.table(name).columns).write.insertInto(name)
        return
    tracked = spark.conf.get(TRACKED)
    spark.conf.set(TRACKED, "false")
    try:
        w.saveAsTable(name)
    finally:
        spark.conf.set(TRACKED, tracked)
    filled = balanced.write.format(settings.table_format).mode("append").partitionBy(*cols)
    if not settings.checksum_files:
        filled = filled.options(**NO_CHECKSUM_FILES)
    filled.save(table_path(spark, name))


def table_path(spark: SparkSession, name: str) -> str:
    """The folder of a table, from the catalog alone."""
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    section = next(i for i, r in enumerate(about) if r["col_name"] == "# Detailed Table Information")
    return next(r["data_type"] for r in about[section:] if r["col_name"] == "Location")


def read_folders(spark: SparkSession, name: str, folders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows of a partitioned table in some of its folders: one row of ``folders`` has the
    values of all partition columns, which are integers, of one folder that exists."""
    columns = spark.catalog.listColumns(name)
    parts = [c for c in columns if c.isPartition]
    if sorted(c.name for c in parts) != sorted(folders.columns):
        raise ValueError(f"{name} has folders by {[c.name for c in parts]}, not by {folders.columns}")
    if other := [c.name for c in parts if c.dataType not in INTEGERS]:
        raise ValueError(f"folders are chosen by integers; {name} has {other}")
    schema = ", ".join(f"`{c.name}` {c.dataType}" for c in columns)
    root = table_path(spark, name)
    # names only, and of the chosen folders only
    level = [F.concat(F.lit(f"{c.name}="), F.coalesce(F.col(c.name).cast("string"), F.lit(NO_VALUE))) for c in parts]
    paths = [f"{root}/{r[0]}" for r in folders.distinct().select(F.concat_ws("/", *level)).toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.format(settings.table_format).schema(schema).option("basePath", root).load(paths)


def overwrite_clustered(df: DataFrame, name: str, partition_cols=("year",),
                        cluster_cols=("reactor_id", "date_time"), settings: Settings = Settings(),
                        path: str | None = None) -> None:
    keys = [*partition_cols, *cluster_cols]
    laid_out = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    w = laid_out.write.format(settings.table_format).mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    path = path or settings.location(name)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def write_fact(df: DataFrame, name: str, settings: Settings = Settings(), path: str | None = None) -> None:
    """Write the fact in the configured layout (clustered by default, D9)."""
    if settings.fact_cluster_by:
        overwrite_clustered(df, name, settings.fact_partitions, settings.fact_cluster_by, settings, path)
    else:
        overwrite_partitioned(df, name, settings.fact_partitions, settings, path)
