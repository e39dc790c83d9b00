"""Catalog table scans (IO8) and the source-file inventory (IO13).

``file_inventory`` counts rows by the hidden ``_metadata`` column of file sources, so it
is computed by the executors that read the files.  It can't know a file without rows:
``file_listing`` lists the files themselves, with the ``binaryFile`` source whose content
column is pruned, and joins the counts.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, name: str, columns=None) -> DataFrame:
    df = spark.table(name)
    return df.select(*columns) if columns else df


def file_inventory(df: DataFrame) -> DataFrame:
    """Per source file: path, name, size, modification time and row count."""
    m = F.col("_metadata")
    return (df.select(m.file_path.alias("path"), m.file_name.alias("name"),
                      m.file_size.alias("size"), m.file_modification_time.alias("modification_time"))
              .groupBy("path", "name", "size", "modification_time")
              .agg(F.count(F.lit(1)).alias("n_rows")))


def _plain_path(path):
    """A path as both sources spell it: no empty authority, no percent escapes."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^([a-zA-Z0-9]+):/+", "$1:/")


_LISTED = "path string, size long, modification_time timestamp"


def _empty_files(spark: SparkSession, scan: DataFrame) -> DataFrame:
    """Files of the scan without a byte, which no task is given: the scan's own index
    names them.  Only these are asked for their time one by one."""
    indexed = spark.createDataFrame([(p,) for p in scan.inputFiles()], "path string").select(_plain_path(F.col("path")).alias("path"))
    read = scan.select(F.regexp_replace("path", "^([a-zA-Z0-9]+):/+", "$1:/").alias("path"))
    found = []
    for row in indexed.join(read, "path", "left_anti").collect():
        path = spark._jvm.org.apache.hadoop.fs.Path(row["path"])
        status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
        at = datetime.fromtimestamp(status.getModificationTime() / 1000, timezone.utc)
        found.append((row["path"], status.getLen(), at))
    return spark.createDataFrame(found, _LISTED)


def file_listing(spark: SparkSession, path: str, rows: DataFrame | None = None, glob: str | None = None) -> DataFrame:
    """Every file below ``path``: path, name, size, modification time and, of ``rows`` (a
    frame read from some of them), how many each holds.

    Files without rows, without a byte and of another kind are listed too, with 0 rows."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    scan = reader.load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modification_time"))
    files = scan.unionByName(_empty_files(spark, scan)).withColumn("name", F.regexp_extract("path", "[^/]+$", 0))
    if rows is None:
        return files.select("path", "name", "size", "modification_time", F.lit(0).cast("long").alias("n_rows"))
    # binaryFile gives the path as it is, _metadata with escapes
    counts = rows.groupBy(_plain_path(F.col("_metadata.file_path")).alias("of")).agg(F.count("*").alias("n"))
    key = F.regexp_replace("path", "^([a-zA-Z0-9]+):/+", "$1:/")
    return (files.join(counts, key == F.col("of"), "left")
            .select("path", "name", "size", "modification_time", F.coalesce("n", F.lit(0)).alias("n_rows")))
