"""Incremental bronze ingest with Structured Streaming.

The reference re-reads its CSV files in full on every run.  The same bronze
step (bind columns by each file's header, set bad records apart, parse wall-clock
columns, repair every string column) runs here as a streaming query with
``trigger(availableNow=True)``: each run processes only files not seen before and stops.

The stream is one of files, not of lines: the ``binaryFile`` source with its content
column pruned names the new files, and each micro-batch reads these with the batch
reader.  So a file may have its columns in any order, optional ones missing and more
of them, as in the batch ingest.  A micro-batch writes the folder ``batch=<number>`` and
replaces it when it is run again, so a restarted or retried run neither loses nor
duplicates rows.  Rejects go to the folder ``<output>_rejects`` in the same way; a batch
without any writes none.

Checkpoint and output folders must be on shared storage; by default they go
under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fleetlake.plans.layers import bronze_frame
from fleetlake.settings import Settings
from fleetlake.sources.csv import count_rejects, good_rows, read_csv_checked, rejected_rows

_FILES = "path string, modificationTime timestamp, length long, content binary"
#: files of a micro-batch; their names pass the driver
FILES_PER_BATCH = 1000


def new_files(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The landing folder's files as a stream: path, time and length."""
    reader = (spark.readStream.format("binaryFile").schema(_FILES)
              .option("maxFilesPerTrigger", max_files_per_trigger or FILES_PER_BATCH))
    return reader.load(landing_dir).select("path", "modificationTime", "length")


def ingest_available(spark: SparkSession, landing_dir: str, schema: StructType, output_dir: str,
                     checkpoint_dir: str, settings: Settings = Settings(), timestamp_cols=(),
                     date_cols=(), optional: tuple[str, ...] = ("seq",),
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Process every file not yet ingested, then stop; returns the finished query."""
    def ingest(files: DataFrame, number: int) -> None:
        paths = [r["path"] for r in files.filter("length > 0").select("path").collect()]
        if not paths:
            return
        checked = read_csv_checked(files.sparkSession, paths, schema, settings.timestamp_format, settings.date_format,
                                   optional=optional, reject_unparsable=settings.reject_unparsable)
        rows, rejected = count_rejects(checked)
        bronze = bronze_frame(good_rows(rows), settings, timestamp_cols, date_cols)
        _save(bronze, output_dir, number)
        if rejected.get["n"]:
            _save(rejected_rows(checked), f"{output_dir.rstrip('/')}_rejects", number)

    def _save(df: DataFrame, folder: str, number: int) -> None:
        df.write.format(settings.table_format).mode("overwrite").save(f"{folder.rstrip('/')}/batch={number}")

    query = (new_files(spark, landing_dir, max_files_per_trigger).writeStream
             .foreachBatch(ingest)
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return query
