"""Helpers shared by the operators: table reading, batch slicing, scratch tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.session import checkpoint_dir, discard, scratch_path

#: rows handled at once inside a Python task; bounds a worker's memory
SLICE_ROWS = 256
#: ... and so does their text (a single longer text is a slice of its own)
SLICE_CHARS = 2_000_000

#: least size of a scratch file, as far as that leaves work for all cores
FILE_BYTES = 32 << 20

#: the ASCII white space of the contracts, [\x20\x09-\x0D]
ASCII_SPACE = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just ``doc_id long, text string``; null text becomes the empty text."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def crc_bucket(id_col: str, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod


def slices(batches, columns: tuple[str, ...] = ("doc_id", "text")):
    """Python lists of the columns for a bounded number of rows at a time; the
    last column holds the texts whose size bounds a slice."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            lists = [part.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
            at, size = 0, 0
            for i, text in enumerate(lists[-1]):
                size += len(text or "")
                if size > SLICE_CHARS and i > at:
                    yield [x[at:i] for x in lists]
                    at, size = i, len(text or "")
            yield [x[at:] for x in lists]


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def in_files(df: DataFrame, n_bytes: int) -> DataFrame:
    """``df`` in partitions of at least ``FILE_BYTES`` as far as every core keeps
    two of them; many small partitions join without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(2 * cores, min(-(-n_bytes // FILE_BYTES), 1 << 30)))


def stored(df: DataFrame, name: str, n_bytes: int | None = None) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back: cuts the
    lineage, and its rows survive lost executors.

    With ``n_bytes``, about what is written, the files are sized by bytes instead
    of one for each of the plan's partitions."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df if n_bytes is None else in_files(df, n_bytes)).write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.scratch = path
    return found


def forget(df: DataFrame) -> None:
    """Remove the files of a ``stored`` table that nothing reads any more."""
    discard(df.scratch)


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the plan by Spark's own statistics; no job runs.

    Rows without statistics (an RDD's) count as a usual split for each partition."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else df.rdd.getNumPartitions() << 27


def ready(spark: SparkSession) -> SparkSession:
    checkpoint_dir(spark)
    return spark


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


__all__ = ["ASCII_SPACE", "FILE_BYTES", "SLICE_ROWS", "crc_bucket", "forget", "id_and_text", "in_files", "mix64",
           "read_table", "ready", "record_batch", "scanned_bytes", "slices", "stored"]
