"""CSV ingest (IO1-IO5): header, UTF-8, trimmed fields, bad records set apart.

An explicit schema is the default (no inference pass over the data); its columns
are found by the header's names, not by position.  With
``schema=None`` Spark infers types; the source's date / timestamp layouts must
then be given so that they are detected as dates and timestamps rather than
strings.

``read_csv_checked`` is the form that ingests use.  It takes files of different headers
(each file's columns are bound by its own), and tells of every record whether it could be
read: ``split_records`` gives the good rows and the rejects with file, reason and text.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import (
    DataType, DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType,
)


def csv_options(timestamp_format: str = "M/d/yyyy H:mm", date_format: str = "M/d/yyyy") -> dict:
    return {
        "header": "true",
        "enforceSchema": "false",  # every file's header must name the same columns in the same order
        "encoding": "UTF-8",
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
        "timestampFormat": timestamp_format,
        "timestampNTZFormat": timestamp_format,
        "dateFormat": date_format,
        "mode": "PERMISSIVE",
    }


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             timestamp_format: str = "M/d/yyyy H:mm", date_format: str = "M/d/yyyy",
             optional: tuple[str, ...] = (), **options) -> DataFrame:
    """CSV rows with columns bound by the **names in the header**.

    With a schema, its columns are picked by name (whatever their order, other
    columns are left out) and cast; a missing column raises, unless it is listed
    in ``optional``, in which case it is NULL.  ``schema=None`` infers types."""
    reader = spark.read.format("csv").options(**csv_options(timestamp_format, date_format)).options(**options)
    if schema is None:
        return reader.option("inferSchema", "true").option("preferDate", "true").load(path)
    # the header line is all that this looks at: without inference the values stay text
    raw = reader.option("inferSchema", "false").load(path)
    named = {c.strip(): c for c in raw.columns}
    missing = [f.name for f in schema if f.name not in named and f.name not in optional]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header has {', '.join(raw.columns)}")
    return raw.select(*[
        _typed(F.col(f"`{named[f.name]}`"), f.dataType, timestamp_format, date_format).alias(f.name)
        if f.name in named else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def _typed(text: Column, kind: DataType, timestamp_format: str, date_format: str) -> Column:
    """A field as its type; text that doesn't parse is NULL (permissive)."""
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, TimestampNTZType):
        return F.when(F.try_to_timestamp(text, F.lit(timestamp_format)).isNotNull(),
                      F.to_timestamp_ntz(text, F.lit(timestamp_format)))
    if isinstance(kind, TimestampType):
        return F.try_to_timestamp(text, F.lit(timestamp_format))
    if isinstance(kind, DateType):
        return F.try_to_date(text, date_format)
    return text.try_cast(kind)


# --- records that can't be read -------------------------------------------------------

#: columns beside a checked row: its file, why it is rejected (NULL if it isn't), its text,
#: and the columns whose text didn't parse
FILE, REASON, RECORD, FAILED = "_file", "_reason", "_record", "_failed"
REJECTS = StructType([StructField(c, StringType()) for c in ("file", "reason", "record")])
_CORRUPT = "_corrupt_record"
MALFORMED = "malformed record"


def header_groups(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Header line → files that have it, for all files of a folder.

    One scan of lines, from which each file's first is kept (combined before the
    shuffle); the driver gets a row for each file, as Spark's own file index does.
    Files without a line have no header and aren't listed."""
    meta = F.col("_metadata")
    lines = spark.read.text(path).select("value", meta.file_path.alias("path"), meta.file_block_start.alias("start"),
                                         F.monotonically_increasing_id().alias("n"))
    first = lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "n").alias("header"))
    found = first.groupBy(F.regexp_replace("header", "^\ufeff|\r$", "").alias("header")).agg(F.collect_list("path").alias("files"))
    return {r["header"]: sorted(unquote(f) for f in r["files"]) for r in found.collect()}


def _checked(spark: SparkSession, files, schema: StructType, timestamp_format: str, date_format: str,
             optional: tuple[str, ...], reject_unparsable: bool, options: dict) -> DataFrame:
    """The records of files that share one header."""
    reader = spark.read.format("csv").options(**csv_options(timestamp_format, date_format)).options(**options)
    header = reader.option("inferSchema", "false").load(files if isinstance(files, str) else files[0]).columns
    named = {c.strip(): c for c in header}
    missing = [f.name for f in schema if f.name not in named and f.name not in optional]
    if missing:
        raise ValueError(f"{files} has no column {', '.join(missing)}; its header has {', '.join(header)}")
    # every field as text, and the whole record where the fields aren't as many as the header's
    text = StructType([StructField(c, StringType()) for c in [*header, _CORRUPT]])
    # all fields are parsed, also where few are used: a pruned parser counts none
    raw = (reader.option("enforceSchema", "true").option("columnPruning", "false")
           .option("columnNameOfCorruptRecord", _CORRUPT).schema(text).load(files)
           .withColumn(FILE, F.col("_metadata.file_path")))
    typed, failed = [], []
    for f in schema:
        if f.name not in named:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        field = F.col(f"`{named[f.name]}`")
        value = _typed(field, f.dataType, timestamp_format, date_format)
        typed.append(value.alias(f.name))
        if not isinstance(f.dataType, StringType):
            failed.append(F.when((F.trim(field) != "") & value.isNull(), f.name))
    failed = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    # not "is not null", which the parser would take over and answer before it knows
    # ... and with a field beside it, as Spark refuses to read the record's text alone
    beside = F.length(F.coalesce(F.col(f"`{header[0]}`"), F.lit(""))) >= 0
    reason = F.when((F.coalesce(_CORRUPT, F.lit("")) != "") & beside, MALFORMED)
    if reject_unparsable:
        reason = reason.when(F.size(failed) > 0, F.concat(F.lit("unparsable "), F.array_join(failed, ", ")))
    record = F.coalesce(F.col(_CORRUPT), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in header])))
    return raw.select(*typed, FILE, reason.alias(REASON), F.when(reason.isNotNull(), record).alias(RECORD),
                      failed.alias(FAILED))


def read_csv_checked(spark: SparkSession, path: str | list[str], schema: StructType,
                     timestamp_format: str = "M/d/yyyy H:mm", date_format: str = "M/d/yyyy",
                     optional: tuple[str, ...] = (), reject_unparsable: bool = False, mixed_headers: bool = True,
                     **options) -> DataFrame:
    """All records of all files: the schema's columns, then ``_file, _reason, _record, _failed``.

    A record with more or fewer fields than its file's header is malformed.  A field
    that doesn't parse is NULL and named in ``_failed``; with ``reject_unparsable`` it
    rejects its record.  ``mixed_headers=False`` saves the scan for headers where all
    files are known to have the same."""
    groups = list(header_groups(spark, path).values()) if mixed_headers else [path]
    if not groups:
        extra = [StructField(c, StringType()) for c in (FILE, REASON, RECORD)]
        return spark.createDataFrame([], StructType([*schema, *extra])).withColumn(FAILED, F.array().cast("array<string>"))
    if len(groups) == 1:
        groups = [path]  # one header: the folder as it is
    return reduce(DataFrame.unionByName, [
        _checked(spark, files, schema, timestamp_format, date_format, optional, reject_unparsable, options)
        for files in groups])


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(FILE, REASON, RECORD, FAILED)


def rejected_rows(checked: DataFrame) -> DataFrame:
    """``file, reason, record`` of the records that weren't taken."""
    return checked.filter(F.col(REASON).isNotNull()).select(
        F.col(FILE).alias("file"), F.col(REASON).alias("reason"), F.col(RECORD).alias("record"))


def count_rejects(checked: DataFrame) -> tuple[DataFrame, Observation]:
    """``checked`` and an observation that counts its rejects (``n``) while it is used."""
    seen = Observation()
    return checked.observe(seen, F.count_if(F.col(REASON).isNotNull()).alias("n")), seen


def write_csv(df: DataFrame, path: str, timestamp_format: str = "M/d/yyyy H:mm",
              date_format: str = "M/d/yyyy") -> None:
    (df.write.mode("overwrite")
       .option("header", "true").option("encoding", "UTF-8")
       .option("timestampFormat", timestamp_format)
       .option("timestampNTZFormat", timestamp_format)
       .option("dateFormat", date_format)
       .csv(path))
