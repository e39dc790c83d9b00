"""Registered queries about the stored layers: publishing, refreshing, lasting keys and
what an ingest leaves behind.  All derive their sources from the driver's tables."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlake.functions import casts
from fleetlake.operators import dims, quality
from fleetlake.operators.registry import Registry
from fleetlake.plans import layers, oracle as O, refresh
from fleetlake.plans.registered import register
from fleetlake.plans.star import gold
from fleetlake.schemas import FACT_COLUMNS
from fleetlake.session import scratch_database, scratch_path
from fleetlake.settings import Settings
from fleetlake.sinks import releases
from fleetlake.sinks.tables import create_database, overwrite_table
from fleetlake.sources import fixtures
from fleetlake.sources.csv import good_rows, read_csv_checked, rejected_rows, write_csv
from fleetlake.sources.tables import file_listing
from fleetlake.streaming.ingest import ingest_available


def scratch_settings(spark: SparkSession, name: str, **kw) -> Settings:
    """Settings whose databases and files are removed when the driver's Python ends."""
    root = scratch_path(spark, name)
    tag = root.rsplit("-", 1)[-1]
    settings = Settings(bronze_db=f"bronze_{tag}", silver_db=f"silver_{tag}", gold_db=f"gold_{tag}",
                        warehouse=f"{root}/tables", **kw)
    for database in (settings.bronze_db, settings.silver_db, settings.gold_db):
        scratch_database(spark, root, database)
    return settings


def _scratch_release(spark: SparkSession, settings: Settings) -> Settings:
    """``release_gold`` whose build goes with the scratch folder."""
    before = set(releases.builds(spark, settings)) if spark.catalog.databaseExists(settings.gold_db) else set()
    try:
        return layers.release_gold(spark, settings)
    finally:
        root = settings.warehouse.rsplit("/", 1)[0]
        for build in set(releases.builds(spark, settings)) - before:
            scratch_database(spark, root, build)


def _silver(spark: SparkSession, settings: Settings, assets: DataFrame, readings: DataFrame) -> None:
    create_database(spark, settings.silver_db, settings.location(settings.silver_db))
    overwrite_table(assets, settings.table("silver", layers.ASSETS), settings)
    overwrite_table(readings, settings.table("silver", layers.READINGS), settings)


# --- publishing ---------------------------------------------------------------------


@register("gold_after_failed_build", O.sql(O.STAR, f"SELECT {O.FACT_COLUMNS} FROM fact"))
def q_gold_after_failed_build(spark, sf):
    """A strict build meets an unparsable power in the fact, after it has written six
    tables with fewer assets; readers still have the published build, whole."""
    settings = scratch_settings(spark, "release")
    assets, readings = fixtures.assets(spark, sf), fixtures.readings(spark, sf)
    _silver(spark, settings, assets, readings)
    build = _scratch_release(spark, settings)
    bad = readings.withColumn("value", F.when((F.col("parameter") == "power_available") & (F.col("seq") % 97 == 0),
                                              F.lit("no number")).otherwise(F.col("value")))
    _silver(spark, settings, assets.filter(F.right("reactor", F.lit(1)) != "7"), bad)
    try:
        _scratch_release(spark, settings.with_(strict=True))
    except PySparkException:
        pass
    else:
        raise AssertionError("the build should have failed")
    if releases.current(spark, settings) != build.gold_db:
        raise AssertionError("a failed build was published")
    return spark.table(settings.table("gold", "fact_availability")).select(*FACT_COLUMNS)


@register("gold_republished", O.sql([*O.STAR, """half AS (SELECT * FROM readings WHERE seq % 2 = 0)""",
                                     O.WIDE.replace("wide AS", "half_wide AS").replace("FROM readings", "FROM half")], f"""
SELECT 'held' AS reader, count(*) AS n_rows, count({O.to_int('power_available')}) AS n_power
FROM half_wide UNION ALL
SELECT 'new', count(*), count(power_available) FROM fact UNION ALL
SELECT 'view', count(*), count(power_available) FROM fact"""))
def q_gold_republished(spark, sf):
    """Two builds, of half and of all readings: who asked before the second still reads
    the first, whole; who asks after it reads the second, by pointer and by view."""
    settings = scratch_settings(spark, "republish")
    assets, readings = fixtures.assets(spark, sf), fixtures.readings(spark, sf)
    _silver(spark, settings, assets, readings.filter(F.col("seq") % 2 == 0))
    _scratch_release(spark, settings)
    held = releases.published(spark, settings)
    _silver(spark, settings, assets, readings)
    _scratch_release(spark, settings)
    found = {"held": held, "new": releases.published(spark, settings), "view": settings}
    counts = [spark.table(s.table("gold", "fact_availability")).agg(
        F.lit(reader).alias("reader"), F.count("*").alias("n_rows"), F.count("power_available").alias("n_power"))
        for reader, s in found.items()]
    return reduce(DataFrame.unionByName, counts)


# --- lasting keys -------------------------------------------------------------------

_KEPT_KEYS = [O.ASSETS, """first_members AS (SELECT * FROM assets WHERE right(reactor, 1) NOT IN ('0', '3', '6', '9'))""",
              """second_members AS (SELECT * FROM assets WHERE right(reactor, 1) NOT IN ('1', '5'))""",
              """first_reactors AS (SELECT reactor, row_number() OVER (ORDER BY reactor NULLS LAST) AS id
  FROM (SELECT DISTINCT reactor FROM first_members))""",
              """new_reactors AS (SELECT reactor, row_number() OVER (ORDER BY reactor NULLS LAST)
         + (SELECT max(id) FROM first_reactors) AS id
  FROM (SELECT DISTINCT reactor FROM second_members WHERE reactor NOT IN (SELECT reactor FROM first_reactors)))""",
              """first_models AS (SELECT model, rated_power, row_number() OVER (ORDER BY model NULLS LAST, rated_power NULLS LAST) AS id
  FROM (SELECT DISTINCT model, rated_power FROM first_members))""",
              """new_models AS (SELECT model, rated_power, row_number() OVER (ORDER BY model NULLS LAST, rated_power NULLS LAST)
         + (SELECT max(id) FROM first_models) AS id
  FROM (SELECT DISTINCT model, rated_power FROM second_members
        EXCEPT SELECT model, rated_power FROM first_models))"""]


@register("lasting_keys", O.sql(_KEPT_KEYS, """
SELECT 'reactor' AS dimension, reactor AS member, CAST(o.id AS INTEGER) AS first_id,
       CAST(COALESCE(o.id, n.id) AS INTEGER) AS id
FROM (SELECT DISTINCT reactor FROM second_members) m LEFT JOIN first_reactors o USING (reactor)
LEFT JOIN new_reactors n USING (reactor)
UNION ALL
SELECT 'model', concat_ws('/', m.model, m.rated_power), CAST(o.id AS INTEGER), CAST(COALESCE(o.id, n.id) AS INTEGER)
FROM (SELECT DISTINCT model, rated_power FROM second_members) m
LEFT JOIN first_models o ON o.model IS NOT DISTINCT FROM m.model AND o.rated_power IS NOT DISTINCT FROM m.rated_power
LEFT JOIN new_models n ON n.model IS NOT DISTINCT FROM m.model AND n.rated_power IS NOT DISTINCT FROM m.rated_power"""))
def q_lasting_keys(spark, sf):
    """Assets go and come between two builds: known members keep their id, new ones are
    numbered densely behind the highest id ever given."""
    settings = scratch_settings(spark, "keys")
    settings = settings.with_(registry_db=settings.gold_db.replace("gold_", "keys_"))
    scratch_database(spark, settings.warehouse.rsplit("/", 1)[0], settings.registry_db)
    assets = fixtures.assets(spark, sf)
    last = F.right("reactor", F.lit(1))
    number = Registry(spark, settings).number

    def dimensions(members):
        plants = dims.dim_plant(members, number=number)
        # written before the next build, as the gold layer does
        return (dims.dim_reactor(members, plants, number=number).checkpoint(),
                dims.dim_model(members, number=number).checkpoint())

    old_reactors, old_models = dimensions(assets.filter(~last.isin("0", "3", "6", "9")))
    reactors, models = dimensions(assets.filter(~last.isin("1", "5")))
    old_reactors = old_reactors.select(F.col("reactor").alias("member"), F.col("reactor_id").alias("first_id"))
    label = F.concat_ws("/", "model", "rated_power")
    old_models = old_models.select(label.alias("member"), F.col("model_id").alias("first_id"))
    kept = [(("reactor", reactors.select(F.col("reactor").alias("member"), F.col("reactor_id").alias("id"))), old_reactors),
            (("model", models.select(label.alias("member"), F.col("model_id").alias("id"))), old_models)]
    return reduce(DataFrame.unionByName, [
        new.join(old, "member", "left").select(F.lit(name).alias("dimension"), "member", "first_id", "id")
        for (name, new), old in kept])


# --- incremental refresh --------------------------------------------------------------

#: readings of a seventh of the events of a month's first five days come late
_LATE = "seq % 7 = 0 AND day(date_time) <= 5"


def _loaded(spark, sf) -> tuple[Settings, DataFrame]:
    settings = scratch_settings(spark, "refresh")
    readings = fixtures.readings(spark, sf)
    create_database(spark, settings.gold_db, settings.location(settings.gold_db))
    overwrite_table(spark.table(gold(spark, sf).table("gold", "dim_reactor")), settings.table("gold", "dim_reactor"), settings)
    refresh.load_readings(spark, readings.filter(f"NOT ({_LATE})"), settings, "day")
    refresh.load_fact(spark, settings, "day")
    return settings, readings.filter(_LATE)


@register("fact_in_two_batches", O.sql(O.STAR, f"SELECT {O.FACT_COLUMNS} FROM fact"))
def q_fact_in_two_batches(spark, sf):
    """A load without the late readings and a refresh with them equal the full load."""
    settings, late = _loaded(spark, sf)
    refresh.refresh_fact(spark, late, settings, "day")
    return refresh.fact_rows(spark, settings)


def _files(spark, settings) -> DataFrame:
    fact = spark.table(settings.table("gold", "fact_availability"))
    return fact.select("period", F.col("_metadata.file_path").alias("path"),
                       F.col("_metadata.file_modification_time").alias("at")).distinct()


@register("refresh_keeps_other_files", O.sql([O.READINGS, O.WIDE], """
SELECT strftime(date_time, '%Y-%m-%d') AS period, day(date_time) <= 5 AND count(*) FILTER (WHERE late) > 0 AS touched,
       NOT (day(date_time) <= 5 AND count(*) FILTER (WHERE late) > 0) AS kept
FROM (SELECT date_time, FALSE AS late FROM wide
      UNION ALL SELECT date_time, TRUE FROM readings WHERE seq % 7 = 0 AND day(date_time) <= 5
                AND date_time IN (SELECT date_time FROM wide)) GROUP BY date_time"""))
def q_refresh_keeps_other_files(spark, sf):
    """By period: whether the refresh wrote it anew, and whether its files are the same
    ones with the same modification times."""
    settings, late = _loaded(spark, sf)
    before = _files(spark, settings).checkpoint()
    touched = refresh.refresh_fact(spark, late, settings, "day")
    after = _files(spark, settings)
    same = (after.join(before.withColumn("old", F.lit(True)), ["period", "path", "at"], "full")
            .groupBy("period").agg(F.count_if(F.col("old").isNull()).alias("n_new"), F.count("*").alias("n")))
    gone = before.join(after, ["period", "path", "at"], "left_anti").groupBy("period").agg(F.count("*").alias("n_gone"))
    return same.join(gone, "period", "left").select(
        "period", F.col("period").isin(touched).alias("touched"),
        ((F.col("n_new") == 0) & F.coalesce(F.col("n_gone") == 0, F.lit(True))).alias("kept"))


# --- what an ingest leaves behind -------------------------------------------------------


@register("cast_failures", O.sql([O.READINGS, """odd AS (
  SELECT CASE seq % 5 WHEN 0 THEN value || 'd' WHEN 1 THEN value || 'F' WHEN 2 THEN ' ' || value || ' '
                      ELSE value END AS value FROM readings)""", f"""parsed AS (
  SELECT trim(value) <> '' AS filled, TRY_CAST(NULLIF(trim(value), '') AS DOUBLE) AS num, {O.to_int('value')} AS int FROM odd)"""],
    """SELECT 'readings' AS table_name, 'value_num' AS column_name, count(*) FILTER (filled) AS n_values,
  count(*) FILTER (filled AND num IS NULL) AS n_failed FROM parsed
UNION ALL SELECT 'readings', 'value_int', count(*) FILTER (filled), count(*) FILTER (filled AND int IS NULL) FROM parsed"""))
def q_cast_failures(spark, sf):
    """Values that didn't parse, counted by the write that parses them (D5, SF5)."""
    suffix = F.col("seq") % 5
    odd = (F.when(suffix == 0, F.concat("value", F.lit("d"))).when(suffix == 1, F.concat("value", F.lit("F")))
            .when(suffix == 2, F.concat(F.lit(" "), "value", F.lit(" "))).otherwise(F.col("value")))
    r = fixtures.readings(spark, sf).select("seq", odd.alias("value"))
    parsed = r.withColumns({"value_num": casts.to_number("value"), "value_int": casts.to_int("value")})
    parsed, seen = quality.observe_casts(parsed, {c: (F.col("value"), F.col(c)) for c in ("value_num", "value_int")})
    parsed.write.parquet(scratch_path(spark, "casts"))
    return quality.cast_report(spark, {"readings": seen}, {"readings": ["value_num", "value_int"]})


_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _write_lines(lines, header: str, path: str) -> None:
    """CSV files of ready-made lines: one column, named like the header, never quoted."""
    lines.select(F.col("line").alias(header)).write.option("header", "true").option("sep", "\u0001").option("quote", "").csv(path)


def _broken_orders(spark, sf, path: str):
    """Orders as CSV lines: some lack a field, some have one more, some hold no price."""
    o = fixtures.table(spark, sf, "orders")
    price = F.when(F.col("o_orderkey") % 17 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    fields = [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), price,
              casts.format_timestamp("o_orderdate"), F.col("o_orderpriority")]
    line = (F.when(F.col("o_orderkey") % 11 == 0, F.concat_ws(",", *fields[:-1]))
             .when(F.col("o_orderkey") % 13 == 0, F.concat_ws(",", *fields, F.lit("more")))
             .otherwise(F.concat_ws(",", *fields)))
    _write_lines(o.repartition(3).select(line.alias("line")), ",".join(_ORDER_COLUMNS), path)
    return o.schema


@register("csv_quarantine", """WITH told AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN 'malformed record'
  WHEN o_orderkey % 17 = 0 THEN 'unparsable o_totalprice' ELSE 'good' END AS kind FROM orders)
SELECT kind, count(*) AS n_records, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM told GROUP BY kind
UNION ALL SELECT 'lines', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM told""")
def q_csv_quarantine(spark, sf):
    """Good and rejected records of broken files, by reason; together they are all lines (IO1)."""
    path = scratch_path(spark, "quarantine")
    schema = _broken_orders(spark, sf, path)
    checked = read_csv_checked(spark, path, schema, reject_unparsable=True)
    key = F.split("record", ",")[0].cast("long")
    counts = lambda df, kind, value: df.groupBy(kind.alias("kind")).agg(
        F.count("*").alias("n_records"), F.sum(value).alias("key_sum"))
    lines = spark.read.text(path).filter(~F.col("value").startswith("o_orderkey"))
    return (counts(good_rows(checked), F.lit("good"), F.col("o_orderkey"))
            .unionByName(counts(rejected_rows(checked), F.col("reason"), key))
            .unionByName(counts(lines, F.lit("lines"), F.split("value", ",")[0].cast("long"))))


def _mixed_files(spark, sf, root: str):
    """Orders in files of three kinds: as they are, columns turned round with one more, one missing."""
    o = fixtures.table(spark, sf, "orders")
    kinds = {0: o.columns, 1: [*reversed(o.columns), "remark"], 2: [c for c in o.columns if c != "o_orderpriority"]}
    for kind, columns in kinds.items():
        part = o.filter(F.col("o_orderkey") % 3 == kind).withColumn("remark", F.lit("x"))
        write_csv(part.select(*columns), f"{root}/kind{kind}", timestamp_format="yyyy-MM-dd HH:mm:ss.SSSSSS")
    return o.schema


_MIXED = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderkey % 3 <> 2 THEN o_orderpriority END AS o_orderpriority FROM orders"""


@register("csv_mixed_headers", _MIXED)
def q_csv_mixed_headers(spark, sf):
    """One folder, three headers: every file's columns are bound by its own (IO2, IO3)."""
    root = scratch_path(spark, "mixed")
    schema = _mixed_files(spark, sf, root)
    return good_rows(read_csv_checked(spark, f"{root}/*", schema, timestamp_format="yyyy-MM-dd HH:mm:ss.SSSSSS",
                                      optional=("o_orderpriority",)))


@register("stream_mixed_headers", _MIXED)
def q_stream_mixed_headers(spark, sf):
    """The same files through the stream, two of them in each micro-batch."""
    root = scratch_path(spark, "mixed-stream")
    schema = _mixed_files(spark, sf, f"{root}/landing")
    ingest_available(spark, f"{root}/landing/*", schema, f"{root}/bronze", f"{root}/checkpoint",
                     Settings(timestamp_format="yyyy-MM-dd HH:mm:ss.SSSSSS"), optional=("o_orderpriority",),
                     max_files_per_trigger=2)
    return spark.read.parquet(f"{root}/bronze").select(*schema.names)


@register("file_listing", """SELECT event_type AS kind, count(*) AS n_rows, TRUE AS has_size, TRUE AS is_new FROM events GROUP BY event_type
UNION ALL SELECT 'empty.csv', 0, FALSE, TRUE UNION ALL SELECT 'header.csv', 0, TRUE, TRUE UNION ALL SELECT 'notes.txt', 0, TRUE, TRUE""")
def q_file_listing(spark, sf):
    """All files of a folder with size and time: data, an empty one, one with a header
    alone and a foreign one (IO13)."""
    path = scratch_path(spark, "listing")
    began = F.lit(datetime.now(timezone.utc) - timedelta(minutes=1))
    events = fixtures.table(spark, sf, "events")
    events.select("event_id", "event_type").repartition("event_type").write.option("header", "true").partitionBy("event_type").csv(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, text in (("empty.csv", ""), ("header.csv", "event_id\n"), ("notes.txt", "not a table\n")):
        out = store.create(hadoop.Path(f"{path}/{name}"))
        out.writeBytes(text)
        out.close()
    rows = spark.read.option("header", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").csv(path)
    kind = F.coalesce(F.nullif(F.regexp_extract("path", "event_type=([^/]+)/[^/]+$", 1), F.lit("")), F.col("name"))
    return file_listing(spark, path, rows).groupBy(kind.alias("kind")).agg(
        F.sum("n_rows").alias("n_rows"), F.bool_and(F.col("size") > 0).alias("has_size"),
        F.bool_and(F.col("modification_time") > began).alias("is_new"))


@register("residual_reports", O.sql([O.DAMAGED, O.READINGS], f"""
SELECT 'documents' AS table_name, u.column_name, count(*) AS n_rows, count(*) FILTER (u.bad) AS n_bad
FROM (SELECT unnest([{{'column_name': 'lang', 'bad': regexp_matches(coalesce(lang, ''), '{O.RESIDUAL_REGEX}')}},
                     {{'column_name': 'source', 'bad': regexp_matches(coalesce(source, ''), '{O.RESIDUAL_REGEX}')}},
                     {{'column_name': 'text', 'bad': regexp_matches(coalesce(text, ''), '{O.RESIDUAL_REGEX}')}},
                     {{'column_name': '*', 'bad': regexp_matches(concat_ws(' ', text, lang, source), '{O.RESIDUAL_REGEX}')}}]) AS u
      FROM damaged) GROUP BY u.column_name
UNION ALL SELECT 'readings', u.column_name, count(*), count(*) FILTER (u.bad)
FROM (SELECT unnest([{{'column_name': 'reactor_name', 'bad': regexp_matches(coalesce(reactor_name, ''), '{O.RESIDUAL_REGEX}')}},
                     {{'column_name': 'parameter', 'bad': regexp_matches(coalesce(parameter, ''), '{O.RESIDUAL_REGEX}')}},
                     {{'column_name': 'value', 'bad': regexp_matches(coalesce(value, ''), '{O.RESIDUAL_REGEX}')}},
                     {{'column_name': '*', 'bad': regexp_matches(concat_ws(' ', reactor_name, parameter, value), '{O.RESIDUAL_REGEX}')}}]) AS u
      FROM readings) GROUP BY u.column_name
UNION ALL SELECT 'lineitem_numbers', '*', count(*), 0 FROM lineitem"""))
def q_residual_reports(spark, sf):
    """Damage left in several tables at once: a damaged one, a clean one, one without text (DQ1, DQ2)."""
    return quality.residual_reports({
        "documents": fixtures.damaged_documents(spark, sf), "readings": fixtures.readings(spark, sf),
        "lineitem_numbers": fixtures.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")})
