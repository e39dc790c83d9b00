"""Registered queries: one per operator family of SURVEY §2 / §7.3.

Queries about publishing, refreshing and ingesting are in ``catalog_store``.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the Spark implementation on
the driver's parquet tables; ``ORACLES[name]`` is an independent DuckDB SQL
answer over the same tables (absent where SQL cannot express the operator:
the file inventory's modification times).
Column names and types agree between the two.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlake.functions import casts
from fleetlake.functions.calendar import floor_minutes
from fleetlake.functions.text import induce_mojibake, nfkc, repair_reference_order, repair_string_columns
from fleetlake.operators import analytics, dims, facts, keys, pivot, quality
from fleetlake.plans import catalog_store, dashboard, layers, oracle as O
from fleetlake.plans.registered import ORACLES, QUERIES, register
from fleetlake.plans.star import Star, gold
from fleetlake.schemas import FACT_COLUMNS, READINGS_CSV
from fleetlake.settings import Settings
from fleetlake.session import scratch_database, scratch_path
from fleetlake.sinks.tables import create_database, drop_tables, overwrite_table, read_folders, use_database, write_fact
from fleetlake.sources import fixtures
from fleetlake.sources.csv import read_csv, write_csv
from fleetlake.sources.tables import file_inventory
from fleetlake.streaming.ingest import ingest_available

def _gold(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A written gold table of ``sf``."""
    return spark.table(gold(spark, sf).table("gold", name))


WIDE_COLUMNS = "date_time, reactor_name, power_available, derating, unavailability_type, " \
               "unavailability_cause, additional_info"

# --- pivot, fact, flags -------------------------------------------------------


@register("long_to_wide", O.sql([O.READINGS, O.WIDE], f"SELECT {WIDE_COLUMNS} FROM wide"))
def q_long_to_wide(spark, sf):
    return Star(spark, sf).wide


@register("long_to_wide_join_form",
          O.sql([O.READINGS, O.CELLS, O.WIDE_JOIN_FORM], f"SELECT {WIDE_COLUMNS} FROM wide"))
def q_long_to_wide_join_form(spark, sf):
    return pivot.long_to_wide_join_form(fixtures.readings(spark, sf))


@register("fact_availability", O.sql(O.STAR, f"SELECT {O.FACT_COLUMNS} FROM fact"))
def q_fact_availability(spark, sf):
    return Star(spark, sf).fact


@register("fact_availability_calendar_join", O.sql(O.STAR, f"SELECT {O.FACT_COLUMNS} FROM fact"))
def q_fact_calendar_join(spark, sf):
    s = Star(spark, sf)
    return facts.fact_availability(s.wide, _gold(spark, sf, "dim_reactor"),
                                   calendar=dims.dim_datetime(s.readings), null_safe=True)


@register("outage_flags", O.sql(O.STAR, """SELECT is_unavailable, is_derated, count(*) AS n_readings
FROM fact GROUP BY is_unavailable, is_derated"""))
def q_outage_flags(spark, sf):
    return (_gold(spark, sf, "fact_availability").groupBy("is_unavailable", "is_derated")
            .agg(F.count(F.lit(1)).alias("n_readings")))


@register("fill_defaults", O.sql([O.READINGS, O.WIDE, O.TYPED], """SELECT date_time, reactor_name,
  derating_parsed, COALESCE(derating_parsed, 0) AS derating FROM typed"""))
def q_fill_defaults(spark, sf):
    typed = facts.typed_cells(Star(spark, sf).wide)
    return facts.fill_defaults(typed.select("date_time", "reactor_name",
                                            F.col("derating").alias("derating_parsed"), "derating"))


# --- dimensions and keys --------------------------------------------------------


@register("dim_plant", O.sql([O.ASSETS, O.DIM_PLANT], "SELECT plant, lat, lon, plant_id FROM dim_plant"))
def q_dim_plant(spark, sf):
    return Star(spark, sf).plants


@register("dim_reactor", O.sql([O.ASSETS, O.DIM_PLANT, O.DIM_REACTOR],
                               "SELECT reactor_id, reactor, plant_id, grid_connection FROM dim_reactor"))
def q_dim_reactor(spark, sf):
    return Star(spark, sf).reactors


@register("dim_reactor_compat", O.sql([O.ASSETS_VARIANTS, O.DIM_PLANT_COMPAT, O.DIM_REACTOR_COMPAT],
                                      "SELECT reactor_id, reactor, plant_id, grid_connection FROM dim_reactor"))
def q_dim_reactor_compat(spark, sf):
    a = fixtures.assets(spark, sf, coordinate_variants=True)
    return dims.dim_reactor(a, dims.dim_plant(a, compat=True), compat=True)


@register("dim_plant_compat", O.sql([O.ASSETS_VARIANTS, O.DIM_PLANT_COMPAT],
                                    "SELECT plant, lat, lon, plant_id FROM dim_plant"))
def q_dim_plant_compat(spark, sf):
    return dims.dim_plant(fixtures.assets(spark, sf, coordinate_variants=True), compat=True)


@register("dim_plant_resolved", O.sql([O.ASSETS_VARIANTS, O.DIM_PLANT],
                                      "SELECT plant, lat, lon, plant_id FROM dim_plant"))
def q_dim_plant_resolved(spark, sf):
    return dims.dim_plant(fixtures.assets(spark, sf, coordinate_variants=True))


@register("dim_model", O.sql([O.ASSETS, O.DIM_MODEL], "SELECT model_id, model, rated_power FROM dim_model"))
def q_dim_model(spark, sf):
    return Star(spark, sf).models


@register("dim_cooling", O.sql([O.ASSETS, O.DIM_COOLING],
                               "SELECT cooling_id, cooling, cooling_source FROM dim_cooling"))
def q_dim_cooling(spark, sf):
    return Star(spark, sf).coolings


@register("dim_datetime", """SELECT date_time,
  CAST(strftime(date_time, '%Y%m%d%H%M') AS BIGINT) AS date_key,
  CAST(year(date_time) AS INTEGER) AS year, CAST(month(date_time) AS INTEGER) AS month,
  CAST(day(date_time) AS INTEGER) AS day, CAST(hour(date_time) AS INTEGER) AS hour
FROM (SELECT DISTINCT time_bucket(INTERVAL 30 MINUTE, ts) AS date_time FROM events)""")
def q_dim_datetime(spark, sf):
    ev = fixtures.table(spark, sf, "events").select(floor_minutes("ts", 30).alias("date_time"))
    return dims.dim_datetime(ev)


@register("bridge", O.sql([O.ASSETS, O.DIM_PLANT, O.DIM_REACTOR, O.DIM_MODEL, O.DIM_COOLING, O.BRIDGE],
                          "SELECT reactor_id, model_id, cooling_id FROM bridge"))
def q_bridge(spark, sf):
    # built from the written dimensions, as the gold layer does
    return dims.bridge(fixtures.assets(spark, sf), *[_gold(spark, sf, t) for t in ("dim_reactor", "dim_model", "dim_cooling")])


@register("bridge_fanout", O.sql([O.ASSETS, O.DIM_PLANT, O.DIM_REACTOR, O.DIM_MODEL, O.DIM_COOLING,
                                  O.BRIDGE_COMPAT], """SELECT reactor_id,
  GREATEST(count(DISTINCT model_id), 1) AS model_rows, GREATEST(count(DISTINCT cooling_id), 1) AS cooling_rows,
  count(*) AS bridge_rows FROM bridge GROUP BY reactor_id"""))
def q_bridge_fanout(spark, sf):
    return dims.bridge_fanout(fixtures.assets(spark, sf), _gold(spark, sf, "dim_reactor"))


SEGMENT_RANK = """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
  CAST(row_number() OVER (ORDER BY c_mktsegment NULLS LAST, c_acctbal NULLS LAST, c_custkey NULLS LAST,
                                   c_name NULLS LAST, c_nationkey NULLS LAST) AS INTEGER) AS segment_rank
FROM customer"""


@register("surrogate_key_scaled", SEGMENT_RANK)
def q_surrogate_key_scaled(spark, sf):
    c = fixtures.table(spark, sf, "customer")
    return keys.surrogate_key(c, ["c_mktsegment", "c_acctbal"], "segment_rank")


@register("surrogate_key_window", SEGMENT_RANK)
def q_surrogate_key_window(spark, sf):
    """The window's numbers, over a given number of range partitions and no window over all rows."""
    c = fixtures.table(spark, sf, "customer")
    return keys.surrogate_key(c, ["c_mktsegment", "c_acctbal"], "segment_rank", num_partitions=16)


# --- text repair and data quality -------------------------------------------------

def _sql_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _chain(text: str, pairs) -> str:
    for bad, good in pairs:
        text = f"replace({text}, {_sql_literal(bad)}, {_sql_literal(good)})"
    return text


# Fixed values, written out apart from the implementation's table so that a wrong
# pair there can't agree with itself: the ten replacements in their order.
ORACLE_PAIRS = (("Ã©", "é"), ("Ã¨", "è"), ("Ã´", "ô"), ("Ã¢", "â"), ("Ãª", "ê"),
                ("Ã«", "ë"), ("Ã§", "ç"), ("Ã", "à"), ("â€™", "'"), ("â€", '"'))
COMPAT_CHAIN = _chain("text", ORACLE_PAIRS)

# The NFKC forms of the Latin-1 characters that have one.
LATIN1_NFKC = (("\u00a0", " "), ("¨", " \u0308"), ("ª", "a"), ("¯", " \u0304"), ("²", "2"), ("³", "3"),
               ("´", " \u0301"), ("µ", "μ"), ("¸", " \u0327"), ("¹", "1"), ("º", "o"),
               ("¼", "1⁄4"), ("½", "1⁄2"), ("¾", "3⁄4"))


@register("text_repair", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_text_repair(spark, sf):
    return repair_string_columns(fixtures.damaged_documents(spark, sf))


@register("text_repair_compat", O.sql([O.DAMAGED], f"""SELECT doc_id, {COMPAT_CHAIN} AS text FROM damaged"""))
def q_text_repair_compat(spark, sf):
    d = fixtures.damaged_documents(spark, sf).select("doc_id", "text")
    return repair_string_columns(d, compat=True)


# Damage beside a character that no single-byte page holds, so that the text can't be read
# back as a whole; the oracle writes the spellings of the French letters out by its own rule.
FRENCH_SIGNS = "’‘“”–—…€" "«»°\u00a0" "àâäçéèêëîïôöùûüÿæœÀÂÄÇÉÈÊËÎÏÔÖÙÛÜŸÆŒ"
MIXED_CHAIN = _chain("text", [(c.encode().decode("latin-1"), c) for c in FRENCH_SIGNS])


@register("text_repair_mixed", O.sql([O.DAMAGED], f"SELECT doc_id, {MIXED_CHAIN} || ' → ' AS text FROM damaged"))
def q_text_repair_mixed(spark, sf):
    """Damaged text that also holds a character beyond the code pages: replaced spelling
    by spelling (U4, the branch without a round trip); other letters stay damaged."""
    d = fixtures.damaged_documents(spark, sf).select("doc_id", F.concat("text", F.lit(" → ")).alias("text"))
    return repair_string_columns(d)


@register("text_nfkc", "SELECT doc_id, text FROM documents")
def q_text_nfkc(spark, sf):
    """Compatibility characters put in by rule (ligatures, full-width digits, ordinal
    and superscript forms) normalise back to the text they stand for."""
    d = fixtures.table(spark, sf, "documents")
    odd = F.translate(F.replace(F.replace("text", F.lit("ffi"), F.lit("ﬃ")), F.lit("fi"), F.lit("ﬁ")),
                      "0123456789aonV", "０１²³４５６７８９ªºⁿⅤ")
    return d.select("doc_id", nfkc(odd).alias("text"))


@register("text_repair_reference_order", O.sql([O.DAMAGED],
          f"SELECT doc_id, {_chain(f'nfc_normalize({_chain('text', LATIN1_NFKC)})', ORACLE_PAIRS)} AS text FROM damaged"))
def q_text_repair_reference_order(spark, sf):
    """The reference's exact order: NFKC, then the ten pairs."""
    d = fixtures.damaged_documents(spark, sf)
    return d.select("doc_id", repair_reference_order("text").alias("text"))


def _residual_sql(source: str) -> str:
    flag = {c: f"COALESCE(regexp_matches({c}, '{O.RESIDUAL_REGEX}'), FALSE)" for c in ("text", "lang", "source")}
    return (f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE {' OR '.join(flag.values())}) AS n_bad_rows, "
            + ", ".join(f"count(*) FILTER (WHERE {v}) AS n_bad_{k}" for k, v in flag.items())
            + f" FROM {source}")


@register("residual_report", O.sql([O.DAMAGED], _residual_sql("damaged")))
def q_residual_report(spark, sf):
    return quality.residual_report(fixtures.damaged_documents(spark, sf))


@register("residual_report_after_repair", _residual_sql("documents"))
def q_residual_report_after_repair(spark, sf):
    return quality.residual_report(repair_string_columns(fixtures.damaged_documents(spark, sf)))


@register("duplicate_keys", O.sql([O.READINGS], """SELECT date_time, reactor_name, parameter, count(*) AS n
FROM readings GROUP BY date_time, reactor_name, parameter HAVING count(*) > 1"""))
def q_duplicate_keys(spark, sf):
    return quality.duplicate_keys(fixtures.readings(spark, sf), ["date_time", "reactor_name", "parameter"])


@register("plant_conflicts", O.sql([O.ASSETS_VARIANTS], """SELECT plant, count(*) AS n
FROM (SELECT DISTINCT plant, lat, lon FROM assets) GROUP BY plant HAVING count(*) > 1"""))
def q_plant_conflicts(spark, sf):
    a = fixtures.assets(spark, sf, coordinate_variants=True)
    return quality.duplicate_keys(keys.distinct_rows(a, ["plant", "lat", "lon"]), ["plant"])


@register("row_count_gate", O.sql([O.ASSETS, O.DIM_PLANT, O.DIM_REACTOR], """SELECT count(*) AS n_rows,
  count(DISTINCT reactor) AS n_keys, CAST(NULL AS BIGINT) AS expected,
  count(*) = count(DISTINCT reactor) AS passed FROM dim_reactor"""))
def q_row_count_gate(spark, sf):
    return quality.row_count_gate(_gold(spark, sf, "dim_reactor"), "reactor")


# --- casts, sources and sinks ------------------------------------------------------


@register("parse_timestamp", """SELECT o_orderkey, strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS o_orderdate_text,
  o_orderdate FROM orders""")
def q_parse_timestamp(spark, sf):
    o = fixtures.table(spark, sf, "orders").select(
        "o_orderkey", casts.format_timestamp("o_orderdate").alias("o_orderdate_text"))
    return o.withColumn("o_orderdate", casts.parse_timestamp("o_orderdate_text"))


@register("lenient_cast", O.sql([O.READINGS], f"""SELECT seq, value,
  TRY_CAST(NULLIF(trim(value), '') AS DOUBLE) AS value_num, {O.to_int('value')} AS value_int
FROM (SELECT seq, CASE seq % 5 WHEN 0 THEN value || 'd' WHEN 1 THEN value || 'F' WHEN 2 THEN ' ' || value || ' '
                              ELSE value END AS value FROM readings)"""))
def q_lenient_cast(spark, sf):
    """Plain, padded and suffixed numbers: a type suffix is no number."""
    suffix = F.col("seq") % 5
    odd = (F.when(suffix == 0, F.concat("value", F.lit("d"))).when(suffix == 1, F.concat("value", F.lit("F")))
            .when(suffix == 2, F.concat(F.lit(" "), "value", F.lit(" "))).otherwise(F.col("value")))
    r = fixtures.readings(spark, sf).withColumn("value", odd)
    return r.select("seq", "value", casts.to_number("value").alias("value_num"),
                    casts.to_int("value").alias("value_int"))


@register("silver_readings", O.sql([O.READINGS], """SELECT date_time, NULLIF(trim(reactor_name), '') AS reactor_name,
  lower(trim(parameter)) AS parameter, NULLIF(trim(value), '') AS value,
  TRY_CAST(NULLIF(trim(value), '') AS DOUBLE) AS value_num, seq FROM readings"""))
def q_silver_readings(spark, sf):
    return layers.silver_readings(fixtures.readings(spark, sf))


@register("csv_round_trip", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority FROM orders""")
def q_csv_round_trip(spark, sf):
    orders = fixtures.table(spark, sf, "orders")
    path = scratch_path(spark, "csv-orders")
    write_csv(orders, path, timestamp_format="yyyy-MM-dd HH:mm:ss.SSSSSS")  # keeps every field of the time
    return read_csv(spark, path, schema=orders.schema, timestamp_format="yyyy-MM-dd HH:mm:ss.SSSSSS")


@register("csv_inferred", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderdate,
  'int,int,double,string,timestamp' AS kinds FROM orders""")
def q_csv_inferred(spark, sf):
    """Types inferred from the text (IO3)."""
    orders = fixtures.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                                        "o_orderpriority", "o_orderdate")
    path = scratch_path(spark, "csv-inferred")
    write_csv(orders, path)
    found = read_csv(spark, path)
    kinds = ",".join(k.removesuffix("_ntz") for _, k in found.dtypes)
    return found.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_totalprice",
                        "o_orderpriority", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
                        F.lit(kinds).alias("kinds"))


@register("ddl_round_trip", "SELECT 'nations' AS table_name, count(*) AS n_rows FROM nation")
def q_ddl_round_trip(spark, sf):
    """Create and use a database, drop two of three tables; what is left, by its short name (IO9-IO12)."""
    path = scratch_path(spark, "ddl")
    name = "ddl_" + path.rsplit("-", 1)[-1]
    scratch_database(spark, path, name)
    create_database(spark, name, f"{path}/db")
    before = spark.catalog.currentDatabase()
    use_database(spark, name)
    try:
        for table, source in (("nations", "nation"), ("regions", "region"), ("legacy", "region")):
            overwrite_table(fixtures.table(spark, sf, source), table, path=f"{path}/db/{table}")
        drop_tables(spark, ["regions"])
        drop_tables(spark, ["legacy", "never_there"])
        left = [t.name for t in spark.catalog.listTables()]
        counts = [spark.table(t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n_rows")) for t in left]
        return reduce(DataFrame.union, counts)
    finally:
        use_database(spark, before)


@register("residual_report_no_strings", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad_rows FROM lineitem")
def q_residual_report_no_strings(spark, sf):
    """A table without string columns has no damage to report (DQ2)."""
    return quality.residual_report(fixtures.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity"))


@register("readings_four_columns", O.sql([O.ASSETS, O.READINGS, O.WIDE.replace("arg_max(value, seq)", "max(value)"),
                                          O.TYPED, O.DIM_PLANT, O.DIM_REACTOR, O.FACT],
                                         f"SELECT {O.FACT_COLUMNS} FROM fact"))
def q_readings_four_columns(spark, sf):
    """Sources as they really come: readings without ``seq``, columns in another order
    and one more of them; of equal cells the greatest value wins."""
    root = scratch_path(spark, "four")
    tag = root.rsplit("-", 1)[-1]
    settings = Settings(bronze_db=f"bronze_{tag}", silver_db=f"silver_{tag}", gold_db=f"gold_{tag}",
                        warehouse=f"{root}/tables")
    for name in (settings.bronze_db, settings.silver_db, settings.gold_db):
        scratch_database(spark, root, name)
    asset_csv, readings_csv = f"{root}/src/assets", f"{root}/src/readings"
    assets = fixtures.assets(spark, sf)
    write_csv(assets.select("plant", "reactor", *[c for c in assets.columns if c not in ("plant", "reactor")]), asset_csv)
    write_csv(fixtures.readings(spark, sf).select("value", "parameter", F.lit("x").alias("remark"), "date_time",
                                                  "reactor_name"), readings_csv)
    layers.build_bronze(spark, asset_csv, readings_csv, settings)
    layers.build_silver(spark, settings)
    return spark.table(layers.build_gold(spark, settings)["fact_availability"]).select(*FACT_COLUMNS)


@register("gate_with_unknown_member", """SELECT count(DISTINCT c_custkey) + 1 AS n_rows,
  count(DISTINCT c_custkey) + 1 AS n_keys, CAST(NULL AS BIGINT) AS expected, TRUE AS passed
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q_gate_with_unknown_member(spark, sf):
    """Blank reactor names are one unknown member, which the gate counts as a key (DQ3, D1)."""
    a = fixtures.assets(spark, sf)
    blank = a.withColumn("reactor", F.lit("  "))
    silver = layers.silver_assets(a.unionByName(blank))
    return quality.row_count_gate(dims.dim_reactor(silver, dims.dim_plant(silver)), "reactor")


# every one of these is a spelling of the plain letter: case, accents, marks of their own
ODD_LETTERS = ("a", "á", "À", "a\u0301", "Å"), ("e", "é", "È", "e\u0302", "ẽ"), ("o", "ô", "Ö", "o\u0308", "ø"), ("n", "ñ", "Ñ", "n\u0303", "Ń")


@register("silver_keys_any_accent", """SELECT lower(c.c_name) AS reactor_name, count(*) AS n
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id GROUP BY 1""")
def q_silver_keys_any_accent(spark, sf):
    """Names whose letters have any case and accent, also as marks of their own (SV1)."""
    r = fixtures.readings(spark, sf)
    odd = F.col("reactor_name")
    for plain, *spellings in ODD_LETTERS:
        to = reduce(lambda c, i: c.when(F.col("seq") % 5 == i, spellings[i]), range(1, len(spellings)),
                    F.when(F.col("seq") % 5 == 0, spellings[0])).otherwise(plain)
        odd = F.replace(odd, F.lit(plain), to)
    silver = layers.silver_readings(r.withColumn("reactor_name", odd), fold_keys=True)
    return silver.groupBy("reactor_name").agg(F.count("*").alias("n"))


@register("silver_keys_folded", """SELECT lower(c.c_name) AS reactor_name, count(*) AS n
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id GROUP BY 1""")
def q_silver_keys_folded(spark, sf):
    """Padded, upper-case, accented and blank names meet their plain form (SV1, IO5, U2)."""
    r = fixtures.readings(spark, sf)
    odd = F.concat(F.lit("  "), F.upper(F.translate("reactor_name", "aeo", "àéô")), F.lit(" "))
    odd = F.when(F.col("seq") % 2 == 0, odd).otherwise(F.col("reactor_name"))
    silver = layers.silver_readings(r.withColumn("reactor_name", F.coalesce(odd, F.lit("   "))), fold_keys=True)
    return silver.groupBy("reactor_name").agg(F.count("*").alias("n"))


@register("table_round_trip", O.sql(O.STAR, f"SELECT {O.FACT_COLUMNS} FROM fact"))
def q_table_round_trip(spark, sf):
    fact = _gold(spark, sf, "fact_availability")
    path = scratch_path(spark, "fact")
    database = "fact_" + path.rsplit("-", 1)[-1]
    scratch_database(spark, path, database)
    create_database(spark, database, f"{path}/db")
    name = f"{database}.fact"
    write_fact(fact, name, path=f"{path}/db/fact")
    return spark.sql(f"SELECT {', '.join(FACT_COLUMNS)} FROM {name}")   # SQL text over the catalog


@register("gold_from_csv", O.sql(O.STAR, f"SELECT {O.FACT_COLUMNS} FROM fact"))
def q_gold_from_csv(spark, sf):
    """Damaged CSV sources → bronze (repair) → silver → gold tables, then the gold fact read back."""
    root = scratch_path(spark, "layers")
    tag = root.rsplit("-", 1)[-1]
    settings = Settings(bronze_db=f"bronze_{tag}", silver_db=f"silver_{tag}", gold_db=f"gold_{tag}",
                        warehouse=f"{root}/tables")
    for name in (settings.bronze_db, settings.silver_db, settings.gold_db):
        scratch_database(spark, root, name)
    asset_csv, readings_csv = f"{root}/src/assets", f"{root}/src/readings"
    write_csv(fixtures.assets(spark, sf), asset_csv)
    write_csv(fixtures.readings(spark, sf).withColumn("value", induce_mojibake("value")), readings_csv)
    tables = layers.run_layers(spark, asset_csv, readings_csv, settings)
    return spark.table(tables["fact_availability"]).select(*FACT_COLUMNS)


@register("bronze_stream_ingest", O.sql([O.READINGS], """SELECT date_time, reactor_name, parameter, value, seq
FROM readings"""))
def q_bronze_stream_ingest(spark, sf):
    """Readings land as damaged CSV; the available-now stream parses and repairs them."""
    root = scratch_path(spark, "stream")
    landed = fixtures.readings(spark, sf).select(
        casts.format_timestamp("date_time").alias("date_time"), "reactor_name", "parameter",
        induce_mojibake("value").alias("value"), "seq")
    write_csv(landed, f"{root}/landing")
    ingest_available(spark, f"{root}/landing", READINGS_CSV, f"{root}/bronze", f"{root}/checkpoint",
                     timestamp_cols=("date_time",))
    return spark.read.parquet(f"{root}/bronze").drop("batch")


@register("file_inventory")
def q_file_inventory(spark, sf):
    return file_inventory(fixtures.table(spark, sf, "events"))


@register("file_inventory_by_type", """SELECT event_type, 1 AS n_files, count(*) AS n_rows, TRUE AS has_size,
  TRUE AS is_new FROM events GROUP BY event_type""")
def q_file_inventory_by_type(spark, sf):
    """Path, size, time and rows of several files: one is written for each event type."""
    path = scratch_path(spark, "inventory")
    events = fixtures.table(spark, sf, "events")
    began = F.lit(datetime.now(timezone.utc) - timedelta(minutes=1))
    events.repartition("event_type").write.partitionBy("event_type").parquet(path)
    files = file_inventory(spark.read.parquet(path))
    kind = F.regexp_extract("path", "event_type=([^/]+)/[^/]+$", 1)
    return (files.groupBy(kind.alias("event_type"))
            .agg(F.count("*").cast("int").alias("n_files"), F.sum("n_rows").alias("n_rows"),
                 F.bool_and(F.col("size") > 0).alias("has_size"),
                 F.bool_and(F.col("modification_time") > began).alias("is_new")))


@register("file_row_counts", "SELECT 'events.parquet' AS name, count(*) AS n_rows FROM events")
def q_file_row_counts(spark, sf):
    """The checkable part of the inventory: rows per source file (IO13)."""
    return file_inventory(fixtures.table(spark, sf, "events")).select("name", "n_rows")


# --- dashboard measures ----------------------------------------------------------


@register("kpi_reactor_count", O.sql(O.STAR, "SELECT count(DISTINCT reactor_id) AS n_reactors FROM fact"))
def q_kpi_reactor_count(spark, sf):
    return dashboard.measures(spark, gold(spark, sf))["kpi_reactor_count"]


_RATED = ("CAST(sum(CASE WHEN power_available IS NOT NULL AND rated_power IS NOT NULL THEN power_available END) AS BIGINT)",
          "CAST(sum(CASE WHEN power_available IS NOT NULL AND rated_power IS NOT NULL THEN rated_power END) AS BIGINT)")


@register("kpi_availability", O.sql(O.STAR_CAPACITY, f"""SELECT power_sum, rated_sum, n_readings, mean_ratio,
  CAST(power_sum AS DOUBLE) / NULLIF(CAST(rated_sum AS DOUBLE), 0) AS availability_rate,
  CAST(n_up AS DOUBLE) / NULLIF(CAST(n_readings AS DOUBLE), 0) AS uptime_share
FROM (SELECT {_RATED[0]} AS power_sum, {_RATED[1]} AS rated_sum,
             count(*) FILTER (WHERE NOT is_unavailable) AS n_up, count(*) AS n_readings,
             round(avg(CAST(power_available AS DOUBLE) / NULLIF(CAST(rated_power AS DOUBLE), 0)), 9) AS mean_ratio
      FROM fc)"""))
def q_kpi_availability(spark, sf):
    return dashboard.measures(spark, gold(spark, sf))["kpi_availability"]


@register("power_over_time", O.sql(O.STAR, """SELECT CAST(CAST(date_time AS DATE) AS TIMESTAMP) AS period,
  CAST(sum(power_available) AS BIGINT) AS total_power, count(*) AS n_readings FROM fact GROUP BY 1"""))
def q_power_over_time(spark, sf):
    return dashboard.measures(spark, gold(spark, sf))["power_over_time"]


@register("availability_over_time", O.sql(O.STAR_CAPACITY, f"""SELECT period,
  CAST(power_sum AS DOUBLE) / NULLIF(CAST(rated_sum AS DOUBLE), 0) AS availability_rate
FROM (SELECT CAST(CAST(date_time AS DATE) AS TIMESTAMP) AS period, {_RATED[0]} AS power_sum,
             {_RATED[1]} AS rated_sum FROM fc GROUP BY 1)"""))
def q_availability_over_time(spark, sf):
    return dashboard.measures(spark, gold(spark, sf))["availability_over_time"]


@register("downtime_by_year_type", O.sql(O.STAR_CAPACITY, """SELECT year, unavailability_type,
  CAST(sum(downtime_mw) AS BIGINT) AS downtime_mw, count(*) AS n_outages
FROM fc WHERE is_unavailable GROUP BY year, unavailability_type"""))
def q_downtime_by_year_type(spark, sf):
    return dashboard.measures(spark, gold(spark, sf))["downtime_by_year_type"]


@register("downtime_by_year_type_log", O.sql([O.OUTAGE_LOG], """SELECT CAST(year(date_time) AS INTEGER) AS year,
  outage_type, CAST(sum(mw) AS DOUBLE) AS total_mw, count(*) AS n_outages FROM log GROUP BY 1, 2"""))
def q_downtime_by_year_type_log(spark, sf):
    return analytics.downtime_by_year_type_log(fixtures.outage_log(spark, sf))


@register("outage_split", O.sql(O.STAR_CAPACITY, """SELECT unavailability_type, downtime_mw, n_outages,
  CAST(downtime_mw AS DOUBLE) / NULLIF(CAST(sum(downtime_mw) OVER () AS DOUBLE), 0) AS mw_share,
  CAST(n_outages AS DOUBLE) / NULLIF(CAST(sum(n_outages) OVER () AS DOUBLE), 0) AS count_share
FROM (SELECT unavailability_type, CAST(sum(downtime_mw) AS BIGINT) AS downtime_mw, count(*) AS n_outages
      FROM fc WHERE is_unavailable GROUP BY unavailability_type)"""))
def q_outage_split(spark, sf):
    return dashboard.measures(spark, gold(spark, sf))["outage_split"]


@register("top_plants_downtime", O.sql(O.STAR_CAPACITY, """SELECT plant, CAST(sum(downtime_mw) AS BIGINT) AS downtime_mw
FROM fc GROUP BY plant ORDER BY downtime_mw DESC, plant ASC NULLS LAST LIMIT 10"""))
def q_top_plants_downtime(spark, sf):
    return dashboard.measures(spark, gold(spark, sf))["top_plants_downtime"]


@register("plant_map", O.sql(O.STAR_CAPACITY, f"""SELECT plant, lat, lon, downtime_mw,
  CAST(power_sum AS DOUBLE) / NULLIF(CAST(rated_sum AS DOUBLE), 0) AS availability_rate
FROM (SELECT plant, lat, lon, CAST(sum(downtime_mw) AS BIGINT) AS downtime_mw,
             {_RATED[0]} AS power_sum, {_RATED[1]} AS rated_sum FROM fc GROUP BY plant, lat, lon)"""))
def q_plant_map(spark, sf):
    return dashboard.measures(spark, gold(spark, sf))["plant_map"]


@register("mw_over_time_month", O.sql([O.OUTAGE_LOG], """SELECT date_trunc('month', date_time) AS period,
  CAST(sum(mw) AS DOUBLE) AS total_mw, count(*) AS n_outages FROM log GROUP BY 1"""))
def q_mw_over_time_month(spark, sf):
    return analytics.mw_over_time(fixtures.outage_log(spark, sf), "month")


@register("seasonality", O.sql([O.OUTAGE_LOG], """SELECT month, n_outages, CAST(s AS DOUBLE) AS total_mw,
  CAST(s AS DOUBLE) / n_outages AS avg_mw
FROM (SELECT CAST(month(date_time) AS INTEGER) AS month, sum(mw) AS s, count(*) AS n_outages FROM log GROUP BY 1)"""))
def q_seasonality(spark, sf):
    return analytics.seasonality(fixtures.outage_log(spark, sf))


@register("yoy_change", O.sql([O.OUTAGE_LOG], """SELECT year, total_mw,
  lag(total_mw) OVER (ORDER BY year) AS prev_total_mw,
  (total_mw - lag(total_mw) OVER (ORDER BY year)) / NULLIF(lag(total_mw) OVER (ORDER BY year), 0) AS change_ratio
FROM (SELECT CAST(year(date_time) AS INTEGER) AS year, CAST(sum(mw) AS DOUBLE) AS total_mw FROM log GROUP BY 1)"""))
def q_yoy_change(spark, sf):
    return analytics.yoy_change(fixtures.outage_log(spark, sf))


@register("asset_slice", O.sql(O.STAR_CAPACITY, f"""SELECT {O.FACT_COLUMNS} FROM fact WHERE reactor_id = (
  SELECT reactor_id FROM fc WHERE reactor_id IS NOT NULL GROUP BY reactor_id
  ORDER BY sum(downtime_mw) DESC, reactor_id ASC LIMIT 1)"""))
def q_asset_slice(spark, sf):
    return dashboard.measures(spark, gold(spark, sf))["worst_asset_slice"].select(*FACT_COLUMNS)


@register("stored_asset_slice", ORACLES["asset_slice"])
def q_stored_asset_slice(spark, sf):
    """The same slice by a literal id: the stored fact's files and row groups are pruned."""
    settings = gold(spark, sf)
    worst = analytics.worst_asset(dashboard.fact_capacity(spark, settings))
    return analytics.asset_slice(spark.table(settings.table("gold", "fact_availability")), worst).select(*FACT_COLUMNS)


# the events span one month: each reactor's readings move by its own number of months
SHIFTED = """shifted AS (SELECT *, date_time + to_months(CAST(COALESCE(reactor_id, 0) % 48 AS INTEGER)) AS moved FROM fc)"""


def _moved(spark, sf) -> DataFrame:
    fc = dashboard.fact_capacity(spark, gold(spark, sf))
    months = F.coalesce(F.col("reactor_id"), F.lit(0)) % 48
    return fc.withColumn("date_time", F.add_months("date_time", months))


@register("availability_seasonality", O.sql([*O.STAR_CAPACITY, SHIFTED], f"""SELECT month, n_readings,
  CAST(power_sum AS DOUBLE) / NULLIF(CAST(rated_sum AS DOUBLE), 0) AS availability_rate
FROM (SELECT CAST(month(moved) AS INTEGER) AS month, count(*) AS n_readings, {_RATED[0]} AS power_sum,
             {_RATED[1]} AS rated_sum FROM shifted GROUP BY 1)"""))
def q_availability_seasonality(spark, sf):
    return analytics.availability_seasonality(_moved(spark, sf))


@register("availability_yoy", O.sql([*O.STAR_CAPACITY, SHIFTED], f"""SELECT year, availability_rate,
  lag(availability_rate) OVER (ORDER BY year) AS previous_rate,
  availability_rate - lag(availability_rate) OVER (ORDER BY year) AS change
FROM (SELECT CAST(year(moved) AS INTEGER) AS year,
             CAST({_RATED[0]} AS DOUBLE) / NULLIF(CAST({_RATED[1]} AS DOUBLE), 0) AS availability_rate
      FROM shifted GROUP BY 1)"""))
def q_availability_yoy(spark, sf):
    return analytics.availability_yoy(_moved(spark, sf))


__all__ = ["ORACLES", "QUERIES", "catalog_store", "entry_query"]


@register("time_hierarchy", O.sql([*O.STAR_CAPACITY, """spread AS (
  SELECT *, date_time + to_months(CAST(COALESCE(reactor_id, 0) % 30 AS INTEGER))
         + to_hours(CAST(COALESCE(reactor_id, 0) % 24 AS INTEGER)) AS moved FROM fc)"""], " UNION ALL ".join(f"""
SELECT '{g}' AS level, period, n_readings, total_power,
  CAST(power_sum AS DOUBLE) / NULLIF(CAST(rated_sum AS DOUBLE), 0) AS availability_rate
FROM (SELECT date_trunc('{g}', moved) AS period, count(*) AS n_readings, CAST(sum(power_available) AS BIGINT) AS total_power,
             {_RATED[0]} AS power_sum, {_RATED[1]} AS rated_sum FROM spread GROUP BY 1)""" for g in analytics.GRAINS)))
def q_time_hierarchy(spark, sf):
    """All grains of the time axis in one pass over the fact (BI3, BI4, BI9)."""
    fc = dashboard.fact_capacity(spark, gold(spark, sf))
    away = F.coalesce(F.col("reactor_id"), F.lit(0))
    moved = F.add_months("date_time", away % 30) + F.make_dt_interval(hours=away % 24)
    return analytics.time_hierarchy(fc.withColumn("date_time", moved))


@register("downtime_pivot", O.sql(O.STAR_CAPACITY, """SELECT year,
  CAST(sum(downtime_mw) FILTER (unavailability_type = 'planifiée') AS BIGINT) AS "planifiée",
  CAST(sum(downtime_mw) FILTER (unavailability_type = 'fortuite') AS BIGINT) AS fortuite,
  CAST(sum(downtime_mw) FILTER (unavailability_type NOT IN ('planifiée', 'fortuite')) AS BIGINT) AS other,
  CAST(sum(downtime_mw) AS BIGINT) AS total FROM fc WHERE is_unavailable GROUP BY year"""))
def q_downtime_pivot(spark, sf):
    return analytics.downtime_pivot(dashboard.fact_capacity(spark, gold(spark, sf)))


def stored_by_reactor(spark, sf) -> str:
    """The fact in the reference's layout, folders by year and reactor; the table's name."""
    path = scratch_path(spark, "by-reactor")
    database = "by_reactor_" + path.rsplit("-", 1)[-1]
    scratch_database(spark, path, database)
    create_database(spark, database, f"{path}/db")
    settings = Settings(fact_partitions=("year", "reactor_id"), fact_cluster_by=(), checksum_files=False)
    write_fact(_gold(spark, sf, "fact_availability"), f"{database}.fact", settings, path=f"{path}/db/fact")
    return f"{database}.fact"


PLANT_SLICED = 3


@register("plant_slice_by_reactor_folders", O.sql(O.STAR, f"""SELECT f.reactor_id, d.reactor, f.year, count(*) AS n_readings,
  CAST(sum(f.power_available) AS BIGINT) AS total_power, count(*) FILTER (f.is_unavailable) AS n_unavailable
FROM fact f JOIN dim_reactor d ON d.reactor_id = f.reactor_id WHERE d.plant_id = {PLANT_SLICED}
GROUP BY f.reactor_id, d.reactor, f.year"""))
def q_plant_slice_by_reactor_folders(spark, sf):
    """One plant's reactors in the (year, reactor_id) layout: only their folders are listed and read (IO7, BI11)."""
    stored, reactors = stored_by_reactor(spark, sf), _gold(spark, sf, "dim_reactor")
    folders = analytics.plant_folders(_gold(spark, sf, "fact_availability"), reactors, PLANT_SLICED)
    return analytics.plant_slice(read_folders(spark, stored, folders), reactors, PLANT_SLICED)


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the gold availability fact."""
    return q_fact_availability(spark, sf_dir)
