"""DuckDB SQL oracles for the registered queries.

Each oracle re-derives its answer from the driver's base tables with plain SQL
(window ``row_number`` for keys, ``arg_max … FILTER`` for the pivot, joins for
lookups), independently of the Spark code path.  Shared pieces are common
table expressions composed by ``sql``.

Hash hygiene: integer sums are cast to BIGINT (DuckDB sums to HUGEINT), ids to
INTEGER; ratios divide exact integer or decimal sums once, so both engines
produce the same double.
"""

from __future__ import annotations

# --- fixture views -------------------------------------------

ASSETS = """assets AS (
  SELECT c.c_name AS reactor, n.n_name AS plant,
         CAST(n.n_regionkey * 10.0 AS DOUBLE) AS lat,
         CAST(n.n_nationkey * 1.0 AS DOUBLE) AS lon,
         CAST(DATE '1977-01-01' + CAST(c.c_custkey % 3650 AS INTEGER) AS DATE) AS grid_connection,
         p.p_brand AS model, p.p_size AS rated_power,
         c.c_mktsegment AS cooling, p.p_type AS cooling_source
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN part p ON p.p_partkey = c.c_custkey)"""

ASSETS_VARIANTS = """assets AS (
  SELECT c.c_name AS reactor, n.n_name AS plant,
         CASE WHEN n.n_nationkey IN (0, 1) AND c.c_mktsegment = 'BUILDING'
              THEN CAST(n.n_regionkey * 10.0 AS DOUBLE) + 0.5
              ELSE CAST(n.n_regionkey * 10.0 AS DOUBLE) END AS lat,
         CAST(n.n_nationkey * 1.0 AS DOUBLE) AS lon,
         CAST(DATE '1977-01-01' + CAST(c.c_custkey % 3650 AS INTEGER) AS DATE) AS grid_connection,
         p.p_brand AS model, p.p_size AS rated_power,
         c.c_mktsegment AS cooling, p.p_type AS cooling_source
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN part p ON p.p_partkey = c.c_custkey)"""

READINGS = """readings AS (
  SELECT CAST(CAST(e.ts AS DATE) AS TIMESTAMP) AS date_time,
         c.c_name AS reactor_name,
         CASE e.event_type WHEN 'view' THEN 'power_available' WHEN 'click' THEN 'derating'
              WHEN 'error' THEN 'unavailability_type' WHEN 'purchase' THEN 'unavailability_cause'
              WHEN 'signup' THEN 'additional_info' END AS parameter,
         CASE WHEN e.event_type = 'view'
                THEN CASE WHEN e.value < 10 THEN '0' ELSE CAST(e.value AS VARCHAR) END
              WHEN e.event_type = 'click'
                THEN CASE WHEN e.value < 5 THEN '0' ELSE CAST(e.value AS VARCHAR) END
              WHEN e.event_type = 'error'
                THEN CASE WHEN e.event_id % 10 = 0 THEN 'fortuite' ELSE 'planifiée' END
              ELSE e.props END AS value,
         e.event_id AS seq
  FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id)"""

WIDE = """wide AS (
  SELECT date_time, reactor_name,
         arg_max(value, seq) FILTER (WHERE parameter = 'power_available') AS power_available,
         arg_max(value, seq) FILTER (WHERE parameter = 'derating') AS derating,
         arg_max(value, seq) FILTER (WHERE parameter = 'unavailability_type') AS unavailability_type,
         arg_max(value, seq) FILTER (WHERE parameter = 'unavailability_cause') AS unavailability_cause,
         arg_max(value, seq) FILTER (WHERE parameter = 'additional_info') AS additional_info
  FROM readings GROUP BY date_time, reactor_name
  HAVING count(*) FILTER (WHERE parameter = 'power_available') > 0)"""

CELLS = """cells AS (
  SELECT date_time, reactor_name, parameter, arg_max(value, seq) AS value, count(*) AS n_readings
  FROM readings GROUP BY date_time, reactor_name, parameter)"""

WIDE_JOIN_FORM = """wide AS (
  SELECT p.date_time, p.reactor_name, p.value AS power_available, d.value AS derating,
         t.value AS unavailability_type, c.value AS unavailability_cause, i.value AS additional_info
  FROM (SELECT * FROM cells WHERE parameter = 'power_available') p
  LEFT JOIN (SELECT * FROM cells WHERE parameter = 'derating') d
    ON d.date_time = p.date_time AND d.reactor_name = p.reactor_name
  LEFT JOIN (SELECT * FROM cells WHERE parameter = 'unavailability_type') t
    ON t.date_time = p.date_time AND t.reactor_name = p.reactor_name
  LEFT JOIN (SELECT * FROM cells WHERE parameter = 'unavailability_cause') c
    ON c.date_time = p.date_time AND c.reactor_name = p.reactor_name
  LEFT JOIN (SELECT * FROM cells WHERE parameter = 'additional_info') i
    ON i.date_time = p.date_time AND i.reactor_name = p.reactor_name)"""


def to_int(expr: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST(NULLIF(trim({expr}), '') AS DOUBLE)) AS INTEGER)"


TYPED = f"""typed AS (
  SELECT reactor_name, date_time,
         {to_int('power_available')} AS power_available,
         {to_int('derating')} AS derating_parsed,
         unavailability_type, unavailability_cause, additional_info
  FROM wide)"""

# --- dimensions (default mode: D1-D3) --------------------------------------

DIM_PLANT = """plant_one AS (
  SELECT plant, lat, lon FROM (
    SELECT plant, lat, lon, row_number() OVER (PARTITION BY plant ORDER BY lat NULLS LAST, lon NULLS LAST) AS rn
    FROM assets) WHERE rn = 1),
dim_plant AS (
  SELECT plant, lat, lon,
         CAST(row_number() OVER (ORDER BY plant NULLS LAST, lat NULLS LAST, lon NULLS LAST) AS INTEGER) AS plant_id
  FROM plant_one)"""

DIM_REACTOR = """reactor_one AS (
  SELECT reactor, plant, grid_connection FROM (
    SELECT reactor, plant, grid_connection,
           row_number() OVER (PARTITION BY reactor ORDER BY plant NULLS LAST, grid_connection NULLS LAST) AS rn
    FROM assets) WHERE rn = 1),
dim_reactor AS (
  SELECT CAST(row_number() OVER (ORDER BY r.reactor NULLS LAST, p.plant_id NULLS LAST,
                                          r.grid_connection NULLS LAST) AS INTEGER) AS reactor_id,
         r.reactor, p.plant_id, r.grid_connection
  FROM reactor_one r LEFT JOIN dim_plant p ON r.plant IS NOT DISTINCT FROM p.plant)"""

DIM_MODEL = """dim_model AS (
  SELECT CAST(row_number() OVER (ORDER BY model NULLS LAST, rated_power NULLS LAST) AS INTEGER) AS model_id,
         model, rated_power
  FROM (SELECT DISTINCT model, rated_power FROM assets))"""

DIM_COOLING = """dim_cooling AS (
  SELECT CAST(row_number() OVER (ORDER BY cooling NULLS LAST, cooling_source NULLS LAST) AS INTEGER) AS cooling_id,
         cooling, cooling_source
  FROM (SELECT DISTINCT cooling, cooling_source FROM assets))"""

BRIDGE = """bridge_one AS (
  SELECT reactor, model, rated_power, cooling, cooling_source FROM (
    SELECT *, row_number() OVER (PARTITION BY reactor ORDER BY model NULLS LAST, rated_power NULLS LAST,
                                 cooling NULLS LAST, cooling_source NULLS LAST) AS rn
    FROM (SELECT reactor, model, rated_power, cooling, cooling_source FROM assets)) WHERE rn = 1),
bridge AS (
  SELECT r.reactor_id, m.model_id, c.cooling_id
  FROM bridge_one b
  LEFT JOIN dim_reactor r ON b.reactor IS NOT DISTINCT FROM r.reactor
  LEFT JOIN dim_model m ON b.model IS NOT DISTINCT FROM m.model AND b.rated_power IS NOT DISTINCT FROM m.rated_power
  LEFT JOIN dim_cooling c ON b.cooling IS NOT DISTINCT FROM c.cooling
                         AND b.cooling_source IS NOT DISTINCT FROM c.cooling_source)"""

# compat (reference shape): row-distinct dimensions joined on a partial key
DIM_PLANT_COMPAT = """dim_plant AS (
  SELECT plant, lat, lon,
         CAST(row_number() OVER (ORDER BY plant NULLS LAST, lat NULLS LAST, lon NULLS LAST) AS INTEGER) AS plant_id
  FROM (SELECT DISTINCT plant, lat, lon FROM assets))"""

DIM_REACTOR_COMPAT = """reactor_one AS (
  SELECT reactor, plant, grid_connection FROM (
    SELECT reactor, plant, grid_connection,
           row_number() OVER (PARTITION BY reactor ORDER BY plant NULLS LAST, grid_connection NULLS LAST) AS rn
    FROM assets) WHERE rn = 1),
numbered AS (
  SELECT CAST(row_number() OVER (ORDER BY r.reactor NULLS LAST, p.plant_id NULLS LAST,
                                          r.grid_connection NULLS LAST) AS INTEGER) AS reactor_id,
         r.reactor, p.plant_id, r.grid_connection
  FROM reactor_one r LEFT JOIN dim_plant p ON r.plant = p.plant),
dim_reactor AS (
  SELECT reactor_id, reactor, plant_id, grid_connection FROM (
    SELECT *, row_number() OVER (PARTITION BY reactor ORDER BY reactor_id) AS rn FROM numbered) WHERE rn = 1)"""

BRIDGE_COMPAT = """bridge_one AS (
  SELECT reactor, model, cooling FROM (
    SELECT *, row_number() OVER (PARTITION BY reactor ORDER BY model NULLS LAST, cooling NULLS LAST) AS rn
    FROM (SELECT reactor, model, cooling FROM assets)) WHERE rn = 1),
bridge AS (
  SELECT r.reactor_id, m.model_id, c.cooling_id
  FROM bridge_one b
  LEFT JOIN dim_reactor r ON b.reactor = r.reactor
  LEFT JOIN dim_model m ON b.model = m.model
  LEFT JOIN dim_cooling c ON b.cooling = c.cooling)"""

# --- fact --------------------------------------------------------------------

FACT = """fact AS (
  SELECT t.reactor_name, t.date_time, t.power_available,
         COALESCE(t.derating_parsed, 0) AS derating,
         t.unavailability_type, t.unavailability_cause, t.additional_info,
         CAST(strftime(t.date_time, '%Y%m%d%H%M') AS BIGINT) AS date_key,
         CAST(year(t.date_time) AS INTEGER) AS year,
         d.reactor_id,
         COALESCE(t.power_available = 0 AND t.unavailability_type IS NOT NULL, FALSE) AS is_unavailable,
         CASE WHEN t.power_available = 0 AND t.unavailability_type IS NULL THEN TRUE
              WHEN t.power_available > 0 AND COALESCE(t.derating_parsed, 0) > 0 THEN TRUE
              ELSE FALSE END AS is_derated
  FROM typed t LEFT JOIN dim_reactor d ON d.reactor IS NOT DISTINCT FROM t.reactor_name)"""

FACT_CAPACITY = """capacity AS (
  SELECT r.reactor_id, m.rated_power, p.plant_id, p.plant, p.lat, p.lon
  FROM dim_reactor r
  LEFT JOIN bridge b ON b.reactor_id = r.reactor_id
  LEFT JOIN dim_model m ON m.model_id = b.model_id
  LEFT JOIN dim_plant p ON p.plant_id = r.plant_id),
fc AS (
  SELECT f.*, c.rated_power, c.plant_id, c.plant, c.lat, c.lon,
         CASE WHEN f.is_unavailable THEN greatest(c.rated_power - f.power_available, 0) ELSE 0 END AS downtime_mw
  FROM fact f LEFT JOIN capacity c ON c.reactor_id = f.reactor_id)"""

FACT_COLUMNS = ("reactor_name, date_time, power_available, derating, unavailability_type, "
                "unavailability_cause, additional_info, date_key, year, reactor_id, is_unavailable, is_derated")

STAR = [ASSETS, READINGS, WIDE, TYPED, DIM_PLANT, DIM_REACTOR, FACT]
STAR_CAPACITY = [ASSETS, READINGS, WIDE, TYPED, DIM_PLANT, DIM_REACTOR, DIM_MODEL, DIM_COOLING,
                 BRIDGE, FACT, FACT_CAPACITY]

# --- other fixtures ----------------------------------------------------------

OUTAGE_LOG = """log AS (
  SELECT o_orderdate AS date_time, o_orderpriority AS outage_type,
         CAST(o_totalprice AS DECIMAL(18,2)) AS mw
  FROM orders)"""


def induce(col: str) -> str:
    """UTF-8 bytes re-read as ISO-8859-1, one character per byte."""
    return (f"array_to_string(list_transform(regexp_extract_all(hex(encode({col})), '..'), "
            f"lambda h: chr(CAST('0x' || h AS INTEGER))), '')")


DAMAGED = f"""damaged AS (
  SELECT doc_id, {induce('text')} AS text, {induce('lang')} AS lang,
         {induce('source')} AS source, n_chars
  FROM documents)"""

RESIDUAL_REGEX = r"\x{C3}[\x{80}-\x{BF}]|\x{E2}\x{20AC}|\x{FFFD}"


def sql(ctes, select: str) -> str:
    ctes = list(ctes)
    if not ctes:
        return select
    return "WITH " + ",\n".join(ctes) + "\n" + select
