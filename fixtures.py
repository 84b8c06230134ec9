"""The logistics source tables as projections over the test tables.

Each text is plain SQL in the common subset of Spark SQL and DuckDB, with the
base tables as ``{placeholders}``; the same text serves both engines.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")

# Lookup given to dim_zone in place of the real city codes (one code is left out on purpose).
CITY_NAMES = {"AFRICA": "Africa", "AMERICA": "America", "ASIA": "Asia", "EUROPE": "Europe"}

VIEWS = {
    "zones": """
        SELECT concat('Z', n_nationkey) AS zone_id,
               n_name AS zone_name,
               r_name AS city_code,
               CASE WHEN n_nationkey % 7 = 3 THEN NULL ELSE concat('Sector ', n_nationkey) END AS district,
               CAST(n_nationkey AS DOUBLE) / 2 AS lat,
               -70 - CAST(n_nationkey AS DOUBLE) / 4 AS lon,
               1 + CAST(n_nationkey * 7 % 41 AS DOUBLE) / 10 AS traffic_level,
               CASE WHEN n_nationkey * 13 % 90 > 40 THEN 'Outer' ELSE 'Urban' END AS zone_type,
               CAST(n_nationkey * 13 % 90 AS DOUBLE) / 2 AS depot_km,
               CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS updated_at
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "drivers": """
        SELECT concat('D', s_suppkey) AS driver_id,
               s_name AS first_name,
               CASE WHEN s_suppkey % 17 = 4 THEN NULL ELSE concat('L', s_suppkey) END AS last_name,
               CASE WHEN s_suppkey % 25 = 0 THEN 'CE' ELSE 'CC' END AS doc_type,
               concat('H', s_suppkey) AS doc_hash,
               CAST(DATE '2016-01-01' + CAST(s_suppkey * 37 % 2000 AS INT) AS DATE) AS hire_date,
               concat('N', s_nationkey) AS base_city,
               CASE s_suppkey % 5 WHEN 0 THEN 'MOTO 125' WHEN 1 THEN 'Bici' WHEN 2 THEN 'Minivan'
                    WHEN 3 THEN 'Truck' END AS vehicle_type,
               concat('Z', CASE WHEN s_suppkey % 29 = 7 THEN 99 ELSE s_nationkey END) AS home_zone_id,
               s_suppkey % 16 <> 0 AS active,
               CASE WHEN s_suppkey % 20 = 5 THEN NULL ELSE 1 + CAST(s_suppkey % 41 AS DOUBLE) / 10 END AS rating_avg,
               CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS updated_at
        FROM {supplier}""",
    "shippers": """
        SELECT concat('C', c_custkey) AS shipper_id,
               c_name AS legal_name,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'ecommerce plus' WHEN 'BUILDING' THEN 'Farmacia'
                    WHEN 'FURNITURE' THEN 'RETAIL' WHEN 'MACHINERY' THEN 'telecom'
                    ELSE c_mktsegment END AS client_type,
               concat('N', c_nationkey) AS main_city,
               CAST(CASE c_custkey % 4 WHEN 0 THEN 8 WHEN 1 THEN 12 WHEN 2 THEN 24 ELSE 48 END AS INT) AS sla_hours,
               CAST(20 + c_custkey % 61 AS DOUBLE) / 1000 AS penalty_rate,
               c_custkey % 25 <> 0 AS active,
               CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS updated_at
        FROM {customer}""",
    "shipments": """
        SELECT concat('S', l_orderkey, '-', l_linenumber) AS shipment_id,
               CASE WHEN l_partkey % 97 = 11 THEN NULL ELSE concat('C', o_custkey) END AS shipper_id,
               concat('D', l_suppkey) AS driver_id,
               concat('Z', c_nationkey) AS zone_id,
               CASE WHEN l_quantity <= 5 THEN 'Document' WHEN l_quantity <= 20 THEN 'Small'
                    WHEN l_quantity <= 35 THEN 'Medium' ELSE 'Large' END AS package_type,
               CASE WHEN l_partkey % 200 = 0 THEN -l_quantity ELSE l_quantity END AS weight_kg,
               CAST(l_shipdate AS DATE) AS received_date,
               concat(lpad(CAST(6 + l_partkey % 15 AS STRING), 2, '0'), ':30:00') AS received_time,
               CASE WHEN l_partkey % 37 <> 5 THEN CAST(CAST(l_shipdate AS DATE)
                    + CAST(CASE WHEN l_partkey % 15 < 4 THEN 0 ELSE 1 END AS INT) AS DATE) END AS due_date,
               CAST(l_shipdate AS DATE) AS attempt1_date,
               concat(lpad(CAST(least(8 + l_partkey % 15 + l_suppkey % 8, 23) AS STRING), 2, '0'), ':45:00')
                   AS attempt1_time,
               CASE WHEN l_returnflag = 'A' THEN 'Entregado' ELSE 'Failed' END AS attempt1_result,
               CASE WHEN l_returnflag <> 'A' AND l_partkey % 3 > 0
                    THEN CAST(CAST(l_shipdate AS DATE) + CAST(1 + l_suppkey % 2 AS INT) AS DATE) END AS attempt2_date,
               CASE WHEN l_returnflag <> 'A' AND l_partkey % 3 > 0
                    THEN CASE WHEN l_suppkey % 4 = 1 THEN '02:15:00' ELSE '10:15:00' END END AS attempt2_time,
               CASE WHEN l_returnflag = 'N' AND l_partkey % 3 > 0 THEN 'Entregado'
                    WHEN l_returnflag <> 'A' THEN 'Failed' END AS attempt2_result,
               CASE WHEN l_returnflag = 'A'
                    THEN CAST(CAST(l_shipdate AS DATE)
                              + CAST(CASE WHEN l_partkey % 250 = 0 THEN -1 ELSE 0 END AS INT) AS DATE)
                    WHEN l_returnflag = 'N' AND l_partkey % 3 > 0
                    THEN CAST(CAST(l_shipdate AS DATE) + CAST(1 + l_suppkey % 2 AS INT) AS DATE) END AS delivered_date,
               CASE WHEN l_returnflag = 'A' OR (l_returnflag = 'N' AND l_partkey % 3 > 0)
                    THEN 'Entregado' ELSE 'Not_delivered' END AS final_status,
               CASE WHEN l_returnflag = 'A' OR (l_returnflag = 'N' AND l_partkey % 3 > 0) THEN NULL
                    WHEN l_suppkey % 3 = 0 THEN 'DEST_AUSENTE'
                    WHEN l_suppkey % 3 = 1 THEN 'DIR_INCORRECTA' ELSE 'UNKNOWN_CODE' END AS failure_code,
               CASE WHEN l_partkey % 20 = 3 THEN NULL ELSE l_extendedprice END AS declared_value,
               l_shipdate AS updated_at
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey""",
    "routes": """
        SELECT concat('T', l_orderkey, '-', l_linenumber) AS route_id,
               concat('D', l_suppkey) AS driver_id,
               CAST(l_shipdate AS DATE) AS route_date,
               concat(lpad(CAST(5 + l_partkey % 6 AS STRING), 2, '0'), ':00:00') AS start_time,
               CASE WHEN l_partkey % 41 = 2 THEN NULL
                    ELSE concat(lpad(CAST(least(4 + l_partkey % 6 + l_suppkey % 12, 23) AS STRING), 2, '0'), ':00:00')
                    END AS end_time,
               CASE WHEN l_partkey % 53 = 1 THEN CAST(0 AS DOUBLE) ELSE l_quantity * 3 END AS km,
               CAST(CASE WHEN l_partkey % 59 = 1 THEN 0 ELSE 10 + l_partkey % 45 END AS INT) AS stops_planned,
               CAST(10 + l_partkey % 40 AS INT) AS stops_done,
               l_discount * 100 AS deviation_km,
               CASE WHEN l_partkey % 20 = 7 THEN NULL ELSE l_quantity / 8 END AS fuel,
               l_shipdate AS updated_at
        FROM {lineitem}""",
    "ratings": """
        SELECT concat('R', o_orderkey) AS rating_id,
               concat('S', o_orderkey, '-1') AS shipment_id,
               CAST(o_orderdate AS DATE) AS rating_date,
               CAST(1 + o_custkey % 5 AS INT) AS score,
               CASE WHEN o_orderkey % 20 = 3 THEN NULL ELSE concat('comment ', o_orderpriority) END AS comment_text,
               CASE o_custkey % 4 WHEN 0 THEN 'App' WHEN 1 THEN 'SMS' WHEN 2 THEN 'Web' ELSE 'CallCenter' END AS channel,
               o_orderdate AS updated_at
        FROM {orders}""",
    "incidents": """
        SELECT concat('I', o_orderkey) AS incident_id,
               concat('S', o_orderkey, '-', 1 + o_custkey % 7) AS shipment_id,
               CAST(o_orderdate AS DATE) AS incident_date,
               CASE WHEN o_orderkey % 50 = 9 THEN NULL ELSE o_orderpriority END AS incident_type,
               concat('desc ', o_orderpriority) AS incident_text,
               concat('A', o_custkey % 500) AS agent_id,
               o_orderkey % 5 < 3 AS action_required,
               o_orderdate AS updated_at
        FROM {orders}""",
    # One log row per day and event type; the status and range columns give the
    # watermark queries failures and bounds to work on.
    "ingest_log": """
        SELECT CAST(CAST(ts AS DATE) AS STRING) AS batch_id,
               event_type AS table_name,
               min(ts) AS watermark_from,
               max(ts) AS watermark_to,
               count(*) AS records,
               CAST(sum(length(props)) AS BIGINT) AS bytes,
               round(sum(value), 2) AS seconds,
               CASE WHEN count(*) % 7 = 3 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               max(ts) AS logged_at
        FROM {events} GROUP BY CAST(ts AS DATE), event_type""",
}

SOURCE_TABLES = ("zones", "drivers", "shippers", "shipments", "routes", "ratings", "incidents")


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sources(spark: SparkSession, sf_dir: str, views: Iterable[str] = SOURCE_TABLES) -> dict[str, DataFrame]:
    """Fixture views as DataFrames; each base table is opened once."""
    used = {t for t in BASE_TABLES for view in views if "{" + t + "}" in VIEWS[view]}
    opened = {t: base_table(spark, sf_dir, t) for t in used}
    return {
        view: spark.sql(VIEWS[view], **{t: df for t, df in opened.items() if "{" + t + "}" in VIEWS[view]})
        for view in views
    }


def source(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    return sources(spark, sf_dir, [view])[view]


def view_sql(view: str) -> str:
    """The same text with plain table names, for the oracle."""
    return VIEWS[view].format(**{t: t for t in BASE_TABLES})
