"""Analyst SQL on the dimensional model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelflow.functions.numeric import UNIT, exact_sum_sql, head_sql, rest_sql

QUERIES = {
    "sql_kpi_latest": """
        SELECT * FROM kpi_day ORDER BY day DESC LIMIT 5""",
    "sql_zone_rank": """
        WITH per_zone AS (
            SELECT zone_id, count(*) AS shipments, avg(CAST(sla_met AS INT)) AS sla_rate
            FROM fact_shipment GROUP BY zone_id)
        SELECT z.city_code, z.city_name, z.zone_id, z.zone_name, p.shipments, p.sla_rate,
               rank() OVER (PARTITION BY z.city_code ORDER BY p.sla_rate DESC NULLS LAST) AS zone_rank
        FROM per_zone p JOIN dim_zone z ON p.zone_id = z.zone_id""",
    # Penalties are summed per shipper before the join: it then moves one row per shipper and package type.
    "sql_penalty_rollup": f"""
        WITH per_shipper AS (
            SELECT shipper_id, package_type, count(*) AS shipments,
                   sum({head_sql("estimated_penalty")}) AS penalty, sum({rest_sql("estimated_penalty")}) AS penalty_rest
            FROM fact_shipment GROUP BY shipper_id, package_type)
        SELECT s.industry_segment, f.package_type,
               CAST(grouping(s.industry_segment) AS INT) AS all_segments,
               CAST(grouping(f.package_type) AS INT) AS all_packages,
               CAST(sum(f.shipments) AS BIGINT) AS shipments,
               CAST(sum(f.penalty) AS DOUBLE) + CAST(sum(f.penalty_rest) AS DOUBLE) / {UNIT!r}D AS penalty_total
        FROM per_shipper f JOIN dim_shipper s ON f.shipper_id = s.shipper_id
        GROUP BY ROLLUP (s.industry_segment, f.package_type)""",
    # The window without partition sees one row per day.
    "sql_kpi_moving": """
        SELECT day, shipments, success_rate,
               sum(delivered) OVER week / CAST(sum(shipments) OVER week AS DOUBLE) AS success_rate_7d
        FROM kpi_day
        WINDOW week AS (ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
    "sql_driver_worst": f"""
        WITH per_month AS (
            SELECT day_year, day_month, driver_id, count(*) AS days,
                   {exact_sum_sql("score")} / count(*) AS mean_score
            FROM fact_driver_day GROUP BY day_year, day_month, driver_id),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY day_year, day_month
                                         ORDER BY mean_score, driver_id) AS place
            FROM per_month)
        SELECT r.day_year, r.day_month, r.place, r.driver_id, d.vehicle_type, r.days, r.mean_score
        FROM ranked r JOIN dim_driver d ON r.driver_id = d.driver_id
        WHERE r.place <= 10""",
}


def publish(tables: dict[str, DataFrame]) -> None:
    """Make tables available to spark.sql under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def ask(spark: SparkSession, query: str) -> DataFrame:
    return spark.sql(QUERIES[query])
