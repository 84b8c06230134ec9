"""From cleaned tables to the dimensional model, as lazy plans."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from parcelflow.model import CITY_NAMES
from parcelflow.operators.aggregates import agg_package_day, agg_shipper_day, agg_zone_day, kpi_day
from parcelflow.operators.alerts import fact_zone_alert
from parcelflow.operators.dimensions import dim_driver, dim_shipper, dim_zone
from parcelflow.operators.performance import fact_driver_day
from parcelflow.operators.routes import fact_route
from parcelflow.operators.shipments import fact_shipment
from parcelflow.operators.timeline import fact_shipment_event

DIMENSIONS = ("dim_driver", "dim_shipper", "dim_zone")
FACTS = ("fact_shipment", "fact_route", "fact_driver_day", "fact_shipment_event", "fact_zone_alert")
# Daily tables of the shipment fact alone.
AGGREGATES = {
    "agg_zone_day": agg_zone_day, "agg_shipper_day": agg_shipper_day, "agg_package_day": agg_package_day, "kpi_day": kpi_day,
}
# Tells which days of the shipment fact differ between versions.
DAY_SUMS = "fact_shipment_days"

# Layout columns of the large tables.
PARTITIONS = {
    "fact_shipment": ["received_year", "received_month"],
    "fact_route": ["route_year", "route_month"],
    "fact_driver_day": ["day_year", "day_month"],
    "fact_shipment_event": ["event_year", "event_month"],
    "fact_zone_alert": ["day_year", "day_month"],
}
# Tables whose rows grow with the shipments and routes; that which shuffles most comes first.
LARGE = ("fact_shipment", "fact_route", "fact_shipment_event", "fact_driver_day")


def base_tables(
    silver: dict[str, DataFrame], as_of: date, city_names: dict[str, str] = CITY_NAMES
) -> dict[str, DataFrame]:
    """The tables that come straight from the cleaned ones."""
    return {
        "dim_driver": dim_driver(silver["drivers"], as_of),
        "dim_shipper": dim_shipper(silver["shippers"]),
        "dim_zone": dim_zone(silver["zones"], city_names),
        "fact_shipment": fact_shipment(silver["shipments"], silver["shippers"]),
        "fact_route": fact_route(silver["routes"]),
    }


def derived_tables(silver: dict[str, DataFrame], base: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables built on the facts; give them the written facts to read, not their plans."""
    fact = base["fact_shipment"]
    return {
        "fact_driver_day": fact_driver_day(fact, base["fact_route"], silver["ratings"], base["dim_zone"]),
        "fact_shipment_event": fact_shipment_event(fact, silver["incidents"]),
        "fact_zone_alert": fact_zone_alert(fact),
        **{table: build(fact) for table, build in AGGREGATES.items()},
    }


def gold(silver: dict[str, DataFrame], as_of: date, city_names: dict[str, str] = CITY_NAMES) -> dict[str, DataFrame]:
    base = base_tables(silver, as_of, city_names)
    return base | derived_tables(silver, base)
