"""The three dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.functions.lookups import classify, translate
from parcelflow.functions.numeric import half_up
from parcelflow.model import (
    CITY_NAMES,
    INDUSTRY_OTHER,
    INDUSTRY_SEGMENTS,
    VEHICLE_CLASSES,
    VEHICLE_OTHER,
)


def tenure_years(hired: str, as_of: date) -> Column:
    """Whole and part years between hiring and the given day, two decimals."""
    return half_up(F.months_between(F.lit(as_of), F.col(hired)) / 12, 2)


def dim_driver(drivers: DataFrame, as_of: date) -> DataFrame:
    return drivers.select(
        "driver_id",
        "first_name_hash",
        "last_name_hash",
        "doc_hash",
        "hire_date",
        tenure_years("hire_date", as_of).alias("tenure_years"),
        "base_city",
        classify("vehicle_type", VEHICLE_CLASSES, VEHICLE_OTHER).alias("vehicle_type"),
        "home_zone_id",
        "active",
        "rating_avg",
    )


def dim_shipper(shippers: DataFrame) -> DataFrame:
    return shippers.withColumns(
        {
            "industry_segment": classify("client_type", INDUSTRY_SEGMENTS, INDUSTRY_OTHER),
            "sla_hours": F.col("sla_hours").cast("double"),
        }
    )


def difficulty(traffic: str, depot_km: str) -> Column:
    """1 (easy) to 5: 60 % traffic level, 40 % depot distance up to 40 km (unknown counts as 40)."""
    traffic_share = (F.col(traffic) - 1) / 4
    distance_share = F.least(F.col(depot_km), F.lit(40.0)) / 40.0
    return F.round(1 + 4 * (0.6 * traffic_share + 0.4 * distance_share), 0).cast("int")


def dim_zone(zones: DataFrame, city_names: dict[str, str] = CITY_NAMES) -> DataFrame:
    return zones.withColumns(
        {"difficulty": difficulty("traffic_level", "depot_km"), "city_name": translate("city_code", city_names)}
    )
