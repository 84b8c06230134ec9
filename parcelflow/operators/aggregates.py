"""Daily aggregates of the shipment fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.functions.numeric import exact_sum, share
from parcelflow.functions.timeparts import seconds_between
from parcelflow.model import DELIVERED


def _shipments() -> Column:
    return F.count(F.lit(1)).alias("shipments")


def _success_rate() -> Column:
    return share(f"final_status = '{DELIVERED}'").alias("success_rate")


def _sla_rate() -> Column:
    """Share of met SLAs among those that are known."""
    return F.avg(F.col("sla_met").cast("int")).alias("sla_rate")


def _mean_hours() -> Column:
    """Mean delivery time, from whole seconds so that the order of summing does not matter."""
    seconds = seconds_between("received_ts", "delivery_ts")
    return F.try_divide(F.sum(seconds), F.count(seconds) * 3600.0).alias("mean_delivery_hours")


def _penalty() -> Column:
    return exact_sum("estimated_penalty").alias("penalty_total")


def by_day(fact: DataFrame, *keys: str):
    return fact.groupBy(F.col("received_date").alias("day"), *keys)


def agg_zone_day(fact: DataFrame) -> DataFrame:
    return by_day(fact, "zone_id").agg(_shipments(), _sla_rate(), _success_rate(), _penalty())


def agg_shipper_day(fact: DataFrame) -> DataFrame:
    return by_day(fact, "shipper_id").agg(_shipments(), _sla_rate(), _success_rate(), _penalty())


def agg_package_day(fact: DataFrame) -> DataFrame:
    return by_day(fact, "package_type").agg(_shipments(), _success_rate(), _mean_hours(), _penalty())


def kpi_day(fact: DataFrame) -> DataFrame:
    return by_day(fact).agg(
        _shipments(),
        F.count_if(F.col("final_status") == DELIVERED).alias("delivered"),
        _success_rate(),
        _sla_rate(),
        _mean_hours(),
        _penalty(),
    )


def delay_class_counts(fact: DataFrame) -> DataFrame:
    return fact.groupBy("delay_class").agg(_shipments())
