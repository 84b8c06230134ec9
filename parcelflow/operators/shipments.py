"""The shipment fact: instants, SLA, delay and penalty of each delivery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.functions.joins import lookup
from parcelflow.functions.lookups import translate
from parcelflow.functions.timeparts import end_of_day, hours_between, instant, year_month
from parcelflow.model import DELIVERED, FAILURE_TEXTS

# Upper bounds in hours of the delay classes, mildest first.
DELAY_CLASSES = {"On time": 0, "Light delay": 4, "Moderate delay": 24}


def delivery_instant() -> Column:
    """Instant of the attempt that succeeded, the later one first; else the delivery date at 00:00."""
    at = F.when(F.col("attempt2_result") == DELIVERED, instant("attempt2_date", "attempt2_time"))
    at = at.when(F.col("attempt1_result") == DELIVERED, instant("attempt1_date", "attempt1_time"))
    return at.otherwise(F.col("delivered_date").cast("timestamp"))


def delay_class(status: str, delay_hours: str) -> Column:
    label = F.when(F.col(status) != DELIVERED, "Not delivered").when(F.col(delay_hours).isNull(), "Unknown")
    for name, hours in DELAY_CLASSES.items():
        label = label.when(F.col(delay_hours) <= hours, name)
    return label.otherwise("Critical delay")


def fact_shipment(shipments: DataFrame, shippers: DataFrame) -> DataFrame:
    """One row per shipment with SLA terms, instants, durations and estimated penalty."""
    terms = shippers.select("shipper_id", F.col("sla_hours").cast("double").alias("sla_hours"), "penalty_rate")
    instants = lookup(shipments, terms, "shipper_id").withColumns(
        {
            "received_ts": instant("received_date", "received_time"),
            "delivery_ts": delivery_instant(),
            "due_ts": end_of_day("due_date"),
        }
    )
    durations = instants.withColumns(
        {
            "delivery_hours": hours_between("received_ts", "delivery_ts"),
            "delay_hours": hours_between("due_ts", "delivery_ts"),
        }
    )
    sla_met = (F.col("final_status") == DELIVERED) & (F.col("delivery_hours") <= F.col("sla_hours"))
    # An unknown SLA result costs nothing.
    penalty = F.when(~F.col("sla_met"), F.col("declared_value") * F.col("penalty_rate")).otherwise(0.0)
    return durations.withColumn("sla_met", sla_met).select(
        *shipments.columns,
        "sla_hours",
        "penalty_rate",
        "received_ts",
        "delivery_ts",
        "due_ts",
        "delivery_hours",
        "sla_met",
        translate("failure_code", FAILURE_TEXTS).alias("failure_text"),
        F.when(F.col("attempt2_date").isNotNull(), 2).otherwise(1).alias("attempts"),
        "delay_hours",
        delay_class("final_status", "delay_hours").alias("delay_class"),
        penalty.alias("estimated_penalty"),
        *year_month("received_date", "received"),
    )
