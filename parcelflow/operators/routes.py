"""The route fact: hours, speed and deviation of each driven route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.functions.timeparts import hours_between, instant, year_month

SHORTEST_HOURS = 0.1


def _ratio(over: str, under: str) -> Column:
    """Quotient, null unless the divisor is positive."""
    return F.when(F.col(under) > 0, F.col(over) / F.col(under))


def fact_route(routes: DataFrame) -> DataFrame:
    """Known times give at least 0.1 hours; a missing time gives null hours and speed."""
    hours = hours_between(instant("route_date", "start_time"), instant("route_date", "end_time"))
    # greatest() skips nulls, so an unknown duration has to be kept apart from the floor
    floored = F.when(F.col("worked_hours").isNotNull(), F.greatest("worked_hours", F.lit(SHORTEST_HOURS)))
    return (
        routes.withColumn("worked_hours", hours)
        .withColumn("worked_hours", floored)
        .select(
            "*",
            _ratio("stops_done", "stops_planned").alias("stop_efficiency"),
            (F.col("km") / F.col("worked_hours")).alias("mean_speed_kmh"),
            (_ratio("deviation_km", "km") * 100).alias("deviation_pct"),
            *year_month("route_date", "route"),
        )
    )
