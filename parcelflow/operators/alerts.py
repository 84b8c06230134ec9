"""Zone-days whose failure rate stands out against the same weekday before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from parcelflow.functions.numeric import share
from parcelflow.functions.timeparts import year_month
from parcelflow.model import DELIVERED

BASELINE_DAYS = 4
ALERT_FACTOR = 1.25


def zone_day_failure(fact: DataFrame) -> DataFrame:
    """Failure rate per zone and reception day, with the weekday (1 = Sunday)."""
    return (
        fact.groupBy("zone_id", F.col("received_date").alias("day"))
        .agg(share(f"final_status <> '{DELIVERED}'").alias("failure_rate"))
        .withColumn("weekday", F.dayofweek("day"))
    )


def zone_baseline(days: DataFrame) -> DataFrame:
    """Add the mean of up to four earlier observations of the same zone and weekday, and the deviation from it."""
    earlier = Window.partitionBy("zone_id", "weekday").orderBy("day").rowsBetween(-BASELINE_DAYS, -1)
    rate, base = F.col("failure_rate"), F.col("baseline_rate")
    return days.withColumn("baseline_rate", F.avg("failure_rate").over(earlier)).withColumn(
        "deviation_pct", F.when(base > 0, (rate - base) / base * 100)
    )


def recent_days(days: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """zone_id, weekday and their newest observations (day, failure_rate), as many as a baseline takes.

    ``before`` is such a table of earlier days: with it, a small table carries the history from batch to batch.
    """
    seen = days.select("zone_id", "weekday", "day", "failure_rate")
    if before is not None:
        seen = seen.unionByName(observations(before))
    newest = Window.partitionBy("zone_id", "weekday").orderBy(F.desc("day"))
    kept = seen.withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") <= BASELINE_DAYS)
    return kept.groupBy("zone_id", "weekday").agg(F.sort_array(F.collect_list(F.struct("day", "failure_rate"))).alias("recent"))


def observations(recent: DataFrame) -> DataFrame:
    return recent.select("zone_id", "weekday", F.inline("recent"))


def carried_baseline(days: DataFrame, recent: DataFrame) -> DataFrame:
    """As ``zone_baseline``, for days later than those of ``recent`` and without the days behind these."""
    earlier = observations(recent).withColumn("_new", F.lit(False))
    both = days.withColumn("_new", F.lit(True)).unionByName(earlier)
    return zone_baseline(both).filter("_new").drop("_new")


def fact_zone_alert(fact: DataFrame) -> DataFrame:
    """Alerting zone-days; with a baseline of zero any failure alerts."""
    return (
        zone_baseline(zone_day_failure(fact))
        .filter(F.col("failure_rate") > F.col("baseline_rate") * ALERT_FACTOR)
        .select("*", *year_month("day", "day"))
    )
