"""The event timeline of each shipment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelflow.functions.rows import CHUNK, repeat_rows
from parcelflow.functions.timeparts import hours_between, instant, year_month


def shipment_events(fact: DataFrame) -> DataFrame:
    """Reception, attempts and delivery of each shipment: shipment_id, event_ts, event."""

    def event(label: str, ts: Column, present: Column) -> Column:
        return F.when(present, F.struct(ts.alias("event_ts"), F.lit(label).alias("event")))

    stages = F.array_compact(
        F.array(
            event("Reception", F.col("received_ts"), F.lit(True)),
            event("Attempt 1", instant("attempt1_date", "attempt1_time"), F.col("attempt1_date").isNotNull()),
            event("Attempt 2", instant("attempt2_date", "attempt2_time"), F.col("attempt2_date").isNotNull()),
            event("Delivery", F.col("delivery_ts"), F.col("delivery_ts").isNotNull()),
        )
    )
    return fact.select("shipment_id", F.inline(stages))


def incident_counts(incidents: DataFrame, fact: DataFrame) -> DataFrame:
    """Incidents on or after reception as events with the number of equal ones (``_n``).

    Two incidents of a shipment with the same day and type are the same event
    twice; counting them before the join keeps a shipment with very many
    incidents down to one row per day and type.
    """
    counted = incidents.groupBy("shipment_id", "incident_date", "incident_type").agg(F.count(F.lit(1)).alias("_n"))
    return (
        fact.select("shipment_id", "received_date")
        .join(counted, "shipment_id")
        .filter(F.col("incident_date") >= F.col("received_date"))
        .select(
            "shipment_id",
            F.col("incident_date").cast("timestamp").alias("event_ts"),
            F.concat(F.lit("Incident: "), F.col("incident_type")).alias("event"),
            "_n",
        )
    )


def incident_events(incidents: DataFrame, fact: DataFrame) -> DataFrame:
    """Incident events, one row per incident."""
    return repeat_rows(
        incident_counts(incidents, fact), "_n", "_copy", ["shipment_id", "event_ts", "event"]
    ).drop("_copy")


def timeline(events: DataFrame, key: str, ts: str, label: str, copies: str) -> DataFrame:
    """Number the events of each key by instant and label, with the instant of the one before.

    ``events`` holds distinct (key, instant, label) with their number of copies.
    Copies have equal sort values, so their numbers follow one another: the
    window runs over distinct events only, and the copies unfold afterwards: few of them
    where their event lies, many spread over the cluster.
    """
    order = Window.partitionBy(key).orderBy(F.col(ts).asc_nulls_first(), F.col(label).asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    places = {"_offset": F.coalesce(F.sum(copies).over(before), F.lit(0)), "_previous": F.lag(ts).over(order)}
    few = events.withColumns(places).filter(F.col(copies) <= CHUNK).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies))).drop(copies)
    # Only the keys with such events are placed again. They are fewer than one in CHUNK rows, so they are broadcast, and
    # joined before the window: behind it, Spark would move all events a second time while it looks for such keys.
    crowded = events.filter(F.col(copies) > CHUNK).select(key).distinct()
    again = events.join(F.broadcast(crowded), key, "left_semi")
    many = again.withColumns(places).filter(F.col(copies) > CHUNK)
    return few.unionByName(repeat_rows(many, copies, "_copy", [key, ts, label])).select(
        key,
        ts,
        label,
        (F.col("_offset") + F.col("_copy")).alias("event_order"),
        F.when(F.col("_copy") == 1, F.col("_previous")).otherwise(F.col(ts)).alias("previous_ts"),
    )


def fact_shipment_event(fact: DataFrame, incidents: DataFrame) -> DataFrame:
    events = shipment_events(fact).withColumn("_n", F.lit(1).cast("bigint")).unionByName(incident_counts(incidents, fact))
    return timeline(events, "shipment_id", "event_ts", "event", "_n").select(
        "*", hours_between("previous_ts", "event_ts").alias("hours_since_previous"), *year_month("event_ts", "event")
    )
