from datetime import date, datetime

import pytest
from conftest import rows

from parcelflow.operators import alerts, dimensions, performance, routes, shipments, timeline
from parcelflow.plans import silver as cleaning
from test_cleaning import T0, raw, shipment, shipper, table_of, zone  # noqa: F401


@pytest.fixture
def fact(spark, raw):  # noqa: F811
    def build(*rows_, terms=None):
        silver = cleaning.silver(raw(list(rows_), shippers=terms or [shipper(1)]), "shipments", "shippers")
        return shipments.fact_shipment(silver["shipments"], silver["shippers"])

    return build


def test_instants_delay_and_penalty(fact):
    got = {
        r.shipment_id: r
        for r in fact(
            shipment(1),
            shipment(2, due_date=None),
            shipment(3, attempt1_result="Failed", attempt2_date="2024-01-14", attempt2_time="09:00:00",
                     attempt2_result="Entregado"),
            shipment(4, final_status="Not_delivered", attempt1_result="Failed", delivered_date=None,
                     failure_code="ZONA_DIFICIL"),
            shipment(5, attempt1_result=None, delivered_date="2024-01-12"),
            shipment(6, attempt1_time=None),
        ).collect()
    }
    assert got["S1"].delivery_hours == 2.0 and got["S1"].delay_class == "On time" and got["S1"].estimated_penalty == 0.0
    assert got["S2"].due_ts is None and got["S2"].delay_class == "Unknown"
    assert got["S3"].delivery_ts == datetime(2024, 1, 14, 9) and got["S3"].attempts == 2
    assert got["S3"].delay_class == "Critical delay" and got["S3"].estimated_penalty == 10.0
    assert got["S4"].delay_class == "Not delivered" and got["S4"].sla_met is False
    assert got["S4"].estimated_penalty == 10.0 and got["S4"].failure_text == "Zona de dificil acceso"
    assert got["S5"].delivery_ts == datetime(2024, 1, 12) and got["S5"].delay_class == "Light delay"
    # the time of the successful attempt is unknown: no instant, SLA unknown, no penalty
    assert got["S6"].delivery_ts is None and got["S6"].sla_met is None and got["S6"].estimated_penalty == 0.0


def test_a_missing_route_time_gives_no_speed(spark):
    route = table_of(
        spark,
        "routes",
        [
            ("T1", "D1", date(2024, 1, 1), "08:00:00", "10:00:00", 50.0, 10, 8, 5.0, 1.0, T0),
            ("T2", "D1", date(2024, 1, 1), "08:00:00", "07:00:00", 5.0, 0, 8, 5.0, 1.0, T0),
            ("T3", "D1", date(2024, 1, 1), "08:00:00", None, 0.0, 4, 8, 5.0, 1.0, T0),
        ],
    )
    got = routes.fact_route(route).select(
        "route_id", "worked_hours", "stop_efficiency", "mean_speed_kmh", "deviation_pct"
    )
    assert rows(got) == [("T1", 2.0, 0.8, 25.0, 10.0), ("T2", 0.1, None, 50.0, 100.0), ("T3", None, 2.0, None, None)]


def test_dimensions(spark):
    zones = table_of(spark, "zones", [zone(1), ("Z2", "far", "XXX", "d", 0.0, 0.0, 5.0, "Outer", None, T0)])
    got = dimensions.dim_zone(zones).select("zone_id", "difficulty", "city_name")
    assert rows(got) == [("Z1", 3, "Bogota"), ("Z2", 5, None)]
    hired = spark.createDataFrame([(date(2020, 1, 31),), (date(2024, 3, 1),)], "h date")
    assert rows(hired.select(dimensions.tenure_years("h", date(2024, 2, 29)).alias("y"))) == [(-0.01,), (4.08,)]


def test_days_without_routes_or_ratings_score_as_the_worst_case(fact, spark):
    days = performance.fact_driver_day(
        fact(shipment(1)),
        routes.fact_route(table_of(spark, "routes", [])),
        spark.createDataFrame([], "shipment_id string, score int"),
        spark.createDataFrame([], "zone_id string, difficulty int"),
    ).first()
    assert (days.mean_deviation_pct, days.mean_speed_kmh, days.mean_rating, days.difficulty) == (100.0, 0.0, 0.0, 3)
    assert days.score == 0.5


def test_reference_zone_is_that_of_the_earliest_shipment(raw):  # noqa: F811
    rows_ = [shipment(1, received_time="12:00:00"), shipment(2, received_time="07:00:00", zone_id="Z2")]
    silver = cleaning.silver(raw(rows_, zones=[zone(1), zone(2)]), "shipments", "shippers")
    day = performance.driver_day_shipments(shipments.fact_shipment(silver["shipments"], silver["shippers"])).first()
    assert day.reference_zone_id == "Z2"


def test_timeline_numbers_repeated_events(spark):
    ts = [datetime(2024, 1, d) for d in (1, 2, 3)]
    events = spark.createDataFrame(
        [("a", ts[0], "x", 1), ("a", ts[1], "y", 3), ("a", ts[2], "x", 1), ("a", None, "z", 1), ("b", ts[0], "x", 2)],
        "k string, at timestamp, what string, n bigint",
    )
    got = timeline.timeline(events, "k", "at", "what", "n")
    assert rows(got, "k", "event_order") == [
        ("a", None, "z", 1, None),
        ("a", ts[0], "x", 2, None),
        ("a", ts[1], "y", 3, ts[0]),
        ("a", ts[1], "y", 4, ts[1]),
        ("a", ts[1], "y", 5, ts[1]),
        ("a", ts[2], "x", 6, ts[1]),
        ("b", ts[0], "x", 1, None),
        ("b", ts[0], "x", 2, ts[0]),
    ]


def test_incidents_before_reception_are_left_out(fact, spark):
    incidents = spark.createDataFrame(
        [("I1", "S1", date(2024, 1, 9), "Late"), ("I2", "S1", date(2024, 1, 10), "Late"),
         ("I3", "S1", date(2024, 1, 10), None), ("I4", "S404", date(2024, 1, 10), "Late")],
        "incident_id string, shipment_id string, incident_date date, incident_type string",
    )
    got = timeline.fact_shipment_event(fact(shipment(1)), incidents)
    assert rows(got.select("event_order", "event"), "event_order") == [
        (1, None), (2, "Incident: Late"), (3, "Reception"), (4, "Attempt 1"), (5, "Delivery")
    ]


def test_a_first_failure_after_good_days_alerts(spark):
    days = [date(2024, 1, d) for d in (1, 8, 15, 22)]
    fact = spark.createDataFrame(
        [("Z1", d, "Entregado") for d in days[:3]] + [("Z1", days[3], "Not_delivered"), ("Z1", days[3], "Entregado")],
        "zone_id string, received_date date, final_status string",
    )
    alert = alerts.fact_zone_alert(fact).collect()
    assert [(a.day, a.failure_rate, a.baseline_rate, a.deviation_pct, a.weekday) for a in alert] == [
        (days[3], 0.5, 0.0, None, 2)
    ]


def test_few_and_many_copies_of_an_event_are_numbered_alike(spark, monkeypatch):
    monkeypatch.setattr(timeline, "CHUNK", 2)
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    events = spark.createDataFrame(
        [("S1", t1, "a", 2), ("S1", t2, "b", 5), ("S1", t2, "c", 1), ("S2", t1, "a", 1)], "k string, ts timestamp, label string, n bigint"
    )
    found = rows(timeline.timeline(events, "k", "ts", "label", "n").select("k", "label", "event_order"))
    assert found == sorted([("S1", "a", 1), ("S1", "a", 2), *[("S1", "b", i) for i in range(3, 8)], ("S1", "c", 8), ("S2", "a", 1)])
