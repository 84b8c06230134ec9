"""Plans in written steps: the rows of one plan, and fewer of its shuffles at a time."""

from datetime import date, datetime

import __spark_entry__ as entry
from conftest import rows

from parcelflow.plans import silver as cleaning
from parcelflow.plans.together import SHUFFLE_CLEANUP
from test_cleaning import T0, raw, shipment  # noqa: F401

LATER = datetime(2024, 2, 1)


def route(i, driver_id="D1", km=30.0):
    return (f"T{i}", driver_id, date(2024, 1, 10), "06:00:00", "09:00:00", km, 10, 9, 1.5, None, T0)


def rating(i, of, score=4):
    return (f"R{i}", of, date(2024, 1, 12), score, None, "App", T0)


def tables(raw):  # noqa: F811
    shipments = [
        shipment(1), shipment(2), shipment(2, weight_kg=3.0, updated_at=LATER), shipment(3, weight_kg=-1.0), shipment(4, shipper_id="C9"),
        shipment(5, driver_id="D2"), shipment(6, driver_id=None), shipment(7, shipment_id=None), shipment(8, received_date="soon"),
        shipment(9, final_status="Failed", attempt1_result="Failed", delivered_date=None),
    ]
    routes = [route(1), route(1), route(2, km=12.0), route(3, "D9"), route(4, None)]
    ratings = [rating(1, "S1"), rating(2, "S2", 2), rating(3, "S3"), rating(4, "S4"), rating(5, "S1", None), rating(6, None)]
    return raw(shipments, routes=routes, ratings=ratings)


def test_cleaned_rows_are_those_of_one_plan(spark, raw):  # noqa: F811
    source = tables(raw)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    names = ("shipments", "routes", "ratings", "drivers")
    one, steps = cleaning.silver(source, *names), cleaning.silver_in_steps(source, *names)
    assert set(steps) == set(names) and spark.conf.get(SHUFFLE_CLEANUP, None) == before
    for table in names:
        assert steps[table].dtypes == one[table].dtypes and rows(steps[table]) == rows(one[table])
    # a rating of a shipment that broke a business rule stays, that of one without shipper goes
    assert [r[0] for r in steps["ratings"].select("rating_id").orderBy("rating_id").collect()] == ["R1", "R2", "R3"]


def test_driver_days_start_from_written_rows(spark, raw, monkeypatch):  # noqa: F811
    """The plan of the result reads written facts, so it holds no shuffle of raw rows."""
    monkeypatch.setattr(entry, "_raw", lambda *_: tables(raw))
    days = entry.fact_driver_day(spark, "")
    folders = {f.rsplit("/", 2)[-2].split("-")[0] for f in days.inputFiles()}
    assert folders == {"fact", "closed"}
    text = days._jdf.queryExecution().executedPlan().toString()
    assert "_lacks" not in text and "_copies" not in text
    assert rows(days.select("driver_id", "day", "success_rate", "mean_rating")) == [("D1", date(2024, 1, 10), 2 / 3, 3.0)]


def test_worst_drivers_start_from_written_rows(spark, raw, monkeypatch):  # noqa: F811
    monkeypatch.setattr(entry, "_raw", lambda *_: tables(raw))
    worst = entry.queries()["sql_driver_worst"](spark, "")
    assert {f.rsplit("/", 2)[-2].split("-")[0] for f in worst.inputFiles()} >= {"fact", "closed"}
