"""Whole runs in a temporary folder."""

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelflow.operators import gate
from parcelflow.plans import pipeline
from parcelflow.sources import layers
from test_cleaning import raw, shipment, table_of  # noqa: F401

AS_OF = date(2024, 6, 15)


@pytest.fixture
def sources(raw):  # noqa: F811
    d = datetime(2024, 1, 11)
    return raw(
        [shipment(i) for i in range(1, 8)] + [shipment(7), shipment(8, weight_kg=-2.0), shipment(9, driver_id="D2")],
        routes=[("T1", "D1", date(2024, 1, 10), "08:00:00", "12:00:00", 80.0, 10, 9, 4.0, None, d)],
        ratings=[("R1", "S1", date(2024, 1, 11), 5, "thanks", "App", d), ("R2", "S8", date(2024, 1, 11), 1, None, "App", d)],
        incidents=[("I1", "S1", date(2024, 1, 10), "Late", "text", "A1", True, d)] * 2,
    )


def contents(run):
    """Every table of a run without its instants."""
    found = {**pipeline.read_silver(run), **pipeline.read_gold(run)}
    for name in ("quarantine", "quality_report", "dq_results", "run_summary", "ingest_log", "ingest_audit"):
        found[name] = layers.read_history(run.spark, run.history(name))
    volatile = {
        "_ingest_ts", "noted_at", "generated_at", "run_at", "finished_at", "summary", "summary_line", "duration_seconds",
        "logged_at", "seconds", "bytes", "ingested_at",
    }
    return {t: rows(df.select(*[c for c in df.columns if c not in volatile])) for t, df in found.items()}


def test_run_is_repeatable_and_incremental(spark, tmp_path, sources):
    run = pipeline.Run(spark, str(tmp_path), "b1", AS_OF, started_at="2024-01-01T00:00:00Z")
    line = pipeline.run(run, sources)
    assert line.startswith("DAILY_SUMMARY | batch_id=b1 | silver=14 | gold=")
    assert "rejected=5 | quality_alerts=0" in line
    first = contents(run)
    # 2 copies of S7 and 2 of I1, one weight, one driver without zone, its shipment
    assert sorted(r[4] for r in first["quarantine"]) == sorted(
        ["DUPLICATE_KEY"] * 4 + ["WEIGHT_NOT_POSITIVE", "FK_INVALID_home_zone_id", "FK_INVALID_driver_id"]
    )

    pipeline.run(run, sources)
    assert contents(run) == first

    # next day one shipment changed: only it is copied, and it replaces its older version
    changed = table_of(
        spark, "shipments", [shipment(1, package_type="Huge", updated_at=datetime(2024, 1, 20))], dates_as_text=True
    )
    later = dict(sources, shipments=sources["shipments"].unionByName(changed))
    second = pipeline.Run(spark, str(tmp_path), "b2", AS_OF)
    with pytest.raises(pipeline.VolumeAlert, match="shipments:90.00%"):
        pipeline.run(second, later)
    log = layers.read_batch(spark, second.history("ingest_log"), "b2").filter("table_name = 'shipments'").first()
    assert (log.records, log.status, log.watermark_to) == (1, "SUCCESS", datetime(2024, 1, 20))
    silver = pipeline.build_silver(second)
    assert silver["shipments"].filter("shipment_id = 'S1'").first().package_type == "Huge"
    control = layers.read_batch(spark, second.history("watermarks"), "b2")
    assert control.filter("table_name = 'shipments'").first().watermark == datetime(2024, 1, 20)


def test_forced_alert_stops_before_cleaning(spark, tmp_path, sources):
    run = pipeline.Run(spark, str(tmp_path), "b1", AS_OF)
    with pytest.raises(pipeline.VolumeAlert, match="drivers:100.00%"):
        pipeline.run(run, sources, force_alert=True)
    assert not (tmp_path / "judged").exists()
    assert layers.read_batch(spark, run.history("volume_alerts"), "b1").first().alert_type == "CONTROLLED_TEST"


def test_failed_copy_keeps_the_watermark_and_is_noted(spark, tmp_path, sources):
    broken = dict(sources, ratings=sources["ratings"].withColumn("score", F.raise_error(F.lit("unreadable" * 1_000)).cast("int")))
    run = pipeline.Run(spark, str(tmp_path), "b1", AS_OF)
    with pytest.raises(Exception, match="unreadable"):
        pipeline.run(run, broken)
    log = layers.read_batch(spark, run.history("ingest_log"), "b1")
    assert rows(log.filter("status = 'FAILED'").select("table_name")) == [("ratings",)]
    control = layers.read_batch(spark, run.history("watermarks"), "b1").filter("table_name = 'ratings'").first()
    assert control.watermark.year == 1900
    noted = layers.read_history(spark, run.history("operational_errors")).first()
    assert (noted.table_name, noted.record_key, noted.rule) == ("_pipeline", "ingest", "OPERATIONAL_ERROR")
    assert len(noted.payload) > 10_000


def test_a_failing_log_does_not_hide_the_failure(spark, tmp_path):
    run = pipeline.Run(spark, "/proc/nowhere", "b1", AS_OF)

    def step():
        raise ValueError("the real one")

    with pytest.raises(ValueError, match="the real one") as caught:
        pipeline.staged(run, "silver", step)
    assert "could not be recorded" in caught.value.__notes__[0]


def test_gate_stores_before_it_fails(spark, tmp_path):
    run = pipeline.Run(spark, str(tmp_path), "b1", AS_OF)
    fact = spark.createDataFrame(
        [("S1", "D1", -1.0, None, None)],
        "shipment_id string, driver_id string, weight_kg double, delivered_date date, received_date date",
    )
    with pytest.raises(gate.GateFailed):
        pipeline.check_gold(run, {"fact_shipment": fact, "dim_driver": spark.createDataFrame([("D1",)], "driver_id string")})
    stored = layers.read_batch(spark, run.history("dq_results"), "b1")
    assert stored.filter("status = 'FAIL'").count() == 1 and stored.count() == 5


def test_a_repeated_batch_keeps_its_range_and_its_folder(spark, tmp_path, monkeypatch):
    """b1, b2, then b1 again after midnight: the raw rows are the same."""
    rows_of = {
        "b1": [("R1", datetime(2024, 1, 1)), ("R2", datetime(2024, 1, 2)), ("R0", None)],
        "b2": [("R3", datetime(2024, 1, 3))],
    }
    schema = "rating_id string, updated_at timestamp"
    first = spark.createDataFrame(rows_of["b1"], schema)
    both = spark.createDataFrame(rows_of["b1"] + rows_of["b2"], schema)
    clock = iter([datetime(2024, 2, 1, 23, 50), datetime(2024, 2, 2, 0, 5), datetime(2024, 2, 2, 0, 10)])
    for batch, source in (("b1", first), ("b2", both), ("b1", both)):
        now = next(clock)
        monkeypatch.setattr(pipeline.Run, "now", lambda self, now=now: now)
        pipeline.ingest_all(pipeline.Run(spark, str(tmp_path), batch, AS_OF), {"ratings": source})
        raw_rows = layers.scan_layer(spark, str(tmp_path / "bronze" / "ratings"))
    assert sorted(r["rating_id"] for r in raw_rows.collect()) == ["R0", "R1", "R2", "R3"]
    log = layers.read_history(spark, str(tmp_path / "history" / "ingest_log"))
    assert sorted((r["batch_id"], r["records"]) for r in log.collect()) == [("b1", 3), ("b2", 1)]


def test_a_full_reload_has_no_range(spark, tmp_path):
    source = spark.createDataFrame([("R1", datetime(2024, 1, 1)), ("R0", None)], "rating_id string, updated_at timestamp")
    assert pipeline.ingest_all(pipeline.Run(spark, str(tmp_path), "b1", AS_OF), {"ratings": source}) == {"ratings": 2}
    again = pipeline.Run(spark, str(tmp_path), "b2", AS_OF)
    assert pipeline.ingest_all(again, {"ratings": source}, full_reload=True) == {"ratings": 2}
    log = layers.read_batch(spark, again.history("ingest_log"), "b2").first()
    assert log["watermark_from"] == datetime(1900, 1, 1)


def test_columns_added_by_a_later_batch_are_read(spark, tmp_path):
    spark.createDataFrame([("a",)], "k string").write.parquet(str(tmp_path / "t" / "1"))
    spark.createDataFrame([("b", 2)], "k string, added int").write.parquet(str(tmp_path / "t" / "2"))
    assert rows(layers.scan_layer(spark, str(tmp_path / "t"))) == [("a", None), ("b", 2)]
