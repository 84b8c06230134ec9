from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelflow.model import CONTRACTS
from parcelflow.operators import audit, gate, summary
from parcelflow.sources import ingest, layers, text

NOW = datetime(2024, 2, 1, 2, tzinfo=timezone.utc)


def test_extract_takes_the_half_open_range(spark):
    df = spark.sql("SELECT id, timestamp_seconds(id * 3600) AS updated_at FROM range(10)")
    assert ingest.extract(df, "1970-01-01 02:00:00", "1970-01-01 05:00:00").count() == 3
    assert ingest.extract(df, "1970-01-01 02:00:00", "1970-01-01 05:00:00", full_reload=True).count() == 6


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    df = ingest.stamp(spark.range(10).toDF("id"), "2024-02-01", "src", NOW)
    for _ in range(2):
        assert ingest.append_raw(df, str(tmp_path), "t", "2024-02-01", NOW)[0] == 10
    ingest.append_raw(df.limit(0), str(tmp_path), "t", "2024-02-02", NOW)
    back = layers.scan_layer(spark, f"{tmp_path}/t")
    assert back.count() == 10
    assert back.columns == ["id", "_ingest_ts", "_source_system", "_batch_id"]
    assert (tmp_path / "t/year=2024/month=02/day=01").exists()


def test_history_batches_are_replaced_also_by_nothing(spark, tmp_path):
    path = str(tmp_path / "h")
    layers.replace_batch(spark.range(3).toDF("a"), path, "2024-01-01")
    layers.replace_batch(spark.range(5).toDF("a").withColumn("b", F.lit("new")), path, "run/2")
    assert layers.read_history(spark, path).count() == 8
    assert set(layers.read_history(spark, path).columns) == {"a", "b"}
    layers.replace_batch(spark.range(0).toDF("a"), path, "2024-01-01")
    assert layers.read_history(spark, path).count() == 5
    assert layers.read_batch(spark, path, "run/2").count() == 5


def test_overwrite_replaces_schema_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    layers.overwrite(spark.range(10).withColumn("p", F.col("id") % 3), path, ["p"])
    back = layers.overwrite(spark.range(4).selectExpr("id", "'x' AS label", "id % 2 AS q"), path, ["q"])
    assert sorted(back.columns) == ["id", "label", "q"] and back.count() == 4


def test_register(spark, tmp_path):
    path = str(tmp_path / "t")
    layers.overwrite(spark.range(10).withColumn("p", F.col("id") % 3), path, ["p"])
    try:
        for _ in range(2):
            layers.register(spark, "registered_t", path)
        assert spark.table("registered_t").count() == 10
    finally:
        spark.sql("DROP TABLE IF EXISTS registered_t")


def test_scratch_folder_is_the_configured_one():
    class Conf:
        def get(self, name, default=None):
            return "hdfs://shared/" if name == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert layers.scratch_folder(Session(), "x").startswith("hdfs://shared/x-")


def log(spark, *entries):
    schema = ingest.LOG_SCHEMA
    return spark.createDataFrame(
        [(b, t, None, at, n, 10, 1.0, status, at, at) for b, t, at, n, status in entries], schema
    )


def day(d):
    return datetime(2024, 1, d)


def test_watermark_moves_by_success_only_and_never_back(spark):
    control = ingest.initial_control(spark, ["a", "b", "c"])
    control = ingest.advance(control, log(spark, ("b1", "a", day(5), 1, "SUCCESS"), ("b1", "b", day(5), 1, "FAILED")))
    control = ingest.advance(control, log(spark, ("b2", "a", day(3), 1, "SUCCESS")))
    got = rows(control.select("table_name", F.col("watermark").cast("string"), "last_batch_id"))
    assert got == [
        ("a", "2024-01-05 00:00:00", "b1"), ("b", "1900-01-01 00:00:00", None), ("c", "1900-01-01 00:00:00", None)
    ]


def test_incomplete_batches_are_refused(spark):
    batch = audit.audit_batch(
        log(spark, ("b", "a", day(1), 1, "SUCCESS"), ("b", "c", day(1), 1, "SUCCESS"), ("b", "c", day(1), 1, "SUCCESS")),
        "b",
    )
    with pytest.raises(audit.IncompleteBatch, match="b,c"):
        audit.require_complete(batch, ["a", "b", "c"])
    audit.require_complete(batch.limit(1), ["a"])


def test_volume_limits(spark):
    history = log(
        spark, *[(f"b{d}", "a", day(d), 100, "SUCCESS") for d in range(1, 9)], ("b0", "a", datetime(2023, 1, 1), 9_999, "SUCCESS"),
        ("now", "a", day(9), 130, "SUCCESS"), ("now", "z", day(9), 5, "SUCCESS"),
    )
    batch = audit.audit_batch(history, "now")
    checked = audit.audit_deviation(batch, audit.mean_before(history, "now"))
    assert rows(checked.select("table_name", "mean_records", "deviation_pct")) == [("a", 100.0, 30.0), ("z", None, 0.0)]
    none = audit.volume_alerts(checked)
    assert none.isEmpty()
    assert audit.verdict_line(batch, none, "now").first()[0] == "BRONZE_OK | batch_id=now | tables=2"
    forced = audit.forced_alert(batch)
    assert rows(forced.select("table_name", "mean_records", "alert_type")) == [("a", 65.0, "CONTROLLED_TEST")]
    line = audit.verdict_line(batch, forced, "now").first()[0]
    assert line == "VOLUME_ALERT | batch_id=now | tables=a:100.00% | threshold=30%"


def test_gate(spark):
    schema = "shipment_id string, driver_id string, weight_kg double, delivered_date date, received_date date"
    fact = spark.createDataFrame(
        [("S1", "D1", 1.0, None, None), ("S2", "D9", 0.0, day(1).date(), day(2).date()), ("S2", "D1", None, None, None),
         (None, "D1", 1.0, None, None)], schema,
    )
    drivers = spark.createDataFrame([("D1",)], "driver_id string")
    results = gate.dq_results(fact, drivers)
    assert [(r.rule[:4], r.status, r.failures) for r in results.orderBy("rule").collect()] == [
        ("DQ01", "FAIL", 1), ("DQ02", "FAIL", 1), ("DQ03", "FAIL", 1), ("DQ04", "FAIL", 1), ("DQ05", "FAIL", 1)
    ]
    with pytest.raises(gate.GateFailed, match="5 quality"):
        gate.require_pass(results)
    empty = gate.dq_results(fact.limit(0), drivers)
    assert {r.status for r in empty.collect()} == {"PASS"}


@pytest.mark.parametrize(
    "started, expected", [("2024-02-01T01:59:58.5Z", 1.5), ("2024-02-01T01:59:00+00:00", 60.0), ("", None), (None, None), ("soon", None)]
)
def test_duration(spark, started, expected):
    assert spark.range(1).select(summary.duration_seconds(started, NOW)).first()[0] == expected


def test_csv_headers_types_and_bad_values(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        " SCORE , RATING_ID,shipment_id,rating_date,comment_text,channel,updated_at\n"
        '4,R1,S1,2024-01-05,"fine, thanks",App,2024-01-05 10:00:00\n'
        "five,R2,S2,05/01/2024,,Web,2024-01-05 10:00:00\n"
    )
    got = text.read_typed_csv(spark, str(tmp_path / "r.csv"), CONTRACTS["ratings"])
    assert dict(got.dtypes)["score"] == "int"
    assert rows(got.select("rating_id", "score", "comment_text", "_bad")) == [
        ("R1", 4, "fine, thanks", []), ("R2", None, None, ["rating_date", "score"])
    ]
