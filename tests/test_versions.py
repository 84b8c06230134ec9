"""Published versions, merged verdicts, refreshed days, and ingest in other time zones."""

import os
import subprocess
import sys
import textwrap
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelflow.model import CONTRACTS
from parcelflow.operators import alerts, gate, refresh, verdicts as v
from parcelflow.operators.aggregates import kpi_day
from parcelflow.plans import pipeline
from parcelflow.sources import ingest, layers, versions
from test_cleaning import raw, shipment, table_of  # noqa: F401

AS_OF = date(2024, 6, 15)
NOW = datetime(2024, 6, 15, tzinfo=timezone.utc)


def verdict_rows(df):
    return rows(df.select(sorted(df.columns)))


@pytest.mark.parametrize("cut", [1, 4, 7])
def test_merged_verdicts_are_those_of_all_rows(spark, cut):
    d = lambda n: datetime(2024, 1, n)
    shipments = [
        shipment(1, updated_at=d(1)), shipment(1, package_type="old", updated_at=d(1)), shipment(2, zone_id=None), shipment(2, updated_at=d(3)),
        shipment(0, shipment_id=None), shipment(3, due_date="soon"), shipment(1, updated_at=d(2), package_type="new"),
        shipment(0, shipment_id=None), shipment(4, updated_at=None), shipment(4, updated_at=None, package_type="a"), shipment(3, due_date="later"),
    ]
    contract = CONTRACTS["shipments"]

    def judged(some):
        return v.judge(table_of(spark, "shipments", some, dates_as_text=True), contract)

    merged = v.merge(judged(shipments[:cut]), judged(shipments[cut:]), contract)
    assert verdict_rows(merged) == verdict_rows(judged(shipments))
    assert verdict_rows(v.merge(judged([]), judged(shipments), contract)) == verdict_rows(judged(shipments))


@pytest.fixture
def two_batches(spark, tmp_path, raw):  # noqa: F811
    """Sources before and after a day on which one shipment came and another changed."""
    d = datetime(2024, 1, 11)
    first = raw([shipment(i, updated_at=d) for i in range(1, 6)] + [shipment(6, received_date="2024-01-08", delivered_date="2024-01-09", updated_at=d)])
    later = [shipment(7, updated_at=datetime(2024, 1, 20)), shipment(1, weight_kg=9.0, updated_at=datetime(2024, 1, 20))]
    more = table_of(spark, "shipments", later, dates_as_text=True)
    return first, dict(first, shipments=first["shipments"].unionByName(more))


def build(spark, root, batch, sources, database=None):
    run = pipeline.Run(spark, str(root), batch, AS_OF, database=database)
    pipeline.ingest_all(run, sources)
    return run, pipeline.build_gold(run, pipeline.build_silver(run))


def every_table(run):
    names = (*pipeline.model.DIMENSIONS, *pipeline.model.FACTS, *pipeline.model.AGGREGATES)
    found = pipeline.read_silver(run) | pipeline.read_gold(run, names=names)
    return {t: rows(df.select([c for c in df.columns if not c.startswith("_")])) for t, df in found.items()}


def test_two_batches(spark, tmp_path, two_batches, monkeypatch):
    first, second = two_batches
    read = []
    real = layers.scan_evolved
    monkeypatch.setattr(layers, "scan_evolved", lambda s, folders: read.extend(folders) or real(s, folders))
    spark.sql("CREATE DATABASE IF NOT EXISTS published")
    try:
        run, gold = build(spark, tmp_path / "one", "b1", first, "published")
        pipeline.check_gold(run, gold)
        assert pipeline.publish(run) == 1 and spark.table("published.fact_shipment").count() == 6

        # readers see the second run whole or not at all
        read.clear()
        run, gold = build(spark, tmp_path / "one", "b2", second, "published")
        assert versions.newest(spark, run.root) == 1
        assert pipeline.read_silver(run)["shipments"].count() == 6
        failing = dict(gold, fact_shipment=gold["fact_shipment"].withColumn("weight_kg", -F.col("weight_kg")))
        with pytest.raises(gate.GateFailed):
            pipeline.check_gold(run, failing)
        assert pipeline.read_gold(run)["fact_shipment"].count() == 6
        pipeline.check_gold(run, gold)
        assert pipeline.publish(run) == 2 and spark.table("published.fact_shipment").count() == 7
    finally:
        spark.sql("DROP DATABASE IF EXISTS published CASCADE")
    assert pipeline.read_silver(run)["shipments"].count() == 7
    assert pipeline.read_silver(run, version=1)["shipments"].count() == 6
    assert pipeline.read_gold(run, version=1)["fact_shipment"].count() == 6
    with pytest.raises(versions.UnknownVersion):
        pipeline.read_gold(run, version=9)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        versions.publish(spark, run.root, 2, "b3", {}, {}, NOW)

    # raw rows of the new batch alone were read, and the result is that of all rows together
    assert read and all(f.endswith("batch=b2") for f in read)
    whole, gold = build(spark, tmp_path / "other", "b1", second)
    pipeline.publish(whole)
    assert every_table(run) == every_table(whole)

    # to repeat a batch that is in the published version all raw rows are judged again
    read.clear()
    again = pipeline.Run(spark, run.root, "b2", AS_OF)
    silver = pipeline.build_silver(again)
    assert any("batch=b1" in f for f in read)
    assert rows(silver["shipments"].select("shipment_id", "weight_kg")) == rows(pipeline.read_silver(whole)["shipments"].select("shipment_id", "weight_kg"))


def fact(spark, days):
    schema = (
        "shipment_id string, received_date date, final_status string, sla_met boolean, received_ts timestamp, delivery_ts timestamp, "
        "estimated_penalty double, received_year int, received_month int"
    )
    return spark.createDataFrame(
        [(f"S{i}", d, "Entregado", True, NOW, NOW, p, d.year, d.month) for i, (d, p) in enumerate(days)], schema
    )


def test_changed_days_alone_are_aggregated_again(spark, tmp_path):
    old = fact(spark, [(date(2024, 1, 1), 1.0), (date(2024, 1, 2), 1.0), (date(2024, 2, 1), 1.0), (date(2024, 3, 1), 1.0)])
    new = fact(spark, [(date(2024, 1, 1), 1.0), (date(2024, 1, 2), 2.0), (date(2024, 2, 1), 1.0), (date(2024, 4, 1), 1.0)])
    days = refresh.changed_days(refresh.day_sums(old), refresh.day_sums(new))
    # the fourth shipment moved from March to April
    assert rows(days) == [(date(2024, 1, 2),), (date(2024, 3, 1),), (date(2024, 4, 1),)]
    written = layers.overwrite(new, str(tmp_path / "fact"), ["received_year", "received_month"])
    refreshed = refresh.refreshed(kpi_day(old), written, days, kpi_day)
    assert rows(refreshed) == rows(kpi_day(new))
    plan = refreshed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "received_month" in plan[plan.index("PartitionFilters"):]


def test_content_sums_see_values_that_change_columns(spark):
    one, other = spark.createDataFrame([("a", None)], "x string, y string"), spark.createDataFrame([(None, "a")], "x string, y string")
    hashed = lambda df: df.select(refresh.content_sum(df.columns)).first()[0]
    assert hashed(one) != hashed(other)


def test_baselines_carried_from_batch_to_batch(spark):
    days = spark.createDataFrame(
        [("Z1", date(2024, 1, 1 + 7 * i), i / 10, 2) for i in range(4)] + [("Z1", date(2024, 2, 5 + 7 * i), 0.5, 2) for i in range(3)] + [("Z2", date(2024, 1, 2), 0.0, 3)],
        "zone_id string, day date, failure_rate double, weekday int",
    )
    recent, found = None, []
    for start, end in ((date(2024, 1, 1), date(2024, 1, 9)), (date(2024, 1, 9), date(2024, 2, 6)), (date(2024, 2, 6), date(2024, 3, 1))):
        batch = days.filter((F.col("day") >= start) & (F.col("day") < end))
        known = recent if recent is not None else alerts.recent_days(days.limit(0))
        found += rows(alerts.carried_baseline(batch, known))
        recent = alerts.recent_days(batch, recent)
    assert sorted(found) == rows(alerts.zone_baseline(days))
    assert max(len(r["recent"]) for r in recent.collect()) == alerts.BASELINE_DAYS


def test_a_batch_committed_meanwhile_is_refused(spark, tmp_path):
    source = spark.createDataFrame([("R1", datetime(2024, 1, 1))], "rating_id string, updated_at timestamp")
    pipeline.ingest_all(pipeline.Run(spark, str(tmp_path), "b1", AS_OF), {"ratings": source})
    path = str(tmp_path / "history" / "ingest_log")
    with pytest.raises(ingest.BatchOrder, match="b2"):
        ingest.commit(spark, path, "b2", [], seen=0)
    assert ingest.last_sequence(ingest.read_log(spark, path)) == 1


def test_nothing_moves_without_the_commit(spark, tmp_path, monkeypatch):
    """A stop between the copy and the commit leaves log and watermark as they were."""
    source = spark.createDataFrame([("R1", datetime(2024, 1, 1))], "rating_id string, updated_at timestamp")

    def stopped(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "commit", stopped)
        with pytest.raises(KeyboardInterrupt):
            pipeline.ingest_all(pipeline.Run(spark, str(tmp_path), "b1", AS_OF), {"ratings": source})
    assert pipeline.read_log(pipeline.Run(spark, str(tmp_path), "b1", AS_OF)) is None
    assert pipeline.ingest_all(pipeline.Run(spark, str(tmp_path), "b2", AS_OF), {"ratings": source}) == {"ratings": 1}
    # and a stop behind it changes no more: the log alone decides
    later = source.unionByName(spark.createDataFrame([("R2", datetime(2024, 1, 2))], source.schema))
    with monkeypatch.context() as patch:
        real = layers.replace_batch

        def without_watermarks(df, path, batch):
            if path.endswith("watermarks"):
                raise KeyboardInterrupt
            return real(df, path, batch)

        patch.setattr(layers, "replace_batch", without_watermarks)
        with pytest.raises(KeyboardInterrupt):
            pipeline.ingest_all(pipeline.Run(spark, str(tmp_path), "b3", AS_OF), {"ratings": later})
    assert pipeline.ingest_all(pipeline.Run(spark, str(tmp_path), "b4", AS_OF), {"ratings": later}) == {"ratings": 0}


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_replays_and_first_runs_in_other_time_zones(tmp_path, zone):
    """b1, b2 and b1 again around midnight UTC, with a null time of change, on a machine in another time zone."""
    script = textwrap.dedent(f"""
        import sys
        from datetime import date, datetime, timezone
        from pyspark.sql import SparkSession, functions as F
        from parcelflow.plans import pipeline
        from parcelflow.sources import layers
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        first = spark.sql("SELECT * FROM VALUES ('R0', NULL), ('R1', TIMESTAMP'2024-01-01 23:30:00'), ('R2', TIMESTAMP'2024-01-02 00:30:00') AS t(rating_id, updated_at)")
        both = first.unionAll(spark.sql("SELECT 'R3', TIMESTAMP'2024-01-03 02:00:00'"))
        clock = iter([datetime(2024, 2, 2, 2, tzinfo=timezone.utc), datetime(2024, 2, 2, 23, 50), datetime(2024, 2, 3, 0, 5), datetime(2024, 2, 3, 4)])
        for batch, source, upper in (("b1", first, None), ("b1", first, None), ("b2", both, None), ("b1", both, None)):
            now = next(clock)
            pipeline.Run.now = lambda self, now=now: now
            pipeline.ingest_all(pipeline.Run(spark, {str(tmp_path)!r}, batch, date(2024, 6, 15)), {{"ratings": source}})
        found = layers.scan_layer(spark, {str(tmp_path / "bronze" / "ratings")!r})
        print("ROWS", sorted(r["rating_id"] for r in found.collect()))
        log = layers.read_history(spark, {str(tmp_path / "history" / "ingest_log")!r})
        print("LOG", sorted(map(tuple, log.select("batch_id", "records", "ingested_on", F.col("watermark_to").cast("string")).collect())))
    """)
    env = os.environ | {"TZ": zone, "PYTHONPATH": str(Path(__file__).parent.parent)}
    done = subprocess.run([sys.executable, "-c", script], env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS ['R0', 'R1', 'R2', 'R3']" in done.stdout, done.stdout + done.stderr[-2_000:]
    assert "LOG [('b1', 3, '2024-02-02', '2024-01-02 00:30:00'), ('b2', 1, '2024-02-03', '2024-01-03 02:00:00')]" in done.stdout
    assert (tmp_path / "bronze/ratings/year=2024/month=02/day=02/batch=b1").exists()


def test_common_types():
    assert layers.common_type({"int"}) == "int"
    assert layers.common_type({"int", "bigint", "smallint"}) == "bigint"
    assert layers.common_type({"int", "decimal(5,2)"}) == "decimal(12,2)"
    assert layers.common_type({"decimal(10,4)", "decimal(12,2)"}) == "decimal(14,4)"
    assert layers.common_type({"int", "float"}) == "double"
    assert layers.common_type({"date", "timestamp_ntz"}) == "timestamp_ntz"
    assert layers.common_type({"date", "string"}) == "string"


def test_folders_of_other_schemas_are_read_together(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "k int, gone string").write.parquet(str(tmp_path / "t/year=1/batch=1"))
    spark.createDataFrame([(2**40, date(2024, 1, 1))], "k bigint, added date").write.parquet(str(tmp_path / "t/year=1/batch=2"))
    spark.createDataFrame([(3, datetime(2024, 1, 2))], "k int, added timestamp").write.parquet(str(tmp_path / "t/year=2/batch=3"))
    found = layers.scan_layer(spark, str(tmp_path / "t"))
    assert dict(found.dtypes) == {"k": "bigint", "gone": "string", "added": "timestamp"}
    assert rows(found.select("k", "gone", F.col("added").cast("string")), "k") == [
        (1, "a", None), (3, None, "2024-01-02 00:00:00"), (2**40, None, "2024-01-01 00:00:00")
    ]
