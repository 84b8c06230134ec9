"""Later versions: days aggregated again without moving the fact, verdicts merged or taken over."""

import re
from datetime import date, datetime

from conftest import rows

from parcelflow.model import CONTRACTS
from parcelflow.operators import refresh, verdicts as v
from parcelflow.plans import pipeline, silver as cleaning
from parcelflow.sources import versions
from test_cleaning import raw, shipment, zone  # noqa: F401


def test_changed_days_are_compared_once_and_broadcast(spark):
    """Also where Spark would not broadcast a table of that size, the fact is not moved to the days."""
    schema = "day date, rows bigint, content bigint"
    old = spark.createDataFrame([(date(2024, 1, 1), 1, 5), (date(2024, 1, 2), 1, 6)], schema)
    new = spark.createDataFrame([(date(2024, 1, 1), 1, 5), (date(2024, 1, 2), 2, 9), (None, 1, 7)], schema)
    days = refresh.changed_days(old, new)
    assert rows(days) == [(None,), (date(2024, 1, 2),)]
    days = days.filter("day IS NOT NULL")
    fact = spark.createDataFrame(
        [("S1", date(2024, 1, 1), 2024, 1), ("S2", date(2024, 1, 2), 2024, 1)], "shipment_id string, received_date date, received_year int, received_month int"
    )
    kept = spark.createDataFrame([(date(2024, 1, 1), "kept"), (date(2024, 1, 2), "gone")], "day date, shipment_id string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = refresh.refreshed(kept, fact, days, lambda touched: touched.selectExpr("received_date AS day", "shipment_id"))
        text = built._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 2
    assert rows(built) == [(date(2024, 1, 1), "kept"), (date(2024, 1, 2), "S2")]


def test_new_verdicts_are_not_moved_again_to_be_merged(as_deployed, raw, tmp_path):  # noqa: F811
    contract = CONTRACTS["shipments"]
    early, late = [shipment(1), shipment(2), shipment(None, shipment_id=None)], [shipment(2), shipment(3), shipment(4, shipment_id=None)]
    for name, given in (("early", early), ("late", late), ("all", early + late)):
        raw(given)["shipments"].write.parquet(f"{tmp_path}/{name}")
    read = lambda name: as_deployed.read.parquet(f"{tmp_path}/{name}")
    v.judge(read("early"), contract).write.parquet(f"{tmp_path}/stored")
    threshold = as_deployed.conf.get("spark.sql.autoBroadcastJoinThreshold")
    as_deployed.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = v.merge(read("stored"), v.judge_spread(read("late"), contract), contract)
        text = merged._jdf.queryExecution().executedPlan().toString()
        found = rows(merged)
    finally:
        as_deployed.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # the key as it is, by which the verdicts lie, and not an expression of it
    assert re.search(r"SortMergeJoin \[shipment_id#\d+\], \[shipment_id#\d+\], FullOuter", text)
    assert found == rows(v.judge(read("all"), contract).select(merged.columns)) and len(found) == 4


def test_verdicts_without_new_rows_are_taken_over(spark, raw, tmp_path):  # noqa: F811
    """Their folder is that of the version before; what reads them finds the rows of all batches."""
    later = datetime(2024, 3, 1)
    first, all_rows = [shipment(1), shipment(2)], [shipment(1), shipment(2), shipment(2, weight_kg=9.0, updated_at=later), shipment(3, updated_at=later)]
    for batch, given in (("b1", first), ("b2", all_rows)):
        run = pipeline.Run(spark, str(tmp_path), batch, date(2024, 6, 15))
        pipeline.ingest_all(run, raw(given))
        pipeline.build_silver(run)
        pipeline.publish(run)
    folders = {t: e.folder for (layer, t), e in versions.entries(spark, run.root).items() if layer == "verdicts"}
    assert folders == {t: f"versions/{2 if t == 'shipments' else 1}/verdicts/{t}" for t in CONTRACTS}
    batches = {t: set(e.batches) for (layer, t), e in versions.entries(spark, run.root).items() if layer == "verdicts"}
    assert set(map(frozenset, batches.values())) == {frozenset({"b1", "b2"})}
    names = [c for c in CONTRACTS["shipments"].clean_columns if c != "updated_at"]
    expected = cleaning.silver(raw([*all_rows]))
    published = pipeline.read_silver(run)
    assert rows(published["shipments"].select(names)) == rows(expected["shipments"].select(names))
    assert [r[0] for r in published["zones"].select("zone_id").collect()] == ["Z1"]
    # a third batch has new rows of a table that the second one took over
    run = pipeline.Run(spark, str(tmp_path), "b3", date(2024, 6, 15))
    pipeline.ingest_all(run, raw(all_rows, zones=[zone(1), (*zone(2)[:-1], later)]))
    pipeline.build_silver(run)
    pipeline.publish(run)
    assert [r[0] for r in pipeline.read_silver(run)["zones"].select("zone_id").orderBy("zone_id").collect()] == ["Z1", "Z2"]
