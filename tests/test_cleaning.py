"""Cleaning on hand-made rows: what the test tables do not contain."""

import json
from datetime import date, datetime

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelflow.functions import joins
from parcelflow.model import CONTRACTS, PII_REGISTER
from parcelflow.operators import reports, verdicts as v
from parcelflow.plans import gold, silver as cleaning

T0 = datetime(2024, 1, 1)


def zone(i):
    return (f"Z{i}", f"zone {i}", "BOG", None, 4.0, -70.0, 3.0, "Urban", 12.0, T0)


def driver(i, zone_id="Z1"):
    return (f"D{i}", "Ana", None, "CC", "H", date(2020, 1, 1), "N1", "Moto", zone_id, True, None, T0)


def shipper(i):
    return (f"C{i}", "Shop", "Retail", "N1", 24, 0.1, True, T0)


def shipment(i, **changes):
    base = {
        "shipment_id": f"S{i}", "shipper_id": "C1", "driver_id": "D1", "zone_id": "Z1", "package_type": "Small",
        "weight_kg": 2.0, "received_date": "2024-01-10", "received_time": "08:00:00", "due_date": "2024-01-11",
        "attempt1_date": "2024-01-10", "attempt1_time": "10:00:00", "attempt1_result": "Entregado",
        "attempt2_date": None, "attempt2_time": None, "attempt2_result": None, "delivered_date": "2024-01-10",
        "final_status": "Entregado", "failure_code": None, "declared_value": 100.0, "updated_at": T0,
    }
    return tuple((base | changes).values())


ARROW = {
    "string": pa.string(), "time": pa.string(), "double": pa.float64(), "int": pa.int32(), "boolean": pa.bool_(),
    "date": pa.date32(), "timestamp": pa.timestamp("us", "UTC"),
}


def table_of(spark, name, rows_, dates_as_text=False):
    """Hand-made rows of a source table as a local table, whose size Spark knows."""
    kinds = {c: "string" if dates_as_text and t == "date" else t for c, t in CONTRACTS[name].types.items()}
    columns = zip(*rows_) if rows_ else [[]] * len(kinds)
    arrays = [pa.array(list(values), ARROW[kind]) for values, kind in zip(columns, kinds.values())]
    return spark.createDataFrame(pa.table(arrays, names=list(kinds)))


@pytest.fixture
def raw(spark):
    def build(shipments, **others):
        data = {
            "zones": [zone(1)], "drivers": [driver(1), driver(2, "Z9")], "shippers": [shipper(1)],
            "routes": [], "ratings": [], "incidents": [],
        } | others
        tables = {t: table_of(spark, t, r) for t, r in data.items()}
        return tables | {"shipments": table_of(spark, "shipments", shipments, dates_as_text=True)}

    return build


def found(raw_tables, table="shipments"):
    all_found = cleaning.all_findings(cleaning.judge_all(raw_tables))
    return rows(all_found.filter(F.col("table_name") == table).select("record_key", "rule"), "record_key", "rule")


def test_each_defect_gives_its_finding(raw):
    tables = raw(
        [
            shipment(1),
            shipment(2, shipper_id="C404"),
            shipment(3, received_date="someday"),
            shipment(4, weight_kg=-1.0, delivered_date="2024-01-01"),
            shipment(5, driver_id="D2", shipper_id="C404"),
            shipment(6, zone_id=None),
            shipment(0, shipment_id=None),
            shipment(0, shipment_id=None),
            shipment(7, due_date="31/01/2024"),
            shipment(8, weight_kg=None, delivered_date=None),
        ]
    )
    assert found(tables) == [
        (None, "REQUIRED_NULL"), (None, "REQUIRED_NULL"),
        ("S2", "FK_INVALID_shipper_id"),
        ("S3", "TYPE_INVALID"),
        ("S4", "DELIVERED_BEFORE_RECEIVED"), ("S4", "WEIGHT_NOT_POSITIVE"),
        ("S5", "FK_INVALID_driver_id"),
        ("S6", "REQUIRED_NULL"),
        ("S7", "TYPE_INVALID"),
    ]
    kept = cleaning.silver(tables, "shipments")["shipments"]
    assert rows(kept.select("shipment_id")) == [("S1",), ("S8",)]


def test_findings_are_not_rejections(raw):
    """Five duplicated rows, five weights, five dates: twenty findings, fifteen rejected rows."""
    shipments = [shipment(i) for i in range(100)]
    shipments += [shipment(i) for i in range(5)]
    shipments[10:15] = [shipment(i, weight_kg=0.0) for i in range(10, 15)]
    shipments[20:25] = [shipment(i, delivered_date="2024-01-09") for i in range(20, 25)]
    judged = cleaning.judge_all(raw(shipments))
    assert v.findings(judged["shipments"], CONTRACTS["shipments"]).count() == 20
    report = reports.quality_row(judged["shipments"], "shipments").first()
    assert (report.source_rows, report.kept_rows, report.rejected_rows, report.kept_pct) == (105, 90, 15, 85.7143)
    assert json.loads(report.null_fractions)["attempt2_date"] == 1.0


def test_newest_copy_survives_whatever_the_order(spark, raw):
    copies = [shipment(1, updated_at=datetime(2024, 1, d), package_type=f"p{d}") for d in (3, 9, 5)]
    copies += [shipment(2, package_type=p) for p in ("b", "a", None)] + [shipment(3, updated_at=None), shipment(3)]
    results = []
    for order in (copies, copies[::-1], copies[3:] + copies[:3]):
        tables = raw(order)
        results.append(rows(cleaning.silver(tables, "shipments")["shipments"].repartition(3)))
    assert results[0] == results[1] == results[2]
    assert [(r[0], r[4]) for r in results[0]] == [("S1", "p9"), ("S2", None), ("S3", "Small")]
    assert results[0][2][-2] == T0


def test_finding_ids_are_unique_and_repeatable(raw):
    tables = raw([shipment(1)] * 3 + [shipment(0, shipment_id=None)] * 2)
    ids = [
        rows(v.quarantine(cleaning.all_findings(cleaning.judge_all(tables)), "b1").select("finding_id", "payload"))
        for _ in range(2)
    ]
    assert ids[0] == ids[1]
    assert len({i for i, _ in ids[0]}) == len(ids[0])
    assert {p for _, p in ids[0]} >= {"{}", '{"record_key":"S1"}'}


def test_empty_tables_pass_through(raw):
    tables = raw([])
    judged = cleaning.judge_all(tables)
    assert cleaning.silver(tables, "shipments")["shipments"].isEmpty()
    report = reports.quality_row(judged["shipments"], "shipments").first()
    assert (report.source_rows, report.rejected_rows, report.kept_pct) == (0, 0, 0.0)
    assert json.loads(report.null_fractions)["driver_id"] is None
    profile = reports.null_profile(cleaning.clean(judged["ratings"], CONTRACTS["ratings"]), "ratings")
    assert {r.null_fraction for r in profile.collect()} == {None}


def test_ratings_of_a_rejected_shipment_stay(raw):
    """References are checked before the business rules."""
    rating = ("R1", "S1", date(2024, 1, 11), 5, "fine", "App", T0)
    tables = raw([shipment(1, weight_kg=-1.0)], ratings=[rating, ("R2", "S404") + rating[2:]])
    silver = cleaning.silver(tables)
    assert silver["shipments"].isEmpty()
    assert [r.rating_id for r in silver["ratings"].collect()] == ["R1"]


def test_missing_and_undeclared_columns(raw):
    tables = raw([shipment(1)])
    tables["shipments"] = tables["shipments"].drop("failure_code").withColumn("secret", F.lit("x"))
    kept = cleaning.silver(tables, "shipments")["shipments"]
    assert kept.columns == CONTRACTS["shipments"].clean_columns
    assert kept.first().failure_code is None


@pytest.mark.parametrize("limit", ["-1", "64m"])
def test_the_broadcast_limit_does_not_change_the_findings(spark, raw, limit):
    tables = raw([shipment(1), shipment(2, shipper_id="C404"), shipment(3, driver_id="D2"), shipment(4, zone_id=None)])
    expected = found(tables)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        assert found(tables) == expected
        assert len(expected) == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unusable_times_and_numbers_are_invalid(spark):
    raw_rows = [("S1", "noonish", "NaN"), ("S2", "08:15:00", "12.5"), ("S3", None, "Infinity"), ("S4", "1970-01-01 09:00:00", None)]
    got = v.typed(spark.createDataFrame(raw_rows, "shipment_id string, received_time string, weight_kg string"), CONTRACTS["shipments"])
    assert rows(got.select("shipment_id", "received_time", "weight_kg", "_bad")) == [
        ("S1", None, None, ["weight_kg", "received_time"]), ("S2", "08:15:00", 12.5, []),
        ("S3", None, None, ["weight_kg"]), ("S4", "09:00:00", None, []),
    ]


def test_no_clear_personal_text_leaves_the_cleaning(raw):
    silver = cleaning.silver(raw([shipment(1)]))
    hidden = {(s.table, s.column) for s in PII_REGISTER if s.treatment == "hash_and_drop"}
    assert hidden == {(t, m.column) for t, c in CONTRACTS.items() for m in c.masks}
    model = gold.gold(silver, date(2024, 6, 15))
    names = {column for _, column in hidden}
    for df in [*silver.values(), *model.values()]:
        assert not names & set(df.columns)
    ana = silver["drivers"].first()
    assert len(ana.first_name_hash) == 64
    assert ana.last_name_hash == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert ana.rating_avg == 0.0 and ana.rating_avg_missing


def test_silver_schema_is_the_contract(raw):
    silver = cleaning.silver(raw([shipment(1)]))
    for table, df in silver.items():
        contract = CONTRACTS[table]
        assert df.columns == contract.clean_columns
        kinds = dict(df.dtypes)
        for column, kind in contract.types.items():
            if column in kinds:
                assert kinds[column] == ("string" if kind == "time" else kind)


def test_times_and_numbers_out_of_range_are_findings(raw):
    tables = raw([shipment(1, received_time="25:99:99"), shipment(2, declared_value=1e19), shipment(3, weight_kg=float("nan")), shipment(4)])
    assert found(tables) == [("S1", "TYPE_INVALID"), ("S2", "TYPE_INVALID"), ("S3", "TYPE_INVALID")]


def test_masks_come_from_the_register():
    for table, contract in CONTRACTS.items():
        hidden = {s.column for s in PII_REGISTER if s.table == table and s.treatment == "hash_and_drop"}
        assert {m.column for m in contract.masks} == hidden
        assert all(m.mandatory == (next(s.tag for s in PII_REGISTER if s.column == m.column) == "PII_NAME") for m in contract.masks)


def test_busy_keys_are_judged_as_all_others(spark):
    """Many copies of one key and many rows without a key, beside others: the verdicts are those of judging in one go."""
    contract = CONTRACTS["shipments"]
    hot = [shipment(1, weight_kg=float(i), updated_at=datetime(2024, 1, 1, 0, i)) for i in range(1, 30)]
    keyless = [shipment(2, shipment_id=None) for _ in range(30)]
    table = table_of(spark, "shipments", [*hot, *keyless, shipment(3), shipment(3), shipment(4, received_date="no day")], dates_as_text=True)
    busy = v.busy_buckets(table, contract, least=20)
    assert busy.count() == 2
    assert v.busy_buckets(table, contract).isEmpty()
    whole = sorted(map(repr, v.judge(table, contract).collect()))
    assert sorted(map(repr, v.judge_spread(table, contract, busy).collect())) == whole
    assert sorted(map(repr, v.judge_spread(table, contract).collect())) == whole
