"""CSV files of several headers, and reconciliation by content."""

import random

import pytest
from conftest import rows

from parcelflow.model import CONTRACTS
from parcelflow.sources import text


def test_files_of_other_column_orders_meet_by_name(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("RATING_ID , shipment_id,score,rating_date,channel\nR1,S1,5,2024-01-05,App\nR2,S2,x,2024-01-06,Web\n")
    (folder / "b.csv").write_text('channel,rating_date,score,shipment_id,rating_id,comment_text\nApp,2024-01-07,4,S3,R3,"fine, thanks"\n')
    (folder / "c.csv").write_text("rating_id,shipment_id,score,rating_date,channel\n")
    (folder / "d.csv").write_text("")
    contract = CONTRACTS["ratings"]
    assert len(text.headers(spark, str(folder))) == 2
    assert text.load_csv(spark, str(folder), contract, str(tmp_path / "out")) == 3
    found = spark.read.parquet(str(tmp_path / "out"))
    assert rows(found.select("rating_id", "shipment_id", "score", "comment_text", "_bad")) == [
        ("R1", "S1", 5, None, []), ("R2", "S2", None, None, ["score"]), ("R3", "S3", 4, "fine, thanks", [])
    ]


def test_headers_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "twice.csv").write_text("a, A\n1,2\n")
    with pytest.raises(ValueError, match="twice.csv has a column twice"):
        text.read_csv(spark, str(tmp_path / "twice.csv"))
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(ValueError, match="no file with a header"):
        text.read_csv(spark, str(tmp_path / "none.csv"))


SCHEMA = "k string, n int, t string"


def plainly(one, other):
    keys = {r[0] for r in one} | {r[0] for r in other}
    found = []
    for key in keys:
        s, t = (sorted((r for r in side if r[0] == key), key=str) for side in (one, other))
        if s != t:
            found.append((key, "MISSING" if not t else "EXTRA" if not s else "CHANGED", len(s), len(t)))
    return sorted(found, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_differing_keys_against_plain_python(spark, seed):
    rng = random.Random(seed)
    one = [(rng.choice([None, *"abcdefghijkl"]), rng.choice([1, 2, None]), rng.choice(["x", None])) for _ in range(60)]
    other = [r for r in one if rng.random() > 0.05] + [("new", 1, None)] * seed
    other = [(k, t and 9, n) if rng.random() < 0.03 else (k, n, t) for k, n, t in other]
    rng.shuffle(other)
    frames = spark.createDataFrame(one, SCHEMA), spark.createDataFrame(other, SCHEMA).selectExpr("t", "CAST(n AS BIGINT) AS n", "k")
    found = text.reconcile_content(*frames, "k", buckets=5)
    assert sorted(map(tuple, found.collect()), key=str) == plainly(one, other)


def test_equal_and_unlike_tables(spark):
    table = spark.createDataFrame([("a", 1, None), ("a", 1, None), (None, None, None)], SCHEMA)
    assert text.reconcile_content(table, table.repartition(3), "k").count() == 0
    assert text.reconcile_content(table.limit(0), table.limit(0), "k").count() == 0
    with pytest.raises(ValueError, match="columns differ: extra"):
        text.reconcile_content(table, table.selectExpr("*", "1 AS extra"), "k")
