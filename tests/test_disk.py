"""What a run leaves on disk."""

import subprocess
import sys
import textwrap
from datetime import date, datetime
from pathlib import Path
from threading import Lock

from conftest import rows
from pyspark.sql import functions as F

from parcelflow.operators import timeline
from parcelflow.plans import gold, pipeline, together
from parcelflow.sources import layers
from test_cleaning import raw, shipment  # noqa: F401


def test_a_run_leaves_no_shuffle_files(tmp_path):
    """In a session of its own, whose local folder holds nothing else."""
    script = textwrap.dedent(f"""
        from datetime import date
        from pathlib import Path
        from pyspark.sql import SparkSession
        import fixtures
        from parcelflow.plans import pipeline, together
        local = Path({str(tmp_path / "local")!r})
        spark = SparkSession.builder.master("local[4]").config(map={{
            "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.local.dir": str(local), "spark.driver.memory": "2g",
        }}).getOrCreate()
        run = pipeline.Run(spark, {str(tmp_path / "run")!r}, "b1", date(2024, 6, 15))
        left = lambda: sum(1 for _ in local.rglob("shuffle_*.data"))
        spark.range(9).repartition(3).count()
        print("BEFORE", left())
        pipeline.run(run, fixtures.sources(spark, "/root/testdata/sf0.001"), city_names=fixtures.CITY_NAMES)
        print("AFTER", left(), spark.conf.get(together.SHUFFLE_CLEANUP))
    """)
    here = str(Path(__file__).parent.parent)
    done = subprocess.run([sys.executable, "-c", script], cwd=here, capture_output=True, text=True, timeout=600)
    told = dict(line.split(" ", 1) for line in done.stdout.splitlines() if line.startswith(("BEFORE", "AFTER")))
    assert int(told["BEFORE"]) > 0, done.stderr[-2_000:]
    count, setting = told["AFTER"].split()
    # only what was there before, and the session's setting is as it was; the files go shortly after their query
    assert int(count) <= int(told["BEFORE"]) + 2 and setting == "false"
    written = [f.name for layer in ("versions", "history/quarantine") for f in (tmp_path / "run" / layer).rglob("*.parquet")]
    assert written and all(name.endswith(".zstd.parquet") for name in written)


def test_the_setting_of_the_session_comes_back(spark):
    for before in (None, "true", "false"):
        if before:
            spark.conf.set(together.SHUFFLE_CLEANUP, before)
        try:
            with together.shuffles_dropped(spark):
                assert spark.conf.get(together.SHUFFLE_CLEANUP) == "true"
                raise ValueError
        except ValueError:
            pass
        assert spark.conf.get(together.SHUFFLE_CLEANUP, None) == before
        spark.conf.unset(together.SHUFFLE_CLEANUP)


def test_a_frame_may_be_executed_twice(as_deployed):
    counted = as_deployed.range(100).groupBy((F.col("id") % 3).alias("k")).count()
    with together.shuffles_dropped(as_deployed):
        assert rows(counted) == rows(counted) == [(0, 34), (1, 33), (2, 33)]
        assert sorted(counted.collect()) == sorted(counted.collect())


def test_large_tables_are_written_one_after_the_other(spark, tmp_path, raw, monkeypatch):  # noqa: F811
    run = pipeline.Run(spark, str(tmp_path), "b1", date(2024, 6, 15))
    pipeline.ingest_all(run, raw([shipment(i, updated_at=datetime(2024, 1, 11)) for i in range(1, 4)]))
    silver = pipeline.build_silver(run)
    real, lock, busy, seen = layers.overwrite, Lock(), set(), []

    def overwrite(df, path, partition_by=None):
        table = path.rsplit("/", 1)[-1]
        with lock:
            busy.add(table)
            seen.append(busy & set(gold.LARGE))
        try:
            return real(df, path, partition_by)
        finally:
            with lock:
                busy.discard(table)

    monkeypatch.setattr(layers, "overwrite", overwrite)
    built = pipeline.build_gold(run, silver)
    assert max(map(len, seen)) == 1 and set().union(*seen) == set(gold.LARGE)
    assert set(built) == {*gold.DIMENSIONS, *gold.FACTS, *gold.AGGREGATES, gold.DAY_SUMS}


def test_events_are_moved_again_for_crowded_keys_alone(as_deployed, tmp_path):
    """The keys are looked up below the second window, not above it, where all events would be moved to it."""
    path = str(tmp_path / "events")
    as_deployed.range(50).selectExpr(
        "concat('S', id) AS k", "timestamp'2024-01-01 00:00:00' AS ts", "'a' AS label", "CASE id WHEN 7 THEN 25000L ELSE 1L END AS n"
    ).write.parquet(path)
    placed = timeline.timeline(as_deployed.read.parquet(path), "k", "ts", "label", "n")
    text = placed._jdf.queryExecution().executedPlan().toString()
    assert text.count("LeftSemi") == 1 and text.index("LeftSemi") > text.rindex("Window [")
    orders = placed.filter("k = 'S7'").agg(F.count("*"), F.min("event_order"), F.max("event_order"), F.countDistinct("event_order"))
    assert rows(orders) == [(25000, 1, 25000, 25000)] and placed.filter("k <> 'S7'").count() == 49
