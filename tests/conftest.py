from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        # many tiny jobs on literal rows: plan once, and interpret rather than compile
        .config("spark.default.parallelism", "2")
        .config("spark.sql.adaptive.enabled", "false")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def as_deployed(spark):
    """Adaptive planning and generated code, as on a cluster."""
    deployed = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.codegen.wholeStage": "true",
        "spark.sql.codegen.factoryMode": "FALLBACK",
    }
    before = {name: spark.conf.get(name) for name in deployed}
    for name, value in deployed.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


def rows(df, *order: str) -> list[tuple]:
    """Collected rows as tuples, sorted by the given columns (all by default)."""
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]
