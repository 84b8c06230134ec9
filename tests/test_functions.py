import math
import random
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelflow.functions import joins, lookups, numeric, rows as row_functions, timeparts


def test_combine_ts_takes_text_and_timestamps_and_refuses_the_rest(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
            (1, DATE'2024-02-29', '06:30:00'), (2, DATE'2024-02-29', '1970-01-01 06:30:00'),
            (3, DATE'2024-02-29', NULL), (4, NULL, '06:30:00'), (5, DATE'2024-02-29', 'early'),
            (6, DATE'2024-02-29', '25:00:00'), (7, DATE'2024-02-29', '')
        AS t(id, d, t)""")
    got = rows(df.select("id", timeparts.combine_ts("d", "t").cast("string")), "id")
    instant = "2024-02-29 06:30:00"
    assert got == [(1, instant), (2, instant), (3, None), (4, None), (5, None), (6, None), (7, None)]
    stamped = df.select(F.to_timestamp(F.lit("1970-01-01 07:15:00")).alias("t"), F.lit("2024-03-01").cast("date").alias("d"))
    assert stamped.select(timeparts.combine_ts("d", "t")).first()[0] == datetime(2024, 3, 1, 7, 15)


def test_end_of_day_keeps_null(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE'2024-01-31'), (CAST(NULL AS DATE)) AS t(d)")
    assert rows(df.select(timeparts.end_of_day("d").cast("string").alias("x"))) == [(None,), ("2024-01-31 23:59:59",)]


@pytest.mark.parametrize("value, expected", [(0.285, 0.29), (0.7849999999999999, 0.79), (0.784, 0.78), (-0.5, -0.5), (-0.125, -0.13), (-0.001, 0.0)])
def test_half_up(spark, value, expected):
    assert spark.range(1).select(numeric.half_up(F.lit(value), 2)).first()[0] == expected


def test_exact_sums_do_not_depend_on_order(spark):
    values = [0.1 * i for i in range(1, 2_000)] + [1e7, 0.3]
    sums = set()
    for ordered in (values, values[::-1], sorted(values, key=lambda x: hash(str(x)))):
        df = spark.createDataFrame([(x,) for x in ordered], "x double").repartition(5)
        sums.add(tuple(df.agg(numeric.exact_sum("x"), numeric.exact_mean("x")).first()))
    assert len(sums) == 1


def test_sums_are_not_cut(spark):
    """Small values count, large ones do not fail, and the sum is as near as adding without rounding."""
    small = spark.createDataFrame([(1e-10,), (2e-10,), (3e-10,)], "x double")
    assert small.agg(numeric.exact_sum("x")).first()[0] == pytest.approx(6e-10, rel=1e-5)
    large = spark.createDataFrame([(1e19,), (2.5,), (1e25,)], "x double")
    assert large.agg(numeric.exact_sum("x")).first()[0] == 1e25 + 1e19
    draw = random.Random(2)
    values = [draw.uniform(-1e6, 1e6) for _ in range(500)]
    assert spark.createDataFrame([(v,) for v in values], "x double").agg(numeric.exact_sum("x")).first()[0] == pytest.approx(math.fsum(values), rel=1e-15)


def test_times_of_day_have_their_range(spark):
    given = ["25:99:99", "24:00:00", "23:59:59", "at 07:15:00 or 08:00:00", "7:15:00", "12:60:00", None]
    frame = spark.createDataFrame([(t,) for t in given], "t string")
    assert [r[0] for r in frame.selectExpr(timeparts.time_of_day_sql("t")).collect()] == [None, None, "23:59:59", "07:15:00", None, None, None]


def test_exact_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(numeric.exact_mean("x")).first()[0] is None


def test_lookups(spark):
    df = spark.createDataFrame([("MOTO van",), ("Minivan",), (None,), ("x",)], "t string")
    classes = {"moto": "M", "van": "V"}
    assert [r[0] for r in df.select(lookups.classify("t", classes, "T")).collect()] == ["M", "V", "T", "T"]
    codes = spark.createDataFrame([("BOG",), ("XXX",), (None,)], "c string")
    assert [r[0] for r in codes.select(lookups.translate("c", {"BOG": "Bogota"})).collect()] == ["Bogota", None, None]


def test_repeat_rows_numbers_every_copy(spark):
    n = 2 * row_functions.CHUNK + 5
    df = spark.createDataFrame([("a", n), ("b", 1), ("c", 0), ("d", None)], "k string, n bigint")
    got = row_functions.repeat_rows(df, "n", "i", ["k"]).groupBy("k").agg(
        F.count("i"), F.count_distinct("i"), F.min("i"), F.max("i")
    )
    assert rows(got) == [("a", n, n, 1, n), ("b", 1, 1, 1, 1)]


def test_lookup_keeps_rows_and_column_order(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "id int, k string")
    table = spark.createDataFrame([("a", 7), ("c", 8)], "k string, v int")
    got = joins.lookup(facts, table, "k")
    assert got.columns == ["id", "k", "v"]
    assert rows(got, "id") == [(1, "a", 7), (2, "b", None), (3, None, None), (4, "a", 7)]
