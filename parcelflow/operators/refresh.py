"""Daily tables brought up to date by the days that changed.

The shipment fact is summed up per day by a number of rows and an order-free sum of row hashes. Two such sums tell
which days differ between two versions of the fact, whatever the cause: new rows, replaced ones, a driver or shipper
that came or went. Only these days are aggregated again, from the months that hold them; all others are kept.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.functions.rows import content_sum


def day_sums(fact: DataFrame) -> DataFrame:
    """day, rows, content: a sum of 64-bit hashes of all columns, in which the order of rows does not matter."""
    content = content_sum(fact.columns).alias("content")
    return fact.groupBy(F.col("received_date").alias("day")).agg(F.count(F.lit(1)).alias("rows"), content)


def changed_days(before: DataFrame, now: DataFrame) -> DataFrame:
    """Days whose sums differ, also those that only one side has; compared once, and held by the driver."""
    old = before.select("day", F.struct("rows", "content").alias("_old"))
    new = now.select("day", F.struct("rows", "content").alias("_new"))
    days = old.join(new, "day", "full").filter(~F.col("_old").eqNullSafe(F.col("_new"))).select("day")
    # one row for each day of the calendar that the fact has
    return days.sparkSession.createDataFrame(days.collect(), days.schema)


def months_of(days: DataFrame, prefix: str = "received") -> Column:
    """Condition on the layout columns of a fact for the months of some days, so that the scan opens no other folder."""
    # one row for each month
    months = days.select(F.year("day").alias("y"), F.month("day").alias("m")).distinct().collect()
    by_year: dict[int, list[int]] = {}
    for row in months:
        by_year.setdefault(row["y"], []).append(row["m"])
    year, month = F.col(f"{prefix}_year"), F.col(f"{prefix}_month")
    return reduce(lambda a, b: a | b, [(year == y) & month.isin(sorted(m)) for y, m in sorted(by_year.items())], F.lit(False))


def refreshed(before: DataFrame, fact: DataFrame, days: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A daily table built again for some days only; ``before`` is the table of the earlier fact.

    The days are broadcast: not knowing how few they are, Spark would move all rows of the fact to them.
    """
    touched = fact.filter(months_of(days)).join(F.broadcast(days.withColumnRenamed("day", "received_date")), "received_date", "left_semi")
    return before.join(F.broadcast(days), "day", "left_anti").unionByName(build(touched.select(*fact.columns)))
