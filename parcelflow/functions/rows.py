"""Turning a count back into rows, and hashing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CHUNK = 10_000


def repeat_rows(df: DataFrame, times: str, ordinal: str, keys: list[str]) -> DataFrame:
    """Each row ``times`` times, numbered 1..times in ``ordinal``; the count column is dropped.

    A count may be as large as the table. It is cut into chunks that are spread
    over the cluster before they unfold, so that no task writes out one group alone.
    """
    first = F.col("_chunk") * CHUNK + 1
    return (
        df.filter(F.col(times) > 0)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(`{times}` - 1) div {CHUNK}"))))
        .repartition(*keys, "_chunk")
        .withColumn(ordinal, F.explode(F.sequence(first, F.least(F.col(times), first + CHUNK - 1))))
        .drop("_chunk", times)
    )


def row_hash(columns: list[str]) -> Column:
    """64-bit hash of the columns in the order of their names; a null counts by its place, too."""
    names = sorted(columns)
    return F.xxhash64(*[F.col(c) for c in names], *[F.col(c).isNull() for c in names])


def content_sum(columns: list[str]) -> Column:
    """Sum of row hashes, in which the order of rows does not matter."""
    return F.sum(row_hash(columns).cast("decimal(38,0)"))
