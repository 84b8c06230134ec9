"""Left lookup joins."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup(df: DataFrame, table: DataFrame, on: str) -> DataFrame:
    """Left join with a table that has at most one row per ``on``; columns of ``df``, then those of ``table``.

    Spark picks the strategy: it broadcasts a small table, by its size as planned or as found at run time,
    and otherwise shuffles and splits the rows of a key (or of null) that holds much of them.
    """
    return df.join(table, on, "left").select(*df.columns, *[c for c in table.columns if c != on])
