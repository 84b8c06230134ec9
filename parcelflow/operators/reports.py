"""Quality report of the cleaning step."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from parcelflow.functions.numeric import half_up
from parcelflow.model import CONTRACTS
from parcelflow.operators.cleanse import clean_columns
from parcelflow.operators.verdicts import ACCEPTED


def quality_row(judged: DataFrame, table: str) -> DataFrame:
    """One row: raw rows, kept and rejected rows, kept percentage, null fraction per column as JSON."""
    fractions = ", ".join(
        f"avg(CASE WHEN {ACCEPTED} THEN CAST({c} IS NULL AS INT) END) AS {c}"
        for c in sorted(clean_columns(judged, CONTRACTS[table]))
    )
    counted = judged.selectExpr(
        f"'{table}' AS table_name",
        "coalesce(sum(_copies), 0) AS source_rows",
        f"count_if({ACCEPTED}) AS kept_rows",
        f"to_json(struct({fractions}), map('ignoreNullFields', 'false')) AS null_fractions",
    )
    kept_pct = half_up(F.expr("kept_rows / greatest(source_rows, 1) * 100"), 4)
    return counted.select(
        "table_name",
        "source_rows",
        "kept_rows",
        F.expr("source_rows - kept_rows AS rejected_rows"),
        kept_pct.alias("kept_pct"),
        "null_fractions",
    )


def quality_report(judged: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [quality_row(df, table) for table, df in judged.items()])


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """Null fraction of each column: table_name, column_name, null_fraction (null for an empty table)."""
    fractions = df.selectExpr(*[f"avg(CAST({c} IS NULL AS INT)) AS {c}" for c in df.columns])
    return fractions.select(F.lit(table).alias("table_name"), "*").unpivot(
        "table_name", df.columns, "column_name", "null_fraction"
    )
