"""What a run did: rows per layer and table, rejections, failed checks, duration."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def table_counts(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """layer, table_name, rows of every table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "rows")
        for layer, tables in layers.items()
        for table, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def run_counts(counts: DataFrame) -> DataFrame:
    """Rows per table, per layer (table_name ALL) and in total (layer ALL)."""
    return (
        counts.rollup("layer", "table_name")
        .agg(F.sum("rows").alias("rows"), F.grouping("layer").alias("_l"), F.grouping("table_name").alias("_t"))
        .select(
            F.when(F.col("_l") == 1, "ALL").otherwise(F.col("layer")).alias("layer"),
            F.when(F.col("_t") == 1, "ALL").otherwise(F.col("table_name")).alias("table_name"),
            "rows",
        )
    )


def duration_seconds(started_at: str | None, finished_at: datetime) -> Column:
    """Seconds from the ISO text to the finish, three decimals; null when it is absent or no instant."""
    started = F.try_to_timestamp(F.lit(started_at or None).cast("string"))
    millis = F.unix_millis(F.lit(finished_at).cast("timestamp")) - F.unix_millis(started)
    return millis / F.lit(1000.0)


def run_summary(
    counts: DataFrame,
    quality: DataFrame,
    checks: DataFrame,
    batch_id: str,
    started_at: str | None,
    finished_at: datetime,
) -> DataFrame:
    """The summary row of a batch.

    Rejected rows are summed over the quality report: a row may have several
    findings. ``quality`` and ``checks`` are those of the batch.
    """
    facts = (
        counts.select("layer", "table_name", "rows")
        .unionByName(quality.select("rejected_rows"), allowMissingColumns=True)
        .unionByName(checks.select("status"), allowMissingColumns=True)
    )

    def rows_of(layer: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("layer") == layer, F.col("rows"))), F.lit(0)).alias(f"{layer}_rows")

    # one entry per table
    entry = F.struct(F.concat_ws(".", "layer", "table_name"), "rows")
    per_table = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("layer").isNotNull(), entry))))
    one_row = facts.agg(
        rows_of("silver"),
        rows_of("gold"),
        per_table.alias("per_table"),
        F.coalesce(F.sum("rejected_rows"), F.lit(0)).alias("rejected_rows"),
        F.count_if(F.col("status") == "FAIL").alias("quality_alerts"),
    ).withColumns(
        {
            "duration_seconds": duration_seconds(started_at, finished_at),
            "finished_at": F.lit(finished_at).cast("timestamp"),
        }
    )
    payload = F.to_json(
        F.struct(
            F.lit(batch_id).alias("batch_id"),
            F.lit("SUCCESS").alias("status"),
            F.struct(F.col("silver_rows").alias("silver"), F.col("gold_rows").alias("gold")).alias("rows_per_layer"),
            F.col("per_table").alias("rows_per_table"),
            "rejected_rows",
            "quality_alerts",
            "duration_seconds",
            "finished_at",
        ),
        {"ignoreNullFields": "false"},
    )
    line = F.concat_ws(
        " | ",
        F.lit("DAILY_SUMMARY"),
        F.lit(f"batch_id={batch_id}"),
        F.concat(F.lit("silver="), F.col("silver_rows").cast("string")),
        F.concat(F.lit("gold="), F.col("gold_rows").cast("string")),
        F.concat(F.lit("rejected="), F.col("rejected_rows").cast("string")),
        F.concat(F.lit("quality_alerts="), F.col("quality_alerts").cast("string")),
        F.concat(F.lit("seconds="), F.expr("if(duration_seconds IS NULL, 'unknown', format_string('%.3f', duration_seconds))")),
    )
    return one_row.select(
        F.lit(batch_id).alias("batch_id"),
        payload.alias("summary"),
        "silver_rows",
        "gold_rows",
        "rejected_rows",
        "quality_alerts",
        "duration_seconds",
        "finished_at",
        line.alias("summary_line"),
    )
