"""Volume audit of an ingest batch against earlier batches of the same table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelflow.model import VOLUME_ALERT_PCT, VOLUME_HISTORY

FORCED_DEVIATION_PCT = 100.0


class IncompleteBatch(RuntimeError):
    """A batch lacks the log row of a table, or has more than one."""


def audit_batch(log: DataFrame, batch_id: str) -> DataFrame:
    """The batch's log rows with the columns of the audit history."""
    return log.filter(F.col("batch_id") == batch_id).select(
        "batch_id",
        "table_name",
        F.col("records").cast("bigint").alias("records"),
        F.col("bytes").cast("bigint").alias("bytes"),
        F.col("seconds").cast("double").alias("seconds"),
        "logged_at",
    )


def log_row_faults(batch: DataFrame, expected: list[str]) -> DataFrame:
    """Expected tables without exactly one log row, and tables nobody expected."""
    tables = batch.sparkSession.createDataFrame([(t,) for t in expected], "table_name string")
    counted = batch.groupBy("table_name").agg(F.count(F.lit(1)).alias("log_rows"))
    return (
        tables.withColumn("_expected", F.lit(1))
        .join(counted, "table_name", "full")
        .select(
            "table_name",
            F.coalesce("_expected", F.lit(0)).alias("expected_rows"),
            F.coalesce("log_rows", F.lit(0)).alias("log_rows"),
        )
        .filter(F.col("expected_rows") != F.col("log_rows"))
    )


def require_complete(batch: DataFrame, expected: list[str]) -> None:
    faults = log_row_faults(batch, expected)
    # at most one row per table name
    wrong = faults.agg(F.array_join(F.array_sort(F.collect_list("table_name")), ",").alias("t")).first()["t"]
    if wrong:
        raise IncompleteBatch(f"not exactly one log row for: {wrong}")


def trailing_mean(value: str, keys: list[str], order: str, n: int) -> Column:
    """Mean of the up to ``n`` rows before the current one; null when there is none."""
    return F.avg(value).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(-n, -1))


def mean_before(history: DataFrame, batch_id: str, n: int = VOLUME_HISTORY) -> DataFrame:
    """Mean records of the newest ``n`` other batches of each table."""
    newest = Window.partitionBy("table_name").orderBy(F.col("logged_at").desc_nulls_last(), F.col("batch_id").desc())
    return (
        history.filter(F.col("batch_id") != batch_id)
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= n)
        .groupBy("table_name")
        .agg(F.avg("records").alias("mean_records"))
    )


def deviation_pct(value: str, mean: str) -> Column:
    """Absolute deviation in percent; 0 without history or with a mean of 0."""
    off = F.abs(F.col(value) - F.col(mean)) / F.col(mean) * 100
    return F.when(F.col(mean) > 0, off).otherwise(0.0)


def audit_deviation(batch: DataFrame, means: DataFrame) -> DataFrame:
    return batch.join(means, "table_name", "left").select(
        *batch.columns, "mean_records", deviation_pct("records", "mean_records").alias("deviation_pct")
    )


def volume_alerts(checked: DataFrame, limit_pct: float = VOLUME_ALERT_PCT) -> DataFrame:
    return checked.filter(F.col("deviation_pct") > limit_pct).withColumn("alert_type", F.lit("VOLUME_ANOMALY"))


def volume_alerts_history(history: DataFrame, n: int = VOLUME_HISTORY, limit_pct: float = VOLUME_ALERT_PCT) -> DataFrame:
    """The alerts every batch of the history would have raised in its turn."""
    checked = history.withColumn("mean_records", trailing_mean("records", ["table_name"], "logged_at", n))
    return volume_alerts(
        checked.withColumn("deviation_pct", deviation_pct("records", "mean_records")), limit_pct
    )


def forced_alert(batch: DataFrame) -> DataFrame:
    """One made-up alert to test the alarm: the batch's first table by name, said to be twice its mean."""
    mean = F.when(F.col("records") > 0, F.col("records") / 2.0).otherwise(1.0)
    return batch.orderBy("table_name").limit(1).select(
        "*",
        mean.alias("mean_records"),
        F.lit(FORCED_DEVIATION_PCT).alias("deviation_pct"),
        F.lit("CONTROLLED_TEST").alias("alert_type"),
    )


def verdict_line(batch: DataFrame, alerts: DataFrame, batch_id: str, limit_pct: float = VOLUME_ALERT_PCT) -> DataFrame:
    """One row ``verdict``: the alerting tables with their deviation, or that all is well.

    The list has one entry per table of the batch.
    """
    deviations = alerts.select("table_name", "deviation_pct")
    entry = F.concat("table_name", F.lit(":"), F.format_string("%.2f", F.col("deviation_pct")), F.lit("%"))
    once = batch.select("table_name").join(deviations, "table_name", "left").agg(
        F.count(F.lit(1)).alias("tables"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("deviation_pct").isNotNull(), entry))), ",").alias("alerted"),
    )
    batch_part = F.lit(f"batch_id={batch_id}")
    alarm = F.concat_ws(
        " | ", F.lit("VOLUME_ALERT"), batch_part,
        F.concat(F.lit("tables="), "alerted"), F.lit(f"threshold={limit_pct:.0f}%"),
    )
    fine = F.concat_ws(" | ", F.lit("BRONZE_OK"), batch_part, F.concat(F.lit("tables="), F.col("tables").cast("string")))
    return once.select(F.when(F.col("alerted") != "", alarm).otherwise(fine).alias("verdict"))
