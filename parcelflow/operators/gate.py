"""Quality checks on finished tables, and the gate that stops a run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.functions.joins import lookup


class GateFailed(RuntimeError):
    """At least one quality check failed."""


@dataclass(frozen=True)
class RowCheck:
    """Rows for which ``fails_when`` (SQL) is true are failures."""

    rule: str
    detail: str
    fails_when: str


@dataclass(frozen=True)
class UniqueCheck:
    """Each key held by more than one row is one failure."""

    rule: str
    detail: str


@dataclass(frozen=True)
class ReferenceCheck:
    """Rows whose ``column`` is not a value of ``parent`` are failures."""

    rule: str
    detail: str
    column: str


Check = RowCheck | UniqueCheck | ReferenceCheck

SHIPMENT_CHECKS: tuple[Check, ...] = (
    RowCheck("DQ01_SHIPMENT_ID_NOT_NULL", "shipment_id must be present", "shipment_id IS NULL"),
    UniqueCheck("DQ02_SHIPMENT_ID_UNIQUE", "shipment_id must not repeat"),
    ReferenceCheck("DQ03_DRIVER_EXISTS", "driver_id must be in dim_driver", "driver_id"),
    RowCheck("DQ04_WEIGHT_POSITIVE", "weight_kg > 0", "weight_kg <= 0"),
    RowCheck("DQ05_DATES_COHERENT", "delivered >= received", "delivered_date < received_date"),
)


def check_suite(df: DataFrame, key: str, checks: tuple[Check, ...], parents: dict[str, DataFrame]) -> DataFrame:
    """One row per check: rule, status, failures, detail.

    All checks share one pass over the rows and one aggregation by key;
    ``parents`` maps a referencing column to a table holding it once per value.
    """
    for check in checks:
        if isinstance(check, ReferenceCheck):
            known = parents[check.column].select(check.column, F.lit(True).alias(f"_known_{check.column}"))
            df = lookup(df, known, check.column)

    def fails(check: Check) -> Column:
        if isinstance(check, RowCheck):
            return F.count_if(F.expr(check.fails_when))
        if isinstance(check, ReferenceCheck):
            return F.count_if(F.col(f"_known_{check.column}").isNull())
        return F.count(F.lit(1))

    per_key = df.groupBy(key).agg(*[fails(c).alias(c.rule) for c in checks])
    totals = per_key.agg(
        *[
            (
                F.count_if(F.col(c.rule) > 1)
                if isinstance(c, UniqueCheck)
                else F.coalesce(F.sum(c.rule), F.lit(0))
            ).alias(c.rule)
            for c in checks
        ]
    )
    results = F.array(
        *[
            F.struct(F.lit(c.rule).alias("rule"), F.col(c.rule).alias("failures"), F.lit(c.detail).alias("detail"))
            for c in checks
        ]
    )
    return totals.select(F.inline(results)).select(
        "rule", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL").alias("status"), "failures", "detail"
    )


def dq_results(fact: DataFrame, drivers: DataFrame) -> DataFrame:
    return check_suite(fact, "shipment_id", SHIPMENT_CHECKS, {"driver_id": drivers})


def require_pass(results: DataFrame) -> None:
    """Raise when a stored result is FAIL; to be called after the results are written."""
    failed = results.filter("status = 'FAIL'").count()
    if failed:
        raise GateFailed(f"{failed} quality checks failed")
