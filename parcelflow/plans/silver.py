"""From raw tables to cleaned tables.

The plans are lazy, but the buckets of keys that hold much of a table are written to a scratch folder first, because
the plan depends on whether there are any.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial

from pyspark.sql import DataFrame, functions as F

from parcelflow.model import CONTRACTS, Contract
from parcelflow.operators import cleanse, verdicts as v
from parcelflow.plans.together import shuffles_dropped, together
from parcelflow.sources import layers


def judge_own(raw: DataFrame, contract: Contract, folder: str | None = None) -> DataFrame:
    """Verdicts of a table's own rows; its busy buckets are written first, by default to a scratch folder."""
    folder = folder or layers.scratch_folder(raw.sparkSession, f"busy-{contract.table}")
    busy = layers.overwrite(v.busy_buckets(raw, contract), folder)
    return v.judge_spread(raw, contract, None if busy.isEmpty() else busy)


def judge_table(raw: DataFrame, contract: Contract, parents: dict[str, DataFrame]) -> DataFrame:
    """All checks of one table, its columns already imputed and masked."""
    return complete(judge_own(raw, contract), contract, parents)


def complete(verdicts: DataFrame, contract: Contract, parents: dict[str, DataFrame]) -> DataFrame:
    """The checks against other tables and the business rules on the verdicts of a table's own rows."""
    referenced = v.check_references(verdicts, contract, parents)
    return cleanse.finish(v.check_rules(referenced, contract), contract)


def with_parents(tables: Iterable[str]) -> list[str]:
    """The tables and all they refer to, parents first."""
    needed = set(tables)
    for contract in reversed(CONTRACTS.values()):
        if contract.table in needed:
            needed |= {ref.parent for ref in contract.references}
    return [t for t in CONTRACTS if t in needed]


def waves(tables: Iterable[str]) -> list[list[str]]:
    """The tables in groups, each of which refers to earlier groups only."""
    left = with_parents(tables)
    groups: list[list[str]] = []
    while left:
        groups.append([t for t in left if not {r.parent for r in CONTRACTS[t].references} & set(left)])
        left = [t for t in left if t not in groups[-1]]
    return groups


def judge_all(
    raw: dict[str, DataFrame], only: Iterable[str] | None = None, written: bool = False, payload: bool = True
) -> dict[str, DataFrame]:
    """Verdicts of the given tables, parents first; ``only`` leaves out what is not asked for.

    With ``written``, the verdicts of a table that another one refers to are written once and read back by all that use
    them: findings and reports take all rows, references only those with a key, so that Spark would judge the table for
    each. Without ``payload`` verdicts hold the key and the checks alone, which is all that findings need.
    """
    names = with_parents(raw if only is None else only)
    parents = {ref.parent for t in names for ref in CONTRACTS[t].references}
    judged: dict[str, DataFrame] = {}
    keys: dict[str, DataFrame] = {}

    def judge(table: str) -> DataFrame:
        contract = CONTRACTS[table]
        verdict = judge_table(raw[table], contract, keys)
        if not payload:
            verdict = verdict.select(contract.key, *v.VERDICT_COLUMNS)
        if not written or table not in parents:
            return verdict
        return layers.overwrite(verdict, layers.scratch_folder(verdict.sparkSession, f"judged-{table}"))

    for wave in waves(names):
        done = together(raw[wave[0]].sparkSession, {t: partial(judge, t) for t in wave})
        judged |= done
        keys |= {t: v.closed_keys(df, CONTRACTS[t]) for t, df in done.items()}
    return {t: judged[t] for t in names}


def clean(judged: DataFrame, contract: Contract) -> DataFrame:
    """The cleaned table of a verdict table."""
    return judged.filter(f"{contract.key} IS NOT NULL AND {v.ACCEPTED}").select(*cleanse.clean_columns(judged, contract))


def silver(raw: dict[str, DataFrame], *tables: str) -> dict[str, DataFrame]:
    """Cleaned tables (all, or those named)."""
    names = tables or tuple(raw)
    judged = judge_all(raw, names)
    return {t: clean(judged[t], CONTRACTS[t]) for t in judged if t in names}


def silver_in_steps(raw: dict[str, DataFrame], *tables: str) -> dict[str, DataFrame]:
    """As ``silver``, from written steps: one table after the other, its own checks before those against other tables.

    Each step leaves its rows in a scratch folder and no shuffle files, so that the disk holds the shuffles of one step
    of one table at a time. Of the rows only those with whole references are kept, which others may refer to.
    """
    keys: dict[str, DataFrame] = {}
    cleaned: dict[str, DataFrame] = {}
    for table in with_parents(tables or raw):
        contract, spark = CONTRACTS[table], raw[table].sparkSession
        with shuffles_dropped(spark):
            verdict = judge_own(raw[table], contract)
            if contract.references:
                verdict = layers.overwrite(verdict, layers.scratch_folder(spark, f"own-{table}"))
            closed = v.closed(complete(verdict, contract, keys), contract).withColumn("accepted", F.expr(v.ACCEPTED))
            kept = closed.select(*cleanse.clean_columns(closed, contract), "accepted")
            written = layers.overwrite(kept, layers.scratch_folder(spark, f"closed-{table}"))
        keys[table] = written.select(contract.key)
        cleaned[table] = written.filter("accepted").drop("accepted")
    return {t: cleaned[t] for t in tables or raw}


def all_findings(judged: dict[str, DataFrame]) -> DataFrame:
    parts = [v.findings(df, CONTRACTS[table]) for table, df in judged.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
