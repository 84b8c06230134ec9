"""Judging the raw rows of a table: one verdict per business key.

All cleaning decisions of a table come out of one aggregation by key. The
verdict holds the surviving row and what is needed to report everything that was
wrong with the copies of that key:

``_copies``        raw rows with this key
``_missing``       of these, rows lacking a required column
``_invalid``       of these, rows with a value that does not fit its type
``_survives``      whether a row is left after these checks; its columns follow
``_broken_ref``    finding name of the first reference without parent, or null
``_broken_rules``  names of the broken business rules

Rows are brought together by key in one shuffle and sorted after it, once. Keys that
hold much of the rows are the exception: tasks combine their copies before the
shuffle, so a key with very many copies costs no more than any other. Which keys these
are is told by counting the rows in a fixed number of buckets of keys (``busy_buckets``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelflow.functions.joins import lookup
from parcelflow.functions.rows import repeat_rows
from parcelflow.functions.timeparts import time_of_day_sql
from parcelflow.model import INGEST_COLUMNS, WHOLE_DIGITS, Contract

VERDICT_COLUMNS = ["_copies", "_missing", "_invalid", "_survives", "_broken_ref", "_broken_rules"]


def _always_converts(source: str, kind: str) -> bool:
    if kind == "timestamp":
        return source in ("date", "timestamp", "timestamp_ntz")
    return kind in ("string", source)


def typed(raw: DataFrame, contract: Contract) -> DataFrame:
    """The declared columns in their declared types, with the checks of the row.

    ``_bad`` names the columns that did not convert, or not to a time of day or a number of WHOLE_DIGITS digits;
    their values are null. ``_lacks`` tells whether a required value is absent. Undeclared columns do not pass; declared ones that
    the input lacks are null. Ingest columns are kept where present.
    """
    have = dict(raw.dtypes)
    wanted = contract.types | {c: t for c, t in INGEST_COLUMNS.items() if c in have}
    columns, bad = [], []
    for name, kind in wanted.items():
        if name not in have:
            columns.append(f"CAST(NULL AS {'string' if kind == 'time' else kind}) AS {name}")
        elif kind == "time":
            columns.append(f"{time_of_day_sql(name)} AS {name}")
            bad.append(f"CASE WHEN {name} IS NOT NULL AND {time_of_day_sql(name)} IS NULL THEN '{name}' END")
        elif kind == "double":
            # NaN counts as larger than any number
            finite = f"CASE WHEN abs(try_cast({name} AS DOUBLE)) < 1e{WHOLE_DIGITS}D THEN try_cast({name} AS DOUBLE) END"
            columns.append(f"{finite} AS {name}")
            bad.append(f"CASE WHEN {name} IS NOT NULL AND {finite} IS NULL THEN '{name}' END")
        elif have[name] == kind:
            columns.append(name)
        elif _always_converts(have[name], kind):
            columns.append(f"CAST({name} AS {kind}) AS {name}")
        else:
            columns.append(f"try_cast({name} AS {kind}) AS {name}")
            bad.append(f"CASE WHEN {name} IS NOT NULL AND try_cast({name} AS {kind}) IS NULL THEN '{name}' END")
    failed = f"array_compact(array({', '.join(bad)}))" if bad else "CAST(array() AS array<string>)"
    # a value that does not convert is invalid, not absent
    absent = " OR ".join(f"{c} IS NULL" if c in have else "true" for c in contract.required)
    return raw.selectExpr(*columns, f"{failed} AS _bad", f"({absent}) AS _lacks")


def newest_first(newest_by: str, columns: list[str], side: str = "") -> str:
    """SQL sort value: newest instant first (unknown last), then all columns ascending, nulls first."""
    return f"struct(coalesce(-unix_micros({side}{newest_by}), {2**63 - 1}) AS _age, {', '.join(side + c for c in columns)})"


# Keys fall into this many buckets by their hash. A bucket is busy with this many times the mean of rows, if they are
# more than the fewest that matter; so busy buckets are few, and each other key holds a small part of a task's rows.
BUCKETS = 1 << 16
BUSY_TIMES = 4
BUSY_ROWS = 10_000


def _bucket(contract: Contract) -> Column:
    return F.pmod(F.xxhash64(contract.key), F.lit(BUCKETS)).alias("_bucket")


def busy_buckets(raw: DataFrame, contract: Contract, least: int = BUSY_ROWS) -> DataFrame:
    """``_bucket``: those that hold far more rows than the others. Of the raw rows only the key is read."""
    counted = typed(raw, contract).select(_bucket(contract)).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    # the window without partition sees one row per bucket
    total = F.sum("_rows").over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("_total", total).filter(f"_rows > {least} AND _rows * {BUCKETS // BUSY_TIMES} > _total").select("_bucket")


def judge(raw: DataFrame, contract: Contract) -> DataFrame:
    """Verdict per key after the required-field, type and duplicate checks; each task combines the copies it meets."""
    return _verdicts(_checked(raw, contract), contract)


def judge_spread(raw: DataFrame, contract: Contract, busy: DataFrame | None = None) -> DataFrame:
    """As ``judge``, but rows are sorted only after the shuffle, save those of the busy buckets, if there are any."""
    rows = _checked(raw, contract)
    if busy is None:
        return _verdicts(rows.repartition(contract.key), contract)
    dealt = rows.withColumn("_bucket", _bucket(contract))
    calm = dealt.join(busy, "_bucket", "left_anti").drop("_bucket").repartition(contract.key)
    combined = dealt.join(busy, "_bucket", "left_semi").drop("_bucket")
    return _verdicts(calm, contract).unionByName(_verdicts(combined, contract))


def _checked(raw: DataFrame, contract: Contract) -> DataFrame:
    """Typed rows with ``_lacks`` and ``_off``: whether a value did not fit its type."""
    return typed(raw, contract).withColumn("_off", F.expr("size(_bad) > 0")).drop("_bad")


def _verdicts(rows: DataFrame, contract: Contract) -> DataFrame:
    payload = [c for c in rows.columns if c not in (contract.key, "_off", "_lacks")]
    sound = f"CASE WHEN NOT _lacks AND NOT _off THEN {newest_first(contract.newest_by, payload)} END"
    grouped = rows.groupBy(contract.key).agg(
        F.expr("count(1) AS _copies"),
        F.expr("count_if(_lacks) AS _missing"),
        F.expr("count_if(_off) AS _invalid"),
        F.expr(f"min({sound}) AS _row"),
    )
    return grouped.selectExpr(
        contract.key, *[f"_row.{c}" for c in payload], "_copies", "_missing", "_invalid", "_row IS NOT NULL AS _survives"
    )


def merge(stored: DataFrame, new: DataFrame, contract: Contract) -> DataFrame:
    """Verdicts of all rows from those of earlier rows and those of new rows, as ``judge`` gives them.

    Counts add up, and of two surviving rows the newer stays, by the order that ``judge`` has; so the result is that
    of judging all rows together. The rows themselves are not read again. Columns that one side lacks are null there.
    """
    key = contract.key
    checks = ["_copies", "_missing", "_invalid", "_survives"]
    names = [c for c in (*new.columns, *stored.columns) if c not in (key, *checks)]
    payload = list(dict.fromkeys(names))
    kinds = dict(stored.dtypes) | dict(new.dtypes)

    def side(verdicts: DataFrame, name: str) -> DataFrame:
        have = [c if c in verdicts.columns else f"CAST(NULL AS {kinds[c]}) AS {c}" for c in payload]
        return verdicts.selectExpr(key, *have, *checks).alias(name)

    newer = (
        f"n._survives AND (s._survives IS NULL OR NOT s._survives OR "
        f"{newest_first(contract.newest_by, payload, 'n.')} < {newest_first(contract.newest_by, payload, 's.')})"
    )

    def met(one: DataFrame, other: DataFrame, on: str) -> DataFrame:
        # the key is null on the side that lacks it, and on both for rows without a key
        return side(one, "s").join(side(other, "n"), F.expr(on), "full").selectExpr(
            f"coalesce(s.{key}, n.{key}) AS {key}",
            *[f"CASE WHEN coalesce({newer}, false) THEN n.{c} ELSE s.{c} END AS {c}" for c in payload],
            *[f"coalesce(s.{c}, 0L) + coalesce(n.{c}, 0L) AS {c}" for c in checks[:3]],
            "coalesce(s._survives, false) OR coalesce(n._survives, false) AS _survives",
        )

    # The new verdicts lie by key already, as an equal key wants them; a null-safe one would have them moved and sorted again.
    keyed, keyless = f"{key} IS NOT NULL", f"{key} IS NULL"
    known = met(stored.filter(keyed), new.filter(keyed), f"s.{key} = n.{key}")
    return known.unionByName(met(stored.filter(keyless), new.filter(keyless), f"s.{key} <=> n.{key}"))


def check_references(verdicts: DataFrame, contract: Contract, parents: dict[str, DataFrame]) -> DataFrame:
    """Add ``_broken_ref``: the first declared reference whose parent is absent.

    ``parents`` maps a table to its key column (one row per key), already closed
    under its own references, so that removals cascade.
    """
    found = verdicts
    steps = []
    for ref in contract.references:
        hit = f"_has_{ref.column}"
        parent = parents[ref.parent]
        keys = parent.selectExpr(f"{parent.columns[0]} AS {ref.column}", f"true AS {hit}")
        found = lookup(found, keys, ref.column)
        steps.append(f"WHEN {hit} IS NULL THEN 'FK_INVALID_{ref.column}'")
    broken = f"CASE WHEN NOT _survives THEN NULL {' '.join(steps)} END" if steps else "CAST(NULL AS STRING)"
    return found.selectExpr(*verdicts.columns, f"{broken} AS _broken_ref")


def check_rules(verdicts: DataFrame, contract: Contract) -> DataFrame:
    """Add ``_broken_rules``; the rules look only at rows that passed all earlier checks."""
    passed = "_survives AND _broken_ref IS NULL"
    names = ", ".join(f"CASE WHEN {passed} AND {r.breaks_when} THEN '{r.name}' END" for r in contract.rules)
    return verdicts.selectExpr("*", f"array_compact(CAST(array({names}) AS array<string>)) AS _broken_rules")


# A surviving row has a key. Filters that say so reach the scan, and give all plans built on
# the cleaned rows of a table the same scan and shuffle, which Spark then runs only once.


def closed(verdicts: DataFrame, contract: Contract) -> DataFrame:
    """Rows whose references hold, business rules not yet applied."""
    return verdicts.filter(f"{contract.key} IS NOT NULL AND _survives AND _broken_ref IS NULL")


def closed_keys(verdicts: DataFrame, contract: Contract) -> DataFrame:
    """Keys that may be referenced."""
    return closed(verdicts, contract).select(contract.key)


ACCEPTED = "(_survives AND _broken_ref IS NULL AND size(_broken_rules) = 0)"


def survivors(verdicts: DataFrame) -> DataFrame:
    """Rows left after required-field, type and duplicate checks."""
    return verdicts.filter("_survives").drop(*VERDICT_COLUMNS)


def findings(verdicts: DataFrame, contract: Contract) -> DataFrame:
    """Every violation as a row: table_name, record_key, rule, ordinal.

    A key held by several rows is one finding per copy; a row breaking two rules
    is two findings (and one rejection).
    """

    spotless = (
        "_copies = 1 AND _missing = 0 AND _invalid = 0 AND _broken_ref IS NULL AND size(_broken_rules) = 0"
    )
    per_key = (
        verdicts.filter(f"NOT ({spotless})")
        .selectExpr(
            f"CAST({contract.key} AS STRING) AS record_key",
            f"""inline(concat(
                array(struct('REQUIRED_NULL' AS rule, _missing AS times),
                      struct('TYPE_INVALID' AS rule, _invalid AS times),
                      struct('DUPLICATE_KEY' AS rule,
                             CASE WHEN {contract.key} IS NOT NULL AND _copies > 1 THEN _copies END AS times),
                      struct(_broken_ref AS rule, CASE WHEN _broken_ref IS NOT NULL THEN 1L END AS times)),
                transform(_broken_rules, name -> struct(name AS rule, 1L AS times))))""",
        )
        .select(F.lit(contract.table).alias("table_name"), "record_key", "rule", "times")
    )
    return repeat_rows(per_key, "times", "ordinal", ["record_key", "rule"])


def quarantine(found: DataFrame, batch_id: str) -> DataFrame:
    """Findings as quarantine rows; the payload holds the key and nothing else of the record."""
    return found.select(
        F.sha2(F.concat_ws("/", F.lit(batch_id), "table_name", "rule", "record_key", "ordinal"), 256).alias("finding_id"),
        F.lit(batch_id).alias("batch_id"),
        "table_name",
        "record_key",
        "rule",
        F.to_json(F.struct("record_key")).alias("payload"),
    )
