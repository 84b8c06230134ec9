"""Arithmetic whose results do not depend on the order in which tasks finish.

A sum of doubles changes in its last digits with the order of the partial sums,
so a re-run on a cluster would not reproduce its own tables. A value is therefore
cut into a decimal of nine places and the small rest, which is counted in units of
2 ** -50; decimals and units are summed exactly and put together at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EXACT = "decimal(31,9)"
UNIT = float(2**50)
#: Larger values do not fit the decimal; they are added as they are, in any order.
LARGEST = 1e22


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero, taking values within 1e-9 of a half as halves."""
    scale = float(10**digits)
    return F.signum(value) * F.floor(F.abs(value) * scale + (0.5 + 1e-9)) / scale + 0.0


def head_sql(value: str) -> str:
    """SQL: the value as a decimal of nine places."""
    return f"try_cast({value} AS {EXACT})"


def rest_sql(value: str) -> str:
    """SQL: what the decimal leaves of the value, in whole units."""
    return f"CAST(floor(({value} - CAST({head_sql(value)} AS DOUBLE)) * {UNIT!r}D + 0.5D) AS BIGINT)"


def exact_sum_sql(value: str) -> str:
    large = f"sum(CASE WHEN abs({value}) >= {LARGEST!r}D THEN {value} END)"
    parts = f"coalesce(CAST(sum({head_sql(value)}) AS DOUBLE), 0D) + coalesce(CAST(sum({rest_sql(value)}) AS DOUBLE), 0D) / {UNIT!r}D"
    return f"CASE WHEN count({value}) > 0 THEN {parts} + coalesce({large}, 0D) END"


def exact_sum(value: str) -> Column:
    """Order-independent sum of a double column, as double."""
    return F.expr(exact_sum_sql(value))


def exact_mean(value: str) -> Column:
    """Order-independent mean of the non-null values of a double column."""
    # try_divide: no values at all give null, not an error
    return F.expr(f"try_divide({exact_sum_sql(value)}, count({value}))")


def share(condition: str) -> Column:
    """Fraction of rows for which the SQL condition is true; unknown counts as false."""
    return F.expr(f"avg(CASE WHEN {condition} THEN 1 ELSE 0 END)")


def weighted_score(weights: dict[str, float], digits: int) -> Column:
    terms = " + ".join(f"{name} * {weight!r}D" for name, weight in weights.items())
    return half_up(F.expr(terms), digits)
