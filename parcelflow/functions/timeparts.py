"""Dates, times of day and durations as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def time_of_day_sql(column: str) -> str:
    """SQL: the first time of day ``HH:mm:ss`` found in the value, else null; 24:00:00 and the like are none.

    Takes a time as text, as a TIME value or as a timestamp carrying a dummy date.
    """
    return f"try_element_at(regexp_extract_all(CAST({column} AS STRING), '([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]', 0), 1)"


def instant(date: str, time: str) -> Column:
    """Instant of a DATE and a normalised time of day (SQL text each); null when either is missing or is no time."""
    return F.expr(f"try_cast(concat(CAST({date} AS STRING), ' ', {time}) AS TIMESTAMP)")


def combine_ts(date: str, time: str) -> Column:
    """As ``instant``, with the time in any shape ``time_of_day_sql`` takes."""
    return instant(f"CAST({date} AS DATE)", time_of_day_sql(time))


def end_of_day(date: str) -> Column:
    """23:59:59 of the date; null stays null."""
    return F.expr(f"CAST({date} AS TIMESTAMP) + INTERVAL '23:59:59' HOUR TO SECOND")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_seconds(end) - F.unix_seconds(start)


def hours_between(start: Column | str, end: Column | str) -> Column:
    return seconds_between(start, end) / 3600.0


def year_month(date: str, prefix: str) -> list[Column]:
    """The two layout columns of a large table."""
    return [F.year(date).alias(f"{prefix}_year"), F.month(date).alias(f"{prefix}_month")]
