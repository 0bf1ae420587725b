"""Times: everything is UTC, and event time is the transaction timestamp only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardflow.schema import DAYS_PER_YEAR, MESSAGE_TIME_FORMAT


def utc_timestamp(text: Column, pattern: str) -> Column:
    """Zone-less text read as UTC whatever the session zone; null if it does not parse."""
    return F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit(pattern + "X"))


def message_timestamp(text: Column) -> Column:
    return utc_timestamp(text, MESSAGE_TIME_FORMAT)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970, floored. Zone-less timestamps are taken in the session zone."""
    return ts.cast("timestamp").cast("long")


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def weekday(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def age_years(ts: Column, birth_date: Column) -> Column:
    """Whole days lived over the mean year length."""
    return F.datediff(ts, birth_date) / F.lit(DAYS_PER_YEAR)
