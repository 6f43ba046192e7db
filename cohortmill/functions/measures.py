"""Measures derived from silver columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the feature preparation.
MAX_ENROLLMENT = 100_000
DEFAULT_DURATION_DAYS = 365


def as_date(as_of: dt.date | str | Column | None) -> Column:
    """The day reports are made for; today unless given."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def open_duration_days(start: Column, completion: Column, as_of=None) -> Column:
    """Days from start to completion; an open study runs until `as_of`."""
    return F.datediff(F.coalesce(completion, as_date(as_of)), start)


def has_status(status: Column, *wanted: str) -> Column:
    """1 if the status is one of `wanted`, else 0 (also for a null status)."""
    return F.when(status.isin(*wanted), 1).otherwise(0)


def rate_pct(part: Column, whole: Column) -> Column:
    """`part` as a percentage of `whole`, null for an empty whole."""
    return part.cast("double") * F.lit(100.0) / F.nullif(whole, F.lit(0).cast("bigint"))


def clip_enrollment(enrollment: Column) -> Column:
    return F.least(F.coalesce(enrollment, F.lit(0)), F.lit(MAX_ENROLLMENT))


def fill_duration(days: Column) -> Column:
    return F.coalesce(days, F.lit(DEFAULT_DURATION_DAYS))


def text_or_unknown(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("unknown"))
