"""Freshness and volume alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def freshness(
    df: DataFrame, column: str, limit: dt.timedelta, as_of: dt.datetime | Column | None = None
) -> DataFrame:
    """One row: the newest time in `column`, its age, and whether that is within
    the limit. An empty table is not fresh. An `as_of` without a zone is UTC, as
    the session is, whatever zone the driver's machine is in."""
    if as_of is None:
        as_of = F.current_timestamp()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc))
    kind = df.schema[column].dataType
    age = F.timestamp_diff("SECOND", F.col("newest"), as_of.cast(kind))
    seconds = int(limit.total_seconds())
    return df.agg(F.max(column).alias("newest")).select(
        "newest",
        age.alias("age_seconds"),
        F.lit(seconds).cast("bigint").alias("limit_seconds"),
        F.coalesce(age <= seconds, F.lit(False)).alias("success"),
    )


# Days that a day's volume is compared with.
BASELINE_DAYS = 7


def daily_counts(df: DataFrame, day: Column, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Rows per day, with a zero for every day in between that has none."""
    counts = df.select(day.alias("day")).filter("day IS NOT NULL").groupBy("day").agg(F.count("*").alias("n"))
    return without_gaps(counts, first, last)


def without_gaps(counts: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """(day, n) with a zero for every day without a row, from the first that has one (or `first`) to the last (or `last`)."""
    bounds = F.least(F.min("day"), F.lit(first)).alias("a"), F.greatest(F.max("day"), F.lit(last)).alias("b")
    calendar = counts.agg(*bounds).filter("a <= b").select(F.explode(F.sequence("a", "b")).alias("day"))
    return calendar.join(counts, "day", "left").select(
        "day", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )


def volume_anomaly(daily: DataFrame, k: int = BASELINE_DAYS, z: float = 3.0) -> DataFrame:
    """Days whose count is more than `z` standard deviations off the `k` days before.

    Days with less than two days before them have no baseline and raise no alert;
    a constant baseline alerts on any change. The window has no partition: its
    rows are days, a few hundred a year however much the days hold.
    """
    before = Window.orderBy("day").rowsBetween(-k, -1)
    baseline = daily.select(
        "day",
        "n",
        F.avg("n").over(before).alias("mean"),
        F.stddev_samp("n").over(before).alias("spread"),
    )
    return baseline.withColumn(
        "is_anomaly",
        F.coalesce(F.abs(F.col("n") - F.col("mean")) > z * F.col("spread"), F.lit(False)),
    )
