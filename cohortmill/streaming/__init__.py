"""Structured Streaming jobs."""

from cohortmill.streaming.bronze import drop_repeats, start_bronze, start_rejects
from cohortmill.streaming.quality import SuiteWatch
from cohortmill.streaming.silver import read_silver, rebucket_silver, start_silver, upsert_silver
from cohortmill.streaming.volume import daily_volume, start_daily_volume

__all__ = [
    "SuiteWatch",
    "daily_volume",
    "drop_repeats",
    "read_silver",
    "rebucket_silver",
    "start_bronze",
    "start_daily_volume",
    "start_rejects",
    "start_silver",
    "upsert_silver",
]
