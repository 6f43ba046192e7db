"""Counts of different values and percentiles that can be merged: sketches by day, read over any days.

The exact aggregates of the marts need the rows of the whole range. A day's sketches are made once, when the
day is complete, and are of bounded size however many rows it has; those of a range of days, or of coarser
groups, are merged. This is the opt-in form for questions that are asked again and again over changing ranges; the error
is bounded by the parameters, see `distinct_error` and `rank_error`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12  # 4,096 registers
KLL_K = 400
QUARTILES = (0.25, 0.5, 0.75)


def distinct_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """The relative error of a count of different values that is exceeded about once in 370 times (3 deviations)."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def rank_error(k: int = KLL_K) -> float:
    """By how much of all rows the rank of a percentile may be off, in 99 of 100 cases, as the sketch is documented."""
    return 2.296 / k**0.9723


def daily_sketches(
    rows: DataFrame, day: Column, groups: Sequence[str], distinct: str, value: str, lg_k: int = LG_K, k: int = KLL_K
) -> DataFrame:
    """A row for each day and group: `n`, `n_values`, and sketches of `distinct` and `value`. Rows without a day are left out.

    Sketches are built on the map side and merged, so a group with a third of all rows is a row per task.
    """
    days = rows.select(day.alias("day"), *groups, F.col(distinct).alias("_distinct"), F.col(value).cast("double").alias("_value"))
    return days.filter("day IS NOT NULL").groupBy("day", *groups).agg(
        F.count("*").alias("n"),
        F.count("_value").alias("n_values"),
        F.hll_sketch_agg("_distinct", lg_k).alias("distinct_sketch"),
        F.kll_sketch_agg_double("_value", k).alias("value_sketch"),
    )


def over_days(
    sketches: DataFrame, first, last, groups: Sequence[str] = (), quantiles: Sequence[float] = QUARTILES
) -> DataFrame:
    """The days `first` to `last` together, by some of the groups: `n`, `n_distinct`, `quantiles` (null without a value)."""
    merged = (
        sketches.filter(F.col("day").between(F.lit(first), F.lit(last)))
        .groupBy(*groups)
        .agg(
            F.sum("n").alias("n"),
            F.sum("n_values").alias("n_values"),
            F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
            F.kll_merge_agg_double("value_sketch").alias("_values"),
        )
    )
    ranks = F.array(*map(F.lit, map(float, quantiles)))
    found = F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("_values", ranks))
    return merged.withColumn("quantiles", found).drop("_values")
