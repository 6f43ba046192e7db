"""Business reports over silver and the condition bridge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.functions import rate_pct
from cohortmill.operators.marts import categories_per_trial, trial_countries, with_outcome


def top(df: DataFrame, by: list[str | Column], k: int) -> DataFrame:
    """The first `k` rows in the given order; every task keeps only its best `k`."""
    return df.orderBy(*by).limit(k)


def dropout_by_area(trials: DataFrame, conditions: DataFrame, k: int = 10) -> DataFrame:
    """Therapeutic areas by share of terminated trials, highest first."""
    areas = (
        with_outcome(trials)
        .join(categories_per_trial(conditions), "nct_id")
        .filter(F.col("condition_category").isNotNull())
        .groupBy("condition_category")
        .agg(
            F.count("*").alias("trial_count"),
            F.sum("is_terminated").alias("terminated_count"),
            rate_pct(F.sum("is_terminated"), F.count("*")).alias("dropout_rate_pct"),
        )
    )
    return top(areas, [F.desc("dropout_rate_pct"), F.asc("condition_category")], k)


def timeline_percentiles(trials: DataFrame, as_of=None, accuracy: int | None = None) -> DataFrame:
    """Quartiles of study duration by phase and sponsor class.

    Exact by default: trials are counted by group and number of days first, in a hash
    aggregation that can spill, and the quartiles weigh these counts. With an
    `accuracy` each quartile is a value whose rank is off by a share of 1 / accuracy of
    the group at most, from one sketch per group.
    """
    keys, shares = ["phase", "lead_sponsor_class"], [0.25, 0.5, 0.75]
    days = F.col("study_duration_days")
    known = with_outcome(trials, as_of).filter(days.isNotNull())
    if accuracy is None:
        by_days = known.groupBy(*keys, days).agg(F.count("*").alias("n"))
        found = by_days.groupBy(*keys).agg(
            F.sum("n").alias("trial_count"), F.percentile(days, shares, F.col("n")).alias("q")
        )
    else:
        found = known.groupBy(*keys).agg(
            F.count("*").alias("trial_count"),
            F.percentile_approx(days.cast("double"), shares, accuracy).alias("q"),
        )
    return found.select(
        *keys, "trial_count", *(F.col("q")[i].alias(f"p{int(100 * share)}_days") for i, share in enumerate(shares))
    )


def design_completion(trials: DataFrame, as_of=None) -> DataFrame:
    """Completion by study type and phase."""
    return (
        with_outcome(trials, as_of)
        .groupBy("study_type", "phase")
        .agg(
            F.count("*").alias("trial_count"),
            F.sum("is_completed").alias("completed_count"),
            rate_pct(F.sum("is_completed"), F.count("*")).alias("completion_rate_pct"),
        )
    )


def trials_by_country(trials: DataFrame) -> DataFrame:
    """Trials and enrollment by country; a trial counts once in each of its countries."""
    return (
        trial_countries(trials, ["overall_status", "enrollment_count"])
        .filter(F.col("country").isNotNull())
        .groupBy("country")
        .agg(
            F.count("*").alias("trial_count"),
            F.count_if(F.col("overall_status") == "recruiting").alias("recruiting_count"),
            F.sum("enrollment_count").alias("total_enrollment"),
        )
    )


def geo_gaps(
    trials: DataFrame,
    conditions: DataFrame,
    countries: DataFrame,
    category: str = "condition_category",
    min_trials: int = 1,
) -> DataFrame:
    """Countries with fewer than `min_trials` trials in a category that is studied
    elsewhere in their region.

    `countries` lists (country, region), repeats counting once; one region for all makes
    every country expected for every category. A category of a region is expanded to that
    region's countries by a join with the list, so the result is all that grows.
    """
    places = countries.select("country", "region").filter("country is not null").distinct()
    seen = (
        trial_countries(trials, ["nct_id"])
        .filter(F.col("country").isNotNull())
        .join(
            conditions.filter(F.col(category).isNotNull()).select("nct_id", category).distinct(),
            "nct_id",
        )
        .groupBy(category, "country")
        .agg(F.count("*").alias("trial_count"))
    )
    active = seen.join(places, "country").select(category, "region").distinct()
    return (
        active.join(places, "region")
        .join(seen, [category, "country"], "left")
        .select(category, "region", "country", F.coalesce("trial_count", F.lit(0).cast("bigint")).alias("trial_count"))
        .filter(F.col("trial_count") < min_trials)
    )
