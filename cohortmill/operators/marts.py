"""Gold marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmill.functions import has_status, open_duration_days, rate_pct
from cohortmill.functions.measures import as_date


def with_outcome(trials: DataFrame, as_of=None) -> DataFrame:
    """Add the study duration and the completed / terminated flags."""
    status = F.col("overall_status")
    return trials.withColumns(
        {
            "study_duration_days": open_duration_days(
                F.col("start_date"), F.col("completion_date"), as_of
            ),
            "is_completed": has_status(status, "completed"),
            "is_terminated": has_status(status, "terminated"),
        }
    )


def categories_per_trial(conditions: DataFrame) -> DataFrame:
    """(trial, category) with its number of condition rows.

    Joining these instead of the bridge itself shrinks the join, and a trial
    that holds a huge share of all conditions is counted on the map side first.
    """
    return conditions.groupBy("nct_id", "condition_category").agg(
        F.count("*").alias("n_conditions")
    )


ENROLLMENT_KEYS = ("phase", "condition_category", "lead_sponsor_class", "location_country")
# What the enrollment mart is made of, by group and enrollment value; all of it can be added and taken away.
ENROLLMENT_COUNTS = ("n", "w", "closed_days", "closed_w", "open_start", "open_w", "completed", "terminated")


COUNTS_SCHEMA = T.StructType(
    [
        *(T.StructField(name, T.StringType()) for name in ENROLLMENT_KEYS),
        T.StructField("enrollment_count", T.IntegerType()),
        *(T.StructField(name, T.LongType()) for name in ENROLLMENT_COUNTS),
    ]
)


def enrollment_counts(trials: DataFrame, conditions: DataFrame, grain: str = "condition") -> DataFrame:
    """Sums by group and enrollment value, of which `enrollment_from_counts` makes the mart of any day.

    Closed studies give their days. Of open ones, whose days grow, their number and the sum of
    their start days is kept. A trial's rows are found from the trial and its conditions alone, so sums of
    changed trials can be added and taken away.
    """
    if grain not in ("condition", "trial"):
        raise ValueError(f"grain must be 'condition' or 'trial', not {grain!r}")
    weight = F.coalesce("n_conditions", F.lit(1).cast("bigint"))
    rows = trials.join(categories_per_trial(conditions), "nct_id", "left").withColumn(
        "w", weight if grain == "condition" else F.lit(1).cast("bigint")
    )
    w, status = F.col("w"), F.col("overall_status")
    start, completion = F.col("start_date"), F.col("completion_date")
    closed = start.isNotNull() & completion.isNotNull()
    opened = start.isNotNull() & completion.isNull()
    zero = F.lit(0).cast("bigint")
    sums = {
        "w": w,
        "closed_days": F.when(closed, F.datediff(completion, start) * w).otherwise(zero),
        "closed_w": F.when(closed, w).otherwise(zero),
        "open_start": F.when(opened, F.unix_date(start) * w).otherwise(zero),
        "open_w": F.when(opened, w).otherwise(zero),
        "completed": has_status(status, "completed") * w,
        "terminated": has_status(status, "terminated") * w,
    }
    return rows.groupBy(*ENROLLMENT_KEYS, "enrollment_count").agg(
        F.count("*").alias("n"), *(F.sum(column).alias(name) for name, column in sums.items())
    )


def add_counts(*parts: DataFrame) -> DataFrame:
    """Sums of the same groups added up."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*ENROLLMENT_KEYS, "enrollment_count").agg(
        *(F.sum(name).alias(name) for name in ENROLLMENT_COUNTS)
    )


def taken_away(counts: DataFrame) -> DataFrame:
    return counts.withColumns({name: -F.col(name) for name in ENROLLMENT_COUNTS})


def enrollment_from_counts(counts: DataFrame, as_of=None) -> DataFrame:
    """The enrollment mart from its counts; the exact median weighs the values of a group."""
    w, enrolled = F.col("w"), F.col("enrollment_count")
    known = F.sum(F.when(enrolled.isNotNull(), w))
    today = F.unix_date(as_date(as_of))
    days = F.sum(F.col("closed_days") + F.col("open_w") * today - F.col("open_start"))
    days_w = F.nullif(F.sum(F.col("closed_w") + F.col("open_w")), F.lit(0).cast("bigint"))
    return counts.filter("n > 0").groupBy(*ENROLLMENT_KEYS).agg(
        F.sum("n").alias("trial_count"),
        F.sum(enrolled * w).alias("total_enrollment"),
        (F.sum(enrolled * w).cast("double") / known.cast("double")).alias("avg_enrollment"),
        F.percentile(enrolled, F.lit(0.5), w).alias("median_enrollment"),
        (days.cast("double") / days_w.cast("double")).alias("avg_duration_days"),
        rate_pct(F.sum("completed"), F.sum(w)).alias("completion_rate_pct"),
        rate_pct(F.sum("terminated"), F.sum(w)).alias("termination_rate_pct"),
    )


def enrollment_mart(
    trials: DataFrame, conditions: DataFrame, as_of=None, grain: str = "condition"
) -> DataFrame:
    """Enrollment by phase, condition category, sponsor class and country.

    `trials` holds one row per trial. At the default grain every condition row
    counts, so a trial with two conditions in a category enters sums, averages,
    median and rates twice (but `trial_count` once); `grain="trial"` counts it
    once everywhere. Trials without a condition stay, under a null category.

    A (trial, category) row weighted by its conditions says the same as the
    condition rows, and is unique. So the distinct count is a plain count, and the
    weighted aggregates combine on the map side. Rows are combined by group and
    enrollment value first, in a hash aggregation that can spill; the exact median then
    weighs the different values of a group.
    """
    return enrollment_from_counts(enrollment_counts(trials, conditions, grain), as_of)


def phase_outcomes_mart(trials: DataFrame) -> DataFrame:
    """Outcomes by phase and sponsor class; each trial counts once.

    Reasons of termination are not ingested, so the split of the unsuccessful
    ends (terminated, withdrawn, suspended) stands in for them.
    """
    status = F.col("overall_status")
    n = F.count("*")

    def share(*wanted):
        return rate_pct(F.sum(has_status(status, *wanted)), n)

    def tally(wanted):
        return F.sum(has_status(status, wanted))

    return trials.groupBy("phase", "lead_sponsor_class").agg(
        n.alias("trial_count"),
        tally("completed").alias("completed_count"),
        tally("terminated").alias("terminated_count"),
        tally("withdrawn").alias("withdrawn_count"),
        tally("suspended").alias("suspended_count"),
        share("completed").alias("completion_rate_pct"),
        share("terminated").alias("termination_rate_pct"),
        share("withdrawn").alias("withdrawal_rate_pct"),
        share("suspended").alias("suspension_rate_pct"),
    )


def trial_countries(trials: DataFrame, keep: list[str]) -> DataFrame:
    """One row per trial and country, with `country` and `is_first`.

    `is_first` marks one row of each trial, so that per-trial measures can be
    summed over the exploded rows. Uses the country array where there is one.
    """
    if "location_countries" in trials.columns:
        countries = F.array_distinct(
            F.coalesce(
                F.transform("location_countries", lambda c: F.trim(c)),
                F.array(F.col("location_country")),
            )
        )
    else:
        countries = F.array("location_country")
    return trials.select(*keep, F.posexplode_outer(countries).alias("_pos", "country")).select(
        *keep, "country", (F.coalesce("_pos", F.lit(0)) == 0).alias("is_first")
    )


def sponsor_activity_mart(trials: DataFrame) -> DataFrame:
    """Volume, geographic reach and success by sponsor.

    `success_rate_pct` is the share of completed among closed trials (completed,
    terminated, withdrawn). Rows combine per (sponsor, country) before they
    reach the sponsor, so one sponsor with a third of all trials is spread out.
    """
    status = F.col("overall_status")
    rows = trial_countries(
        trials.withColumns(
            {
                "_completed": has_status(status, "completed"),
                "_closed": has_status(status, "completed", "terminated", "withdrawn"),
            }
        ),
        ["lead_sponsor_name", "enrollment_count", "_completed", "_closed"],
    )

    def once(column):
        return F.sum(F.when(F.col("is_first"), F.col(column)).otherwise(0))

    return (
        rows.groupBy("lead_sponsor_name", "country")
        .agg(
            F.count_if("is_first").alias("trials"),
            F.sum(F.when(F.col("is_first"), F.col("enrollment_count"))).alias("enrollment"),
            once("_completed").alias("completed"),
            once("_closed").alias("closed"),
        )
        .groupBy("lead_sponsor_name")
        .agg(
            F.sum("trials").alias("trial_count"),
            F.count("country").alias("country_count"),
            F.sum("enrollment").alias("total_enrollment"),
            F.sum("completed").alias("completed_count"),
            rate_pct(F.sum("completed"), F.sum("trials")).alias("completion_rate_pct"),
            rate_pct(F.sum("completed"), F.sum("closed")).alias("success_rate_pct"),
        )
    )
