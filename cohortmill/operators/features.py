"""Feature tables: selection, filling, label codes, stratified split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortmill.functions import clip_enrollment, fill_duration, text_or_unknown
from cohortmill.operators.joins import measured
from cohortmill.operators.marts import categories_per_trial, with_outcome
from cohortmill.schemas import CLOSED_STATUSES

# --- fixed values: the model's inputs ------------------------------------------
FEATURES = [
    "phase",
    "lead_sponsor_class",
    "location_country",
    "enrollment_count",
    "study_duration_days",
    "sex",
    "healthy_volunteers",
]
TARGET = "is_completed"
# --- end of fixed values ---------------------------------------------------------
CATEGORICAL = ["phase", "lead_sponsor_class", "location_country", "sex", "healthy_volunteers"]
# What trial-grain rows add to them.
TRIAL_FEATURES = FEATURES + ["condition_category", "n_conditions", "n_categories", "n_countries"]
TRIAL_CATEGORICAL = CATEGORICAL + ["condition_category"]
MART_KEYS = ["phase", "condition_category", "lead_sponsor_class", "location_country"]


def mart_features(mart: DataFrame) -> DataFrame:
    """Group-grain features of the enrollment mart.

    The mart has no count of one trial, so its average stands for the
    enrollment; sex and volunteers are not among its keys and are constant.
    """
    return mart.filter(
        F.col("avg_enrollment").isNotNull() & F.col("avg_duration_days").isNotNull()
    ).select(
        *MART_KEYS,
        F.col("avg_enrollment").alias("enrollment_count"),
        F.col("avg_duration_days").alias("study_duration_days"),
        F.lit("all").alias("sex"),
        F.lit("no").alias("healthy_volunteers"),
        F.when(F.col("completion_rate_pct") > 50, 1).otherwise(0).alias(TARGET),
    )


def trial_features(
    trials: DataFrame, conditions: DataFrame, as_of=None, open_trials: bool = False
) -> DataFrame:
    """One row per closed trial, with the trial's own outcome as target.

    Open trials have no outcome yet and are left out; with `open_trials` there are only these, their
    target null. No feature is made from the status.
    """
    closed = F.coalesce(F.col("overall_status").isin(*CLOSED_STATUSES), F.lit(False))
    summary = (
        categories_per_trial(conditions)
        .groupBy("nct_id")
        .agg(
            F.min("condition_category").alias("condition_category"),
            F.sum("n_conditions").alias("n_conditions"),
            F.count("condition_category").alias("n_categories"),
        )
    )
    if "location_countries" in trials.columns:
        n_countries = F.coalesce(F.size(F.array_distinct("location_countries")), F.lit(0))
    else:
        n_countries = F.when(F.col("location_country").isNotNull(), 1).otherwise(0)
    zero = F.lit(0).cast("bigint")
    return (
        with_outcome(trials.filter(~closed if open_trials else closed), as_of)
        .withColumn(TARGET, F.lit(None).cast("int") if open_trials else F.col(TARGET))
        .withColumn("n_countries", n_countries)
        .join(summary, "nct_id", "left")
        .select(
            "nct_id",
            *FEATURES,
            "condition_category",
            F.coalesce("n_conditions", zero).alias("n_conditions"),
            F.coalesce("n_categories", zero).alias("n_categories"),
            "n_countries",
            TARGET,
        )
    )


def fill_features(df: DataFrame, categorical: list[str] = CATEGORICAL) -> DataFrame:
    """No nulls, enrollment clipped, categories as text."""
    return df.withColumns(
        {
            "enrollment_count": clip_enrollment(F.col("enrollment_count")),
            "study_duration_days": fill_duration(F.col("study_duration_days")),
            **{c: text_or_unknown(F.col(c)) for c in categorical},
        }
    )


def write_label_codes(df: DataFrame, columns: list[str], path: str) -> DataFrame:
    """Number the sorted values of each column from 0; (`feature`, `value`, `code`).

    Written to `path` beside the model, to score new rows with the same codes.
    The values are sorted by all tasks together. A row's number in its task and
    the sizes of the tasks before it give its place, so no task holds a column's
    values whole.
    """
    spark = df.sparkSession
    pairs = F.array(
        *(F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns)
    )
    ordered = df.select(F.inline(pairs)).distinct().orderBy("feature", "value")
    # Written before it is read twice: both reads must see the same places.
    ordered.withColumn("place", F.monotonically_increasing_id()).write.mode("overwrite").parquet(
        f"{path}/places"
    )
    places = spark.read.parquet(f"{path}/places").withColumn(
        "task", F.shiftright("place", 33)
    )
    # One row per task of the sort.
    sizes = places.groupBy("task").agg(F.count("*").alias("size"))
    starts = sizes.select(
        "task",
        (F.sum("size").over(Window.orderBy("task")) - F.col("size")).alias("start"),
    )
    ranked = places.join(starts, "task").select(
        "feature", "value", (F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("rank")
    )
    first = ranked.groupBy("feature").agg(F.min("rank").alias("first"))
    codes = ranked.join(first, "feature").select(
        "feature", "value", (F.col("rank") - F.col("first")).cast("int").alias("code")
    )
    codes.write.mode("overwrite").parquet(f"{path}/codes")
    return read_label_codes(spark, path)


def read_label_codes(spark, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/codes")


def encode_labels(df: DataFrame, codes: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each column by its code, -1 for a value without one.

    The codes are a file, so Spark knows their size: it broadcasts them while
    they are small and falls back to a skew-splitting join when they are not.
    """
    for column in columns:
        lookup = codes.filter(F.col("feature") == column).select(
            F.col("value").alias(column), F.col("code").alias("_code")
        )
        df = (
            df.join(lookup, column, "left")
            .withColumn(column, F.coalesce("_code", F.lit(-1)))
            .drop("_code")
        )
    return df


def stratified_split(
    df: DataFrame, key: list[str], label: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add `is_train`: of every label exactly round(n * test_share) rows are test.

    Rows are ordered by a digest of key and seed, and the first ones of a label
    train. So the split depends neither on row order nor on partitioning. The
    digest where a label is cut is found without sorting the label: counts per
    digest prefix (at most 65,536 per label) tell the prefix the cut falls in,
    and only the rows with that prefix are ranked.
    """
    digest = F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in key), F.lit(str(seed))))
    rows = df.withColumn("_digest", digest)
    coded = rows.select(label, "_digest", F.substring("_digest", 1, 4).alias("prefix"))
    counts = coded.groupBy(label, "prefix").agg(F.count("*").alias("n"))
    whole = Window.partitionBy(label)
    total = F.sum("n").over(whole)
    cuts = (
        counts.select(
            label,
            "prefix",
            (F.sum("n").over(whole.orderBy("prefix")) - F.col("n")).alias("before"),
            F.col("n"),
            (total - F.floor(total * test_share + 0.5)).alias("n_train"),
        )
        .filter((F.col("before") < F.col("n_train")) & (F.col("n_train") <= F.col("before") + F.col("n")))
        .select(label, "prefix", (F.col("n_train") - F.col("before")).alias("rank"))
    )
    edge = (
        coded.join(measured(cuts), [label, "prefix"])
        .withColumn("r", F.row_number().over(Window.partitionBy(label).orderBy("_digest")))
        .filter(F.col("r") == F.col("rank"))
        .select(label, F.col("_digest").alias("_last"))
    )
    return (
        rows.join(measured(edge), label, "left")
        .withColumn("is_train", F.coalesce(F.col("_digest") <= F.col("_last"), F.lit(False)))
        .drop("_digest", "_last")
    )
