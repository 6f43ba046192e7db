"""Nested study -> flat message -> bronze row. The same plan serves batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.functions import normalize_registry_code
from cohortmill.schemas import CORRUPT, MESSAGE, RAW_STUDY, STUDY_PATHS, UNKNOWN_ID, UNKNOWN_STATUS


def to_messages(studies: DataFrame, unknown_id: str = "quarantine") -> DataFrame:
    """`key`, `value` of each `study`: four flat fields and the study itself.

    A study without an id gets no key, so it is set apart and not merged with
    all others like it; `unknown_id="keep"` files them under one placeholder id.
    A missing status becomes the registry's own word for it.
    """
    if unknown_id not in ("quarantine", "keep"):
        raise ValueError(f"unknown_id must be 'quarantine' or 'keep', not {unknown_id!r}")

    def field(name: str) -> Column:
        return F.col(f"study.{STUDY_PATHS[name]}")

    key = field("nct_id")
    if unknown_id == "keep":
        key = F.coalesce(key, F.lit(UNKNOWN_ID))
    body = F.struct(
        key.alias("nctId"),
        F.coalesce(field("overall_status"), F.lit(UNKNOWN_STATUS)).alias("overallStatus"),
        field("brief_title").alias("briefTitle"),
        field("last_update_post_date").alias("lastUpdatePostDate"),
        F.col("study").alias("raw"),
    )
    return studies.select(key.alias("key"), F.to_json(body).alias("value"))


def unroutable(messages: DataFrame) -> DataFrame:
    """Messages that `publish` counts as failed."""
    return messages.filter(F.col("key").isNull())


def parse_messages(bus: DataFrame, at: Column | None = None) -> DataFrame:
    """Bus rows parsed with the fixed schema, good and bad ones alike.

    `at` is the ingest time, by default now (one instant per batch).

    The parsed fields are unfolded by a generator: a filter on one of them stays
    above it, where a projection would let it sink and parse every text twice.
    """
    at = F.current_timestamp() if at is None else at
    parsed = F.from_json("value", MESSAGE, {"columnNameOfCorruptRecord": CORRUPT})
    return bus.select("value", "timestamp", F.inline(F.array(parsed))).select(
        F.col("nctId").alias("nct_id"),
        F.col("overallStatus").alias("overall_status"),
        F.col("briefTitle").alias("brief_title"),
        F.col("lastUpdatePostDate").alias("last_update_post_date"),
        "raw",
        F.col("timestamp").alias("kafka_timestamp"),
        at.alias("ingest_timestamp"),
        at.cast("date").alias("ingest_date"),
        "value",
        F.col(CORRUPT).isNotNull().alias("is_corrupt"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """Bronze: the parsed rows that have an id."""
    return parsed.filter(F.col("nct_id").isNotNull()).drop("value", "is_corrupt")


def rejected(parsed: DataFrame) -> DataFrame:
    """The other rows, with their text and why they were set apart."""
    return parsed.filter(F.col("nct_id").isNull()).select(
        "value",
        F.when(F.col("is_corrupt"), "unparsable").otherwise("no id").alias("reason"),
        "kafka_timestamp",
        "ingest_timestamp",
        "ingest_date",
    )


def flatten_studies(
    rows: DataFrame,
    study: str | Column = "study",
    keep: list[str] | None = None,
    paths: dict[str, str] = STUDY_PATHS,
    registry_codes: bool = False,
) -> DataFrame:
    """Untyped staging input from nested studies: one column per path.

    Adds the scalar `phase` (all phases of a study joined) and
    `location_country` (its first country). `registry_codes` rewrites codes such
    as `PHASE1` into words first.
    """
    source = F.col(study) if isinstance(study, str) else study
    flat = rows.select(
        *(keep or []), source.alias("_s")
    ).select(*(keep or []), *(F.col(f"_s.{path}").alias(name) for name, path in paths.items()))
    return scalar_fields(flat, registry_codes)


def scalar_fields(flat: DataFrame, registry_codes: bool = False) -> DataFrame:
    """Add `phase` and `location_country`, made of the lists."""
    phases = F.col("phases")
    if registry_codes:
        phases = F.transform(phases, normalize_registry_code)
    return flat.withColumns(
        {
            "phase": F.array_join(phases, "/"),
            "location_country": F.get("location_countries", F.lit(0)),
        }
    ).drop("phases")


def bronze_to_raw_trials(
    bronze: DataFrame, paths: dict[str, str] = STUDY_PATHS, registry_codes: bool = False
) -> DataFrame:
    """Staging input from bronze: every field of the study text bronze carries.

    Fields of the envelope win over those of the text: an envelope has a status
    even if the study has none.
    """
    study = F.from_json("raw", RAW_STUDY)
    rows = bronze.select(
        study.alias("_study"),
        F.col("nct_id").alias("_id"),
        F.col("overall_status").alias("_status"),
        "ingest_date",
        "ingest_timestamp",
    )
    flat = flatten_studies(
        rows, "_study", ["_id", "_status", "ingest_date", "ingest_timestamp"], paths, registry_codes
    )
    return flat.withColumns({"nct_id": F.col("_id"), "overall_status": F.col("_status")}).drop(
        "_id", "_status"
    )
