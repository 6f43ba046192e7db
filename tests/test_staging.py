from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortmill.operators import staging
from cohortmill.schemas import SILVER_COLUMNS

D = dt.date
VERSION = "k string, updated date, ingested int, status string"


def raw_trials(spark, records):
    """Raw trial rows; fields not given are null."""
    schema = ", ".join(
        f"{c} {'date' if c == 'ingest_date' else 'timestamp' if c == 'ingest_timestamp' else 'string'}"
        for c in SILVER_COLUMNS
    )
    return spark.createDataFrame([tuple(r.get(c) for c in SILVER_COLUMNS) for r in records], schema)


def newest(spark, records, **options):
    df = spark.createDataFrame(records, VERSION)
    got = staging.latest_version(df, "k", ["updated", "ingested"], **options)
    return [tuple(r) for r in got.orderBy("k").collect()]


def test_newest_version_wins_then_latest_ingest(spark):
    assert newest(
        spark,
        [
            ("a", D(2024, 1, 1), 9, "old"),
            ("a", D(2024, 1, 2), 1, "early"),
            ("a", D(2024, 1, 2), 2, "late"),
            ("b", None, 5, "undated"),
            ("b", D(2020, 1, 1), 1, "dated"),
        ],
    ) == [("a", D(2024, 1, 2), 2, "late"), ("b", D(2020, 1, 1), 1, "dated")]


def test_null_placement_is_an_option(spark):
    records = [("b", None, 5, "undated"), ("b", D(2020, 1, 1), 1, "dated")]
    assert newest(spark, records, nulls="first") == [("b", None, 5, "undated")]
    with pytest.raises(ValueError):
        newest(spark, records, nulls="middle")


def test_result_does_not_depend_on_input_order(spark):
    rng = random.Random(3)
    records = [
        (f"k{rng.randrange(5)}", rng.choice([None, D(2024, 1, 1), D(2024, 1, 2)]), rng.randrange(2), rng.choice("xyz"))
        for _ in range(200)
    ]
    want = newest(spark, records)
    for _ in range(3):
        rng.shuffle(records)
        assert newest(spark, records) == want
    assert len(want) == len({r[0] for r in records})


def test_hot_key_is_cut_before_the_shuffle(spark, plan):
    df = spark.range(1000).select(
        F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("updated"), F.col("id").alias("ingested")
    )
    text = plan(staging.latest_version(df, "k", ["updated", "ingested"]))
    before, after = text.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_status_filter_runs_before_dedup(spark, rows):
    raw = raw_trials(
        spark,
        [
            {"nct_id": "N1", "overall_status": " Completed ", "last_update_post_date": "2024-01-01"},
            {"nct_id": "N1", "overall_status": None, "last_update_post_date": "2024-02-01"},
            {"nct_id": None, "overall_status": "Recruiting"},
        ],
    )
    assert rows(staging.stage_trials(raw), "nct_id", "overall_status") == [("N1", "completed")]


def test_types_and_cleaning(spark):
    raw = raw_trials(
        spark,
        [
            {
                "nct_id": "N1",
                "overall_status": "TERMINATED",
                "study_type": " Interventional",
                "phase": "Phase 2 ",
                "start_date": "2024-01",
                "completion_date": "2024-01-05",
                "enrollment_count": "12.7",
                "lead_sponsor_name": " Acme ",
                "lead_sponsor_class": "industry ",
                "location_country": " France",
                "minimum_age": " 18 Years",
                "sex": "ALL ",
                "healthy_volunteers": " No",
            }
        ],
    )
    got = staging.stage_trials(raw)
    assert got.columns == SILVER_COLUMNS
    row = got.first()
    assert (row.study_type, row.phase, row.start_date, row.completion_date) == (
        "interventional", "phase 2", None, D(2024, 1, 5),
    )
    assert (row.enrollment_count, row.lead_sponsor_name, row.lead_sponsor_class) == (None, "Acme", "INDUSTRY")
    assert (row.location_country, row.minimum_age, row.sex, row.healthy_volunteers) == (
        "France", "18 Years", "all", "no",
    )
    types = dict(got.dtypes)
    assert types["start_date"] == "date" and types["enrollment_count"] == "int"


def test_sponsors_once_each(spark, rows):
    raw = raw_trials(
        spark,
        [
            {"lead_sponsor_name": "Acme", "lead_sponsor_class": "industry"},
            {"lead_sponsor_name": " Acme ", "lead_sponsor_class": "INDUSTRY "},
            {"lead_sponsor_name": None, "lead_sponsor_class": "NIH"},
        ],
    )
    assert rows(staging.stage_sponsors(raw)) == [("Acme", "INDUSTRY")]
