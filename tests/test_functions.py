from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill import functions as C


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def test_clean_phase(spark):
    cases = {
        "Early Phase 1": "early phase 1",
        "EARLY PHASE 1 ": "early phase 1",
        "Phase 1/Phase 2": "phase 1/phase 2",
        " phase 2/phase 3": "phase 2/phase 3",
        "Phase 2, then Early Phase 1": "early phase 1",
        "phase 3 or phase 2": "phase 2",
        "Phase 4": "phase 4",
        "Phase 10": "phase 1",
        None: "n/a",
        "  ": "n/a",
        "PHASE1": "n/a",
        "Phase 9": "n/a",
    }
    assert values(spark, list(cases), C.clean_phase) == list(cases.values())


def test_registry_codes_become_words(spark):
    cases = {
        "PHASE1": "phase 1",
        "EARLY_PHASE1": "early phase 1",
        "PHASE2/PHASE3": "phase 2/phase 3",
        "NA": "n/a",
        "Phase 3": "phase 3",
        None: "n/a",
    }
    got = values(spark, list(cases), lambda c: C.clean_phase(C.normalize_registry_code(c)))
    assert got == list(cases.values())


def test_strict_date(spark):
    day = dt.date(2024, 1, 15)
    cases = {
        "2024-01": None,
        "2024": None,
        "2024-13-01": None,
        "2024-02-30": None,
        "2024-1-5": None,
        "01/15/2024": None,
        "2024-01-15abc": None,
        "x": None,
        "": None,
        None: None,
        "2024-01-15": day,
        " 2024-01-15 ": day,
        "2024-01-15T10:00:00": day,
    }
    assert values(spark, list(cases), C.strict_date) == list(cases.values())


def test_partial_dates_are_an_option(spark):
    first = lambda c: C.strict_date(c, "first_of_month")
    assert values(spark, ["2024-03", "2024-03-09", "2024", "2024-13"], first) == [
        dt.date(2024, 3, 1),
        dt.date(2024, 3, 9),
        None,
        None,
    ]
    with pytest.raises(ValueError):
        C.strict_date(F.lit("x"), "guess")


def test_strict_int(spark):
    cases = {
        "12.7": None,
        "1e3": None,
        "99999999999": None,
        "abc": None,
        "0x1F": None,
        "": None,
        None: None,
        " 12 ": 12,
        "+7": 7,
        "007": 7,
        "-3": -3,
    }
    assert values(spark, list(cases), C.strict_int) == list(cases.values())


def test_open_studies_run_until_as_of(spark):
    df = spark.createDataFrame(
        [
            (dt.date(2020, 1, 1), dt.date(2020, 1, 11)),
            (dt.date(2020, 1, 1), None),
            (None, dt.date(2020, 1, 1)),
            (dt.date(2020, 1, 11), dt.date(2020, 1, 1)),
        ],
        "a date, b date",
    )
    days = df.select(C.open_duration_days(F.col("a"), F.col("b"), "2020-02-01").alias("d"))
    assert [r.d for r in days.collect()] == [10, 31, None, -10]


def test_fills(spark):
    df = spark.createDataFrame([(None, None, None), (250_000, 3, "x"), (-5, 0, "")], "e int, d int, t string")
    got = df.select(
        C.clip_enrollment(F.col("e")), C.fill_duration(F.col("d")), C.text_or_unknown(F.col("t"))
    ).collect()
    assert [tuple(r) for r in got] == [(0, 365, "unknown"), (100_000, 3, "x"), (-5, 0, "")]
