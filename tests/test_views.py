"""SQL functions and views against the column helpers, and models that score by themselves."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortmill.functions import clean_phase, strict_date, strict_int
from cohortmill.operators import features, learn, marts, scoring
from cohortmill.plans import views
from cohortmill.session import scratch

TEXTS = [
    "Phase 1", "early phase 1 / phase 2", "PHASE 2/PHASE 3", "Phase 3 or phase 2", "PHASE1", "", None, "n/a", " phase 4 ",
    "2024-01-05", " 2024-02-30", "2024-01", "2024-01-05T10:00", "01/15/2024", "12", "-7", " +3 ", "12.7", "1e3", "99999999999",
]


def test_functions_agree_with_the_column_helpers(spark):
    views.register_functions(spark)
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    got = df.selectExpr("clean_phase(text)", "strict_date(text)", "strict_int(text)").collect()
    want = df.select(clean_phase(F.col("text")), strict_date(F.col("text")), strict_int(F.col("text"))).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_the_mart_as_a_query_text(spark, rows):
    rng = random.Random(6)
    trials = spark.createDataFrame(
        [(f"N{i}", rng.choice(["completed", "terminated", "recruiting"]), rng.choice(["phase 1", None]), "X", rng.choice(["F", None]),
          rng.choice([None, i]), rng.choice([None, dt.date(2024, 1, 1 + i % 9)]), rng.choice([None, dt.date(2024, 3, 1)])) for i in range(200)],
        "nct_id string, overall_status string, phase string, lead_sponsor_class string, location_country string, "
        "enrollment_count int, start_date date, completion_date date",
    )
    bridge = spark.createDataFrame([(f"N{rng.randrange(250)}", rng.choice("abc")) for _ in range(300)], "nct_id string, condition_category string")
    views.register(spark, stg_trials=trials, stg_conditions=bridge)
    for as_of in ("2025-01-01", dt.date(2024, 2, 1), None):
        assert rows(views.enrollment_mart(spark, as_of)) == rows(marts.enrollment_mart(trials, bridge, as_of))


# --- scoring -----------------------------------------------------------------------
def feature_rows(spark, n=300):
    rng = random.Random(2)
    rows = [(f"N{i}", rng.choice(["p1", "p2"]), rng.choice(["FR", "DE"]), rng.randrange(100)) for i in range(n)]
    return spark.createDataFrame([(*r, int((r[1] == "p1") != (r[3] > 60))) for r in rows], "nct_id string, phase string, country string, size int, is_completed int")


def test_a_stored_version_scores_rows_without_an_outcome(spark):
    root, train = scratch(spark, "scorers"), feature_rows(spark)
    columns = {"features": ["phase", "country", "size"], "categorical": ["phase", "country"]}
    for day, trees in (("2024-01-01", 2), ("2024-02-01", 12)):
        model = scoring.fit("random_forest", train, **columns, numTrees=trees, maxDepth=4)
        scoring.store(model, root, "random_forest", day)
    assert scoring.versions(spark, root, "random_forest") == ["2024-01-01", "2024-02-01"]
    new = spark.createDataFrame([("A", "p1", "Atlantis", 10), ("B", "p2", "FR", 90), ("C", None, "FR", 10), ("D", "p2", "FR", 10)], "nct_id string, phase string, country string, size int").fillna("unknown")
    got = {r.nct_id: r for r in scoring.score(scoring.load(spark, root, "random_forest"), new, ["nct_id"]).collect()}
    assert set(got) == set("ABCD")
    assert got["A"].predicted_completed == got["B"].predicted_completed == 1 and got["D"].predicted_completed == 0
    trees = {d: scoring.load(spark, root, "random_forest", d).stages[-1].getNumTrees for d in ("2024-01-15", "2024-03-01")}
    assert trees == {"2024-01-15": 2, "2024-03-01": 12}
    with pytest.raises(ValueError, match="up to 2023"):
        scoring.load(spark, root, "random_forest", "2023-12-31")


def test_both_models_and_numbers_alone(spark):
    train = feature_rows(spark)
    boosted = scoring.fit("gradient_boosting", train, ["phase", "country", "size"], ["phase", "country"], maxIter=8, maxDepth=3)
    scored = scoring.score(boosted, train, ["is_completed"])
    assert scored.filter("predicted_completed = is_completed").count() > 280
    plain = scoring.fit("random_forest", train, ["size"], [], numTrees=2, maxDepth=2)
    assert scoring.score(plain, train.select("nct_id", "size"), ["nct_id"]).count() == 300


def test_a_category_with_too_many_values_is_refused(spark, monkeypatch):
    monkeypatch.setattr(scoring, "MAX_VALUES", 1)
    with pytest.raises(ValueError, match="encode it before"):
        scoring.fit("random_forest", feature_rows(spark, 50), ["phase", "size"], ["phase"])


def test_open_trials_have_features_and_no_target(spark):
    trials = spark.createDataFrame(
        [("A", "recruiting", "p", dt.date(2024, 1, 1)), ("B", "completed", "p", dt.date(2024, 1, 1)), ("C", None, "p", None)],
        "nct_id string, overall_status string, phase string, start_date date",
    ).selectExpr("*", "cast(null as date) AS completion_date", "'x' AS lead_sponsor_class", "'F' AS location_country", "5 AS enrollment_count",
                 "'all' AS sex", "'no' AS healthy_volunteers")
    bridge = spark.createDataFrame([("A", "c")], "nct_id string, condition_category string")
    got = {r.nct_id: r for r in features.trial_features(trials, bridge, "2024-02-01", open_trials=True).collect()}
    assert set(got) == {"A", "C"} and got["A"].is_completed is None and got["A"].study_duration_days == 31
    assert {r.nct_id for r in features.trial_features(trials, bridge, "2024-02-01").collect()} == {"B"}
    assert learn.MODELS.keys() == {"random_forest", "gradient_boosting"}
