"""VARIANT studies, drift from the schema, sketches by day."""

from __future__ import annotations

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from cohortmill.operators import envelope, sketches, variants
from cohortmill.schemas import RAW_STUDY
from cohortmill.session import scratch


def study(**changes):
    body = {
        "identificationModule": {"nctId": "N1", "briefTitle": "t", "officialTitle": "o"},
        "statusModule": {"overallStatus": "Completed", "lastUpdatePostDateStruct": {"date": "2024-01-01"}},
        "designModule": {"studyType": "X", "phases": ["PHASE1", "PHASE2"], "enrollmentInfo": {"count": 12}},
        "conditionsModule": {"conditions": ["a", None], "keywords": []},
        "contactsLocationsModule": {"locations": [{"country": "France"}, {"city": "Oslo"}]},
    }
    body.update(changes)
    return {"protocolSection": body}


def messages(spark, *values):
    rows = [(f"k{i}", v, dt.datetime(2024, 1, 1)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key string, value string, timestamp timestamp")


def message(s, i="N1", status="Completed"):
    return json.dumps({"nctId": i, "overallStatus": status, "briefTitle": "t", "lastUpdatePostDate": "2024-01-01", "raw": s})


def test_fields_by_path_are_those_of_the_fixed_schema(spark, rows):
    path = scratch(spark, "variants")
    texts = [message(study()), message(study(designModule={"phases": "no list"}), "N2"), message({}, "N3"), message(None, "N4")]
    bus = messages(spark, *texts)
    envelope.accepted(variants.parse_messages(bus)).write.parquet(path)
    got = variants.to_raw_trials(spark.read.parquet(path), registry_codes=True)
    want = envelope.bronze_to_raw_trials(envelope.accepted(envelope.parse_messages(bus)), registry_codes=True)
    columns = [c for c in want.columns if c not in ("ingest_timestamp", "ingest_date")]
    assert set(got.columns) == set(want.columns)
    by = {r.nct_id: r for r in got.collect()}
    assert by["N1"].location_countries == ["France", None] and by["N1"].enrollment_count == "12"
    assert by["N1"].phase == "Phase 1/Phase 2"
    # With the fixed schema one bad field voids the study; a path is read by itself.
    good = "nct_id in ('N1', 'N3', 'N4')"
    assert rows(got.filter(good), *columns) == rows(want.filter(good), *columns)
    assert by["N2"].brief_title == "t"


def test_bad_messages_are_set_apart(spark):
    bad = ["not json", "{}", "5", None, '{"nctId": null}', '{"nctId": "N1"']
    parsed = variants.parse_messages(messages(spark, *bad, message(study())))
    assert envelope.accepted(parsed).count() == 1
    reasons = [r.reason for r in envelope.rejected(parsed).orderBy("value").collect()]
    assert sorted(reasons) == ["no id"] * 4 + ["unparsable"] * 2


def test_a_field_without_a_place_in_the_schema_is_kept(spark):
    path = scratch(spark, "variants")
    bus = messages(spark, message(study(newModule={"x": {"y": [1, "z"]}})))
    envelope.accepted(variants.parse_messages(bus)).write.parquet(path)
    raw = spark.read.parquet(path)
    assert raw.select(F.variant_get("raw", "$.protocolSection.newModule.x.y[1]", "string")).first()[0] == "z"


def drift(spark, *days):
    rows = [(dt.date(2024, 1, d), json.dumps(s) if s is not None else None) for d, s in days]
    df = spark.createDataFrame(rows, "d date, text string").select("d", F.parse_json("text").alias("raw"))
    found = variants.drift(df, "d").collect()
    return sorted((r.day.day, r.path.removeprefix("$.protocolSection."), r.change, r.n) for r in found)


WHOLE = json.loads(
    json.dumps(
        {"protocolSection": {
            "identificationModule": {"nctId": "N", "briefTitle": "t", "officialTitle": "o"},
            "statusModule": {"overallStatus": "C", "startDateStruct": {"date": "d"}, "completionDateStruct": {"date": "d"},
                             "lastUpdatePostDateStruct": {"date": "d"}},
            "designModule": {"studyType": "s", "phases": ["p"], "enrollmentInfo": {"count": "1"}},
            "conditionsModule": {"conditions": ["c"], "keywords": ["k"]},
            "sponsorCollaboratorsModule": {"leadSponsor": {"name": "n", "class": "c"}},
            "eligibilityModule": {"minimumAge": "1", "maximumAge": "2", "sex": "x", "healthyVolunteers": "y"},
            "contactsLocationsModule": {"locations": [{"country": "F"}]},
            "outcomesModule": {"primaryOutcomes": [{"measure": "m"}]},
        }}
    )
)


def changed(**modules):
    body = json.loads(json.dumps(WHOLE))
    for name, value in modules.items():
        body["protocolSection"][name] = value
    return body


def test_no_drift(spark):
    assert len(list(variants.expected_paths(RAW_STUDY))) > 30
    assert drift(spark, (1, WHOLE), (1, WHOLE), (2, WHOLE)) == []


def test_drift_of_fields(spark):
    odd = changed(
        eligibilityModule={"minimumAge": 18, "maximumAge": None, "sex": "x", "healthyVolunteers": "y", "stdAges": ["ADULT"]},
        contactsLocationsModule={"locations": [{"country": "F", "city": "P"}, {"country": 5}]},
        conditionsModule=["no object"],
    )
    found = drift(spark, (1, WHOLE), (1, odd), (1, odd), (2, odd), (2, None))
    assert [f for f in found if f[0] == 1] == [
        (1, "conditionsModule", "retyped", 2),
        (1, "contactsLocationsModule.locations[*].city", "new", 2),
        (1, "contactsLocationsModule.locations[*].country", "retyped", 2),
        (1, "eligibilityModule.minimumAge", "retyped", 2),
        (1, "eligibilityModule.stdAges", "new", 2),
    ]
    gone = [f[1:] for f in found if f[0] == 2 and f[2] == "gone"]
    assert gone == [
        ("conditionsModule.conditions", "gone", 2), ("conditionsModule.conditions[*]", "gone", 2),
        ("conditionsModule.keywords", "gone", 2), ("conditionsModule.keywords[*]", "gone", 2),
        ("eligibilityModule.maximumAge", "gone", 2),
    ]


# --- sketches ---------------------------------------------------------------------
def test_sketches_of_days_merge_to_those_of_the_range(spark):
    rng = random.Random(3)
    rows = [(dt.date(2024, 1, 1 + i % 20), "g" if i % 3 else "h", rng.randrange(9000), rng.gauss(0, 5)) for i in range(40_000)]
    df = spark.createDataFrame(rows, "d date, g string, id int, v double").repartition(7)
    path = scratch(spark, "sketches")
    sketches.daily_sketches(df, F.col("d"), ["g"], "id", "v").write.parquet(path)
    days = spark.read.parquet(path)
    assert days.count() == 40
    for groups in (["g"], []):
        for r in sketches.over_days(days, dt.date(2024, 1, 3), dt.date(2024, 1, 12), groups).collect():
            own = [x for x in rows if 3 <= x[0].day <= 12 and (not groups or x[1] == r.g)]
            assert r.n == r.n_values == len(own)
            exact = len({x[2] for x in own})
            assert abs(r.n_distinct - exact) <= sketches.distinct_error() * exact
            for q, found in zip(sketches.QUARTILES, r.quantiles):
                rank = sum(x[3] <= found for x in own) / len(own)
                assert abs(rank - q) <= sketches.rank_error() + 1 / len(own)
    assert sketches.distinct_error() < 0.05 and sketches.rank_error() < 0.01


def test_sketches_without_values_and_days(spark):
    rows = [(dt.date(2024, 1, 1), "a", None, None), (None, "a", 1, 1.0), (dt.date(2024, 1, 1), None, 1, 2.0)]
    df = spark.createDataFrame(rows, "d date, g string, id int, v double")
    got = sketches.over_days(sketches.daily_sketches(df, F.col("d"), ["g"], "id", "v"), dt.date(2024, 1, 1), dt.date(2024, 1, 9), ["g"])
    by = {r.g: r for r in got.collect()}
    assert (by["a"].n, by["a"].n_distinct, by["a"].quantiles) == (1, 0, None)
    assert (by[None].n, by[None].n_distinct, by[None].quantiles) == (1, 1, [2.0, 2.0, 2.0])
    assert sketches.over_days(sketches.daily_sketches(df, F.col("d"), ["g"], "id", "v"), dt.date(2025, 1, 1), dt.date(2025, 1, 9), ["g"]).count() == 0
