"""The enrollment mart kept current by changes against the mart of the whole table."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest

from cohortmill import streaming
from cohortmill.operators import marts
from cohortmill.operators.conditions import keyword_dictionary, stage_conditions
from cohortmill.plans import upkeep
from cohortmill.session import scratch
from cohortmill.sources import tables

TRIAL = (
    "nct_id string, overall_status string, phase string, start_date date, completion_date date, last_update_post_date date, "
    "enrollment_count int, lead_sponsor_class string, location_country string, conditions array<string>, ingest_timestamp timestamp"
)


def batch(spark, rng, ids, day):
    names = ["asthma", "Stroke", "toe", "HIV infection"]
    rows = [
        (f"N{i}", rng.choice(["completed", "terminated", "recruiting"]), rng.choice(["phase 1", None]),
         rng.choice([None, dt.date(2023, 1, 1 + i % 9)]), rng.choice([None, dt.date(2023, 5, 1 + i % 9)]), dt.date(2024, 1, day),
         rng.choice([None, i % 5, 100]), "X", rng.choice(["F", None]), rng.sample(names, rng.randrange(4)), dt.datetime(2024, 1, day))
        for i in ids
    ]
    return spark.createDataFrame(rows, TRIAL)


def whole(spark, path, schema, as_of):
    trials = streaming.read_silver(spark, path, schema)
    return marts.enrollment_mart(trials, stage_conditions(trials, keyword_dictionary(spark)), as_of)


@pytest.mark.parametrize("grain", ["condition", "trial"])
def test_the_mart_from_changes_is_that_of_the_table(spark, rows, grain):
    path, counts, rng = scratch(spark, "silver"), scratch(spark, "counts"), random.Random(2)
    schema = batch(spark, rng, [], 1).schema
    for day, ids in enumerate([range(60), range(40, 80), range(0, 80, 3), range(0, 80, 3)], 1):
        trials = batch(spark, rng, ids, min(day, 3))
        streaming.upsert_silver(trials, day, path, buckets=4, after=upkeep.keep_counts(counts, grain=grain, parts=3))
        for as_of in ("2024-02-01", "2025-01-01"):  # open studies run on
            trials = streaming.read_silver(spark, path, schema)
            full = marts.enrollment_mart(trials, stage_conditions(trials, keyword_dictionary(spark)), as_of, grain)
            assert rows(upkeep.enrollment_mart(spark, counts, as_of)) == rows(full)


def test_counts_are_added_once_whatever_is_repeated(spark, rows):
    path, counts, rng = scratch(spark, "silver"), scratch(spark, "counts"), random.Random(3)
    after = upkeep.keep_counts(counts, parts=3)
    first, second = batch(spark, rng, range(30), 1), batch(spark, rng, range(20, 40), 2)
    streaming.upsert_silver(first, 0, path, buckets=4, after=after)

    def lost(changes, name):
        raise RuntimeError("lost before the counts")

    with pytest.raises(RuntimeError):
        streaming.upsert_silver(second, 1, path, buckets=4, after=lost)
    # The same batch again: silver has it, the counts get its changes now. Then another source comes.
    streaming.upsert_silver(second, 1, path, buckets=4, after=after)
    assert rows(upkeep.enrollment_mart(spark, counts, "2024-02-01")) == rows(whole(spark, path, first.schema, "2024-02-01"))
    with pytest.raises(RuntimeError):
        streaming.upsert_silver(batch(spark, rng, range(5), 3), 2, path, buckets=4, after=lost)
    streaming.upsert_silver(batch(spark, rng, range(50, 60), 3), 0, path, buckets=4, source="other", after=after)
    # Counts half replaced, and their batch given again.
    name = [n for n in tables.children(spark, f"{counts}/staged") if n.endswith(".applied")][0]
    tables.rename(spark, f"{counts}/staged/{name}", f"{counts}/staged/{name.replace('.applied', '.whole')}")
    tables.remove(spark, f"{counts}/rows/of=3/{tables.children(spark, f'{counts}/rows/of=3')[0]}")
    streaming.upsert_silver(batch(spark, rng, range(3), 4), 1, path, buckets=4, source="other", after=after)
    assert rows(upkeep.enrollment_mart(spark, counts, "2024-02-01")) == rows(whole(spark, path, first.schema, "2024-02-01"))


def test_no_untouched_trial_is_read(spark):
    path, counts, rng = scratch(spark, "silver"), scratch(spark, "counts"), random.Random(4)
    seen = []

    def after(changes, name):
        seen.append((changes.count(), changes.inputFiles()))
        delta = upkeep.count_changes(changes, keyword_dictionary(spark))
        seen.append((delta.agg({"n": "sum"}).first()[0], delta.inputFiles()))

    streaming.upsert_silver(batch(spark, rng, range(500), 1), 0, path, buckets=4)
    streaming.upsert_silver(batch(spark, rng, [7], 2), 1, path, buckets=4, after=after)
    assert seen[0][0] == 2
    assert all("/staged/batch-1/changes/" in file for _, files in seen for file in files)


def test_counts_rebuilt(spark, rows):
    counts, rng = scratch(spark, "counts"), random.Random(5)
    trials = batch(spark, rng, range(50), 1)
    upkeep.rebuild_counts(trials, counts, parts=2)
    upkeep.rebuild_counts(trials, counts, parts=2)
    want = marts.enrollment_mart(trials, stage_conditions(trials, keyword_dictionary(spark)), "2024-02-01")
    assert rows(upkeep.enrollment_mart(spark, counts, "2024-02-01")) == rows(want)
    assert upkeep.enrollment_mart(spark, scratch(spark, "none"), "2024-02-01").count() == 0


def test_an_upsert_shuffles_its_rows_for_the_merge_alone(spark, plan, monkeypatch):
    """The first batch's changes are its rows; of later ones neither a few keys nor many sort both sides for a join."""
    path, rng, plans = scratch(spark, "silver"), random.Random(6), []
    write = tables.write_rows

    def watched(df, place, *rest, **more):
        plans.append((place.rsplit("/", 1)[1], plan(df)))
        write(df, place, *rest, **more)

    monkeypatch.setattr(tables, "write_rows", watched)
    passed = []
    for i, few in enumerate((100_000, 100_000, 1)):
        monkeypatch.setattr("cohortmill.sources.keyed.FEW_KEYS", few)
        streaming.upsert_silver(
            batch(spark, rng, range(20 + i), i + 1), i, path, buckets=2, after=lambda c, name: passed.append(c.groupBy("sign").count().collect())
        )
    changes = [text for name, text in plans if name == "changes"]
    assert len(changes) == 3 and "Exchange" not in changes[0]
    assert "BroadcastHashJoin" in changes[1] and "Join" not in changes[2]
    assert [{r.sign: r["count"] for r in p} for p in passed] == [{1: 20}, {1: 21, -1: 20}, {1: 22, -1: 21}]
    assert not any("REBALANCE" in text for _, text in plans)


def test_many_changed_rows_are_dealt_by_their_keys(spark, plan, monkeypatch):
    """Old and new row of a key meet in a task before rows are counted, so no task hashes all columns of both for nothing."""
    path, rng, plans = scratch(spark, "silver"), random.Random(7), []
    write = tables.write_rows

    def watched(df, place, *rest, **more):
        if place.endswith("/changes"):
            plans.append(plan(df))
        write(df, place, *rest, **more)

    monkeypatch.setattr(tables, "write_rows", watched)
    monkeypatch.setattr("cohortmill.sources.keyed.FEW_KEYS", 1)
    passed = []
    for i in range(2):
        streaming.upsert_silver(batch(spark, rng, range(20), i + 1), i, path, buckets=2, after=lambda c, name: passed.append(c.count()))
    exchanges = [line for line in plans[1].splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and re.search(r"hashpartitioning\(nct_id#\d+, \d+\)", exchanges[0])
    assert passed == [20, 40]
