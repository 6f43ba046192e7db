"""Volume and quality of running streams."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill import streaming
from cohortmill.operators import checks, monitor
from cohortmill.session import scratch

EVENT = "id string, at timestamp"


def events(spark, *days):
    return spark.createDataFrame([(f"e{i}", dt.datetime(2024, 1, d, h)) for i, (d, h) in enumerate(days)], EVENT)


def run(jobs):
    for job in jobs:
        job.awaitTermination()
        assert job.exception() is None


def volume(spark, path, **options):
    return {r.day.day: (r.n, r.late, r.is_closed) for r in streaming.daily_volume(spark, path, **options).collect()}


def test_days_close_behind_the_watermark_and_late_rows_are_counted_apart(spark):
    arrivals, path = scratch(spark, "arrivals"), scratch(spark, "volume")

    def land(*days):
        events(spark, *days).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(EVENT).parquet(arrivals)
        run(streaming.start_daily_volume(stream, "at", path, once=True))

    land((1, 0), (1, 23), (4, 1))
    # Day 4 minus a day is the mark: day 1 is closed, days 2 and 3 are empty, of which 2 is before the mark but nothing says so yet.
    assert volume(spark, path) == {1: (2, 0, True), 2: (0, 0, False), 3: (0, 0, False), 4: (1, 0, False)}
    assert all(closed for _, _, closed in volume(spark, path, ended=True).values())
    land((1, 5), (3, 5), (4, 9), (6, 5))  # a row of a closed day is late, those of open days are not
    assert volume(spark, path) == {
        1: (2, 1, True), 2: (0, 0, True), 3: (1, 0, True), 4: (2, 0, True), 5: (0, 0, False), 6: (1, 0, False),
    }
    # All that came is what a batch counts.
    whole = monitor.daily_counts(spark.read.schema(EVENT).parquet(arrivals), F.col("at").cast("date"))
    assert {r.day.day: r.n for r in whole.collect()} == {d: n + late for d, (n, late, _) in volume(spark, path).items()}
    run(streaming.start_daily_volume(spark.readStream.schema(EVENT).parquet(arrivals), "at", path, once=True))
    assert volume(spark, path)[1] == (2, 1, True)


def test_no_stream_yet(spark):
    assert volume(spark, scratch(spark, "volume")) == {}


SUITE = [
    checks.row_count(1, 5),
    checks.exists("status"),
    checks.not_null("id"),
    checks.in_set("status", ["a", "b"], 0.6),
    checks.between("count", 0, 10, 0.9, severity="warn"),
    checks.not_null("missing"),
]
ROWS = [("1", "a", "3"), (None, "b", "x"), ("2", "z", None), ("3", None, "11"), ("4", "a", "10"), ("5", "b", "0"), ("6", "z", "-1")]
SCHEMA = "id string, status string, count string"


def watched(spark, batches, path):
    arrivals, checkpoint, out = (scratch(spark, n) for n in ("arrivals", "cp", "out"))
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(arrivals)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(arrivals)
    watch = streaming.SuiteWatch(spark, SUITE, path)
    job = watch.over(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    job = job.trigger(availableNow=True).start()
    job.awaitTermination()
    watch.finish(job)
    return watch


def test_counts_of_the_batches_add_up_to_those_of_the_table(spark, rows):
    watch = watched(spark, [ROWS[:3], ROWS[3:4], ROWS[4:]], scratch(spark, "suite"))
    assert watch.batches().count() == 3
    whole = checks.run_suite(spark.createDataFrame(ROWS, SCHEMA), SUITE)
    assert rows(watch.totals().drop("params")) == rows(whole.drop("params"))
    assert not watch.totals().filter("check_type = 'expect_table_row_count_to_be_between'").first().success  # 7 rows
    found = watch.results().filter("check_name = 'expect_column_values_to_be_in_set:status'")
    by_size = {(r.n_rows, r.n_evaluated, r.n_unexpected, r.success) for r in found.collect()}
    assert by_size == {(3, 3, 1, True), (1, 0, 0, True)}
    assert found.select("query_id").distinct().count() == 1


def test_a_batch_run_again_counts_once(spark):
    path = scratch(spark, "suite")
    watch = watched(spark, [ROWS[:3]], path)
    later = F.col("checked_at") + F.expr("INTERVAL 1 SECOND")
    again = scratch(spark, "again")
    spark.read.schema(watch.schema).parquet(path).withColumn("checked_at", later).write.parquet(again)
    spark.read.schema(watch.schema).parquet(again).write.mode("append").parquet(path)
    assert watch.totals().first().n_rows == 3


def test_a_stream_without_rows(spark):
    watch = watched(spark, [[]], scratch(spark, "suite"))
    totals = {r.check_type: r for r in watch.totals().collect()}
    assert totals["expect_table_row_count_to_be_between"].n_rows == 0
    assert not totals["expect_table_row_count_to_be_between"].success


def test_checks_with_a_pass_of_their_own_are_refused(spark):
    with pytest.raises(ValueError, match="unique"):
        streaming.SuiteWatch(spark, [checks.unique("id")], "nowhere")


def test_counts_that_could_not_be_kept_are_told(spark, tmp_path):
    (tmp_path / "file").write_text("no folder")
    with pytest.raises(RuntimeError, match="not all counts"):
        watched(spark, [ROWS[:1]], f"{tmp_path}/file")
