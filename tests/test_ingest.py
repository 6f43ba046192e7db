from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cohortmill.operators import envelope, marts, staging
from cohortmill.schemas import RAW_STUDY
from cohortmill.session import scratch
from cohortmill.sources import archive, bus, mark, tables

D = dt.date


def study(nct_id="NCT00000001", status="Recruiting", updated="2024-01-02", **more):
    identity = {"briefTitle": "A study"} | ({"nctId": nct_id} if nct_id else {})
    state = {"lastUpdatePostDateStruct": {"date": updated}} | ({"overallStatus": status} if status else {})
    return {"protocolSection": {"identificationModule": identity, "statusModule": state, **more}}


FULL = study(
    designModule={"studyType": "INTERVENTIONAL", "phases": ["PHASE1", "PHASE2"], "enrollmentInfo": {"count": 40}},
    conditionsModule={"conditions": ["Asthma", "Asthma", "HIV"], "keywords": ["k"]},
    sponsorCollaboratorsModule={"leadSponsor": {"name": " Acme", "class": "industry"}},
    eligibilityModule={"minimumAge": "18 Years", "sex": "ALL", "healthyVolunteers": False},
    contactsLocationsModule={"locations": [{"country": "France"}, {"country": "Spain"}]},
)


@pytest.fixture
def nested(spark):
    def make(*studies):
        texts = spark.createDataFrame([(json.dumps(s),) for s in studies], "t string")
        return texts.select(F.from_json("t", RAW_STUDY).alias("study"), F.lit(D(2024, 1, 3)).alias("run_date"))

    return make


def on_bus(spark, *values):
    at = dt.datetime(2024, 1, 3, 12)
    return spark.createDataFrame([(None, v, at) for v in values], "key string, value string, timestamp timestamp")


def test_archive_round_trip(spark, nested, plan):
    path = scratch(spark, "archive")
    assert archive.write_archive(nested(FULL, study("NCT00000002")), path) == 2
    back = archive.read_archive(spark, path)
    assert {(r.year, r.month, r.day, r.run_date) for r in back.collect()} == {("2024", "01", "03", D(2024, 1, 3))}
    one_day = archive.read_archive(spark, path).filter(F.col("run_date") == F.lit(D(2024, 1, 3)))
    assert "PartitionFilters: [isnotnull" in plan(one_day) and one_day.count() == 2
    flat = envelope.flatten_studies(back).orderBy("nct_id").collect()
    assert flat[0].conditions == ["Asthma", "Asthma", "HIV"] and flat[0].location_countries == ["France", "Spain"]
    assert (flat[0].enrollment_count, flat[0].healthy_volunteers) == ("40", "false")
    assert flat[1].phase is None and flat[1].location_country is None


def test_wrapped_archive(spark, tmp_path):
    for day, studies in (("01", [FULL]), ("02", [study("NCT00000002"), study("NCT00000003")]), ("03", [])):
        folder = tmp_path / "2024" / "01" / day
        folder.mkdir(parents=True)
        (folder / "studies.json").write_text(
            json.dumps({"run_date": f"2024-01-{day}", "count": len(studies), "studies": studies}, indent=1)
        )
    got = archive.read_wrapped_archive(spark, str(tmp_path))
    assert sorted(r.run_date.day for r in got.collect()) == [1, 2, 2]
    pages = [str(tmp_path / "2024" / "01" / d) for d in ("01", "02")]
    assert archive.read_wrapped_archive(spark, pages).count() == 3


def test_mark_defaults_moves_and_never_goes_back(spark):
    path = scratch(spark, "mark")
    run = D(2024, 1, 31)
    assert mark.read_mark(spark, path, run) == D(2024, 1, 1)
    assert mark.write_mark(spark, path, run, None) is None
    assert mark.read_mark(spark, path, run) == D(2024, 1, 1)
    mark.write_mark(spark, path, run, D(2024, 1, 30))
    mark.write_mark(spark, path, run, D(2024, 1, 20))
    assert mark.read_mark(spark, path, run) == D(2024, 1, 30)
    mark.write_mark(spark, path, run, D(2024, 1, 30), policy="run_date")
    assert mark.read_mark(spark, path, run) == run
    assert mark.write_mark(spark, path, run, D(2999, 1, 1)) == run


def test_scan_from_the_mark_is_inclusive_for_text_and_dates(spark, rows):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-03")], "k string, last_update_post_date string")
    since = D(2024, 1, 2)
    assert rows(mark.updated_since(df, since), "k") == [("b",), ("c",)]
    newest_last = mark.updated_since(df, since, ordered=True).collect()
    assert [r.k for r in newest_last] == ["b", "c"]
    odd = df.union(spark.createDataFrame([("n", None), ("s", "01/15/2024"), ("p", "2024-01"), ("f", "2999-01-01")], df.schema))
    assert rows(mark.updated_since(odd, since), "k") == [("b",), ("c",), ("f",), ("n",), ("p",), ("s",)]
    assert mark.newest_day(odd, D(2024, 1, 2)) == since
    assert mark.newest_day(odd.filter("k = 'f'"), D(2024, 1, 2)) == since
    assert mark.newest_day(odd.filter("k = 'n'"), D(2024, 1, 2)) is None
    dated = df.withColumn("last_update_post_date", F.to_date("last_update_post_date"))
    assert rows(mark.updated_since(dated, since), "k") == [("b",), ("c",)]


def test_messages_fill_the_status_and_set_nameless_studies_apart(spark, nested):
    studies = nested(study(), study(None, None))
    by_key = {r.key: json.loads(r.value) for r in envelope.to_messages(studies).collect()}
    assert by_key["NCT00000001"]["overallStatus"] == "Recruiting"
    assert by_key["NCT00000001"]["raw"]["protocolSection"]["identificationModule"]["briefTitle"] == "A study"
    assert by_key[None]["overallStatus"] == "Unknown status" and "nctId" not in by_key[None]
    kept = {r.key for r in envelope.to_messages(studies, unknown_id="keep").collect()}
    assert kept == {"NCT00000001", "UNKNOWN"}


def test_publish_counts_and_drops_only_what_has_a_key(spark, nested):
    path = scratch(spark, "drop")
    messages = envelope.to_messages(nested(study(), study("NCT00000002"), study(None)))
    assert bus.publish(messages, path) == {"sent": 2, "failed": 1}
    assert bus.read_drop(spark, path, stream=False).count() == 2
    assert envelope.unroutable(messages).count() == 1
    with pytest.raises(ValueError):
        bus.publish(messages)


def test_parse_accepts_and_rejects(spark, rows):
    parsed = envelope.parse_messages(
        on_bus(
            spark,
            '{"nctId":"N1","overallStatus":"Recruiting","extra":1,"raw":{"a":[1,2]}}',
            '{"nctId":"N2","overallStatus":null}',
            '{"overallStatus":"Completed"}',
            "not json",
            None,
        )
    )
    assert rows(envelope.accepted(parsed), "nct_id", "overall_status", "raw") == [
        ("N1", "Recruiting", '{"a":[1,2]}'), ("N2", None, None),
    ]
    assert rows(envelope.rejected(parsed), "value", "reason") == [
        ("not json", "unparsable"), ('{"overallStatus":"Completed"}', "no id"), (None, "no id"),
    ]


def test_filtering_does_not_parse_twice(spark, plan):
    accepted = envelope.accepted(envelope.parse_messages(on_bus(spark, "{}").repartition(2)))
    assert plan(accepted).count("from_json") == 1


def test_bronze_text_feeds_staging(spark, nested):
    messages = envelope.to_messages(nested(FULL)).withColumn("timestamp", F.current_timestamp())
    bronze = envelope.accepted(envelope.parse_messages(messages))
    raw = envelope.bronze_to_raw_trials(bronze, registry_codes=True)
    row = staging.stage_trials(raw).first()
    assert (row.phase, row.enrollment_count, row.lead_sponsor_class) == ("phase 1/phase 2", 40, "INDUSTRY")
    assert (row.location_country, row.healthy_volunteers, row.conditions) == (
        "France", "false", ["Asthma", "Asthma", "HIV"],
    )


def test_bytes_of_a_topic_become_text(spark):
    topic = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b'{"nctId":"N"}'), dt.datetime(2024, 1, 1), 7)],
        "key binary, value binary, timestamp timestamp, offset long",
    )
    got = bus.from_bytes(topic)
    assert got.columns == ["key", "value", "timestamp"]
    assert envelope.accepted(envelope.parse_messages(got)).first().nct_id == "N"


def land(spark, path, days):
    bodies = [
        (None, json.dumps({"nctId": f"N{i}", "overallStatus": "Recruiting" if i % 3 else "Completed"}), day)
        for i, day in enumerate(days)
    ]
    messages = spark.createDataFrame(bodies, "key string, value string, timestamp timestamp")
    tables.append_bronze(
        envelope.accepted(envelope.parse_messages(messages, at=F.col("timestamp"))), path
    )


def test_day_probe_reads_only_its_partition(spark, plan):
    path = scratch(spark, "bronze")
    land(spark, path, [dt.datetime(2024, 1, d) for d in (1, 1, 2)])
    bronze = tables.read_bronze(spark, path)
    assert tables.day_arrived(bronze, D(2024, 1, 2)).first().arrived is True
    probe = tables.day_arrived(bronze, D(2024, 1, 3))
    assert probe.first().arrived is False
    assert "PartitionFilters: [isnotnull(ingest_date" in plan(probe)


def test_compaction_keeps_rows_and_replaces_only_its_days(spark, tmp_path):
    source, target = scratch(spark, "bronze"), scratch(spark, "compact")
    for _ in range(3):
        land(spark, source, [dt.datetime(2024, 1, d) for d in (1, 1, 1, 2)])
    tables.compact_days(spark, source, target, D(2024, 1, 1), D(2024, 1, 2))
    tables.compact_days(spark, source, target, D(2024, 1, 2), D(2024, 1, 2))
    done = tables.read_bronze(spark, target)
    assert done.count() == 12 and len(done.inputFiles()) == 3
    assert len(tables.read_bronze(spark, source).inputFiles()) > 3


def test_a_scan_skips_files_before_the_mark(spark, plan):
    import pyarrow.parquet as pq

    path = scratch(spark, "by-update")
    records = spark.range(4000).selectExpr(
        "concat('N', id) AS nct_id", "CASE WHEN id % 97 = 0 THEN 'no date' ELSE cast(date_add(date'2020-01-01', cast(id % 1000 as int)) as string) END AS last_update_post_date"
    )
    mark.write_by_update(records, path, files=8)
    since = dt.date(2022, 9, 1)
    found = mark.read_updated_since(spark, path, since)
    assert "Or(IsNull(update_day),GreaterThanOrEqual(update_day,2022-09-01))" in plan(found)
    want = mark.updated_since(records, since)
    assert found.select("nct_id").exceptAll(want.select("nct_id")).isEmpty() and found.count() == want.count()
    # By their statistics most row groups lie before the mark and have no null.
    kept = 0
    files = [f for f in tables.children(spark, path) if f.endswith(".parquet")]
    for name in files:
        meta = pq.ParquetFile(f"{path.removeprefix('file:')}/{name}").metadata
        for group in range(meta.num_row_groups):
            column = [meta.row_group(group).column(i) for i in range(3)][2].statistics
            kept += column.null_count > 0 or column.max >= since
    assert len(files) == 8 and kept <= 3


def test_reading_a_mark_writes_nothing(spark):
    path = scratch(spark, "mark")
    assert mark.read_mark(spark, path, dt.date(2024, 2, 1)) == dt.date(2024, 1, 2)
    assert not tables.exists(spark, path)


def test_the_mart_of_clustered_tables_shuffles_by_group_alone(spark, plan, rows):
    trials = spark.range(500).selectExpr(
        "concat('N', id) AS nct_id", "'completed' AS overall_status", "concat('p', id % 3) AS phase", "'X' AS lead_sponsor_class",
        "'F' AS location_country", "cast(id as int) AS enrollment_count", "date'2024-01-01' AS start_date", "date'2024-03-01' AS completion_date",
    )
    bridge = spark.range(900).selectExpr("concat('N', id % 450) AS nct_id", "concat('c', id % 5) AS condition_category")
    tables.write_clustered(trials, "mart_trials", scratch(spark, "wh"), buckets=4)
    tables.write_clustered(bridge, "mart_bridge", scratch(spark, "wh"), sort="condition_category", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = marts.enrollment_mart(spark.table("mart_trials"), spark.table("mart_bridge"), "2024-06-01")
        shuffles = [line for line in plan(mart).splitlines() if "Exchange" in line]
        assert len(shuffles) >= 1 and not any("nct_id" in line for line in shuffles)
        assert rows(mart) == rows(marts.enrollment_mart(trials, bridge, "2024-06-01"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clustered_table_joins_without_a_shuffle(spark, plan):
    df = spark.range(100).select(
        F.concat(F.lit("N"), "id").alias("nct_id"), F.lit(D(2024, 1, 1)).alias("completion_date")
    )
    tables.write_clustered(df, "clustered_trials", scratch(spark, "wh"), buckets=4)
    table = spark.table("clustered_trials")
    joined = table.alias("a").hint("merge").join(table.alias("b"), "nct_id")
    assert joined.count() == 100 and "Exchange hashpartitioning" not in plan(joined)


def test_csv_has_a_header(spark, rows):
    path = scratch(spark, "csv")
    tables.write_csv(spark.createDataFrame([(1, 0.5)], "a int, b double"), path)
    assert rows(spark.read.option("header", True).csv(path)) == [("1", "0.5")]


def test_a_hot_partition_is_split_over_files(spark):
    path = scratch(spark, "hot")
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        tables.write_table(df, path, ["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = tables.read_table(spark, path).inputFiles()
    assert sum("p=hot" in f for f in files) > 4 and sum("p=cold" in f for f in files) <= 3
    assert tables.read_table(spark, path).count() == 200_000


class Reader:
    """Stands in for a Spark reader: the connector is not on the class path here."""

    def __init__(self, topic):
        self.topic = topic

    def format(self, name):
        self.name = name
        return self

    def options(self, **options):
        self.given = options
        return self

    def load(self):
        return self.topic


def test_topic_options(spark):
    topic = spark.createDataFrame([(b"k", b"v", dt.datetime(2024, 1, 1))], "key binary, value binary, timestamp timestamp")

    class Session:
        readStream, read = Reader(topic), Reader(topic)

    assert bus.read_topic(Session, "host:9092", "updates", maxOffsetsPerTrigger="10").first().value == "v"
    assert Session.readStream.name == "kafka" and Session.readStream.given == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "updates",
        "failOnDataLoss": "false",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10",
    }
    bus.read_topic(Session, "host:9092", "updates", stream=False)
    assert "startingOffsets" not in Session.read.given


def test_texts_are_written_compressed_and_in_files_of_few_rows(spark, nested, tmp_path, monkeypatch):
    monkeypatch.setitem(archive.JSON_FILES, "maxRecordsPerFile", "2")
    day = nested(*(study(f"NCT0000000{i}") for i in range(5))).coalesce(1)
    assert archive.write_archive(day, str(tmp_path / "archive"), one_day=True) == 5
    assert bus.publish(envelope.to_messages(day), str(tmp_path / "bus")) == {"sent": 5, "failed": 0}
    for name, back in (("archive", archive.read_archive), ("bus", lambda s, p: bus.read_drop(s, p, stream=False))):
        files = [f.name for f in (tmp_path / name).rglob("part-*")]
        assert len(files) == 3 and all(f.endswith(".json.gz") for f in files)
        assert back(spark, str(tmp_path / name)).count() == 5


def test_documents_hold_the_studies_of_a_run_whatever_their_ids(spark, nested):
    """Studies whose ids lie far apart: few documents, none above 1,000, no study lost, also of an unknown run."""
    from catalogue.queries import wrapped

    number = F.col("id") * 100_000
    s = F.struct(F.struct(F.struct(F.concat(F.lit("NCT"), number).alias("nctId")).alias("identificationModule")).alias("protocolSection"))
    rows = spark.range(4_000).select(s.alias("study"), F.when(F.col("id") >= 1_000, F.lit(D(2024, 1, 1))).alias("run_date"))
    got = wrapped(rows).select("run_date", F.size("studies").alias("n")).collect()
    assert len(got) <= 7 and max(r.n for r in got) <= 1_000
    assert sum(r.n for r in got if r.run_date) == 3_000 and sum(r.n for r in got) == 4_000


def test_buckets_grow_with_the_tables(spark, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 100)
    small, large = spark.range(700), spark.range(7_000)
    assert [tables.buckets_for(*t, least=8) for t in ((small,), (small, large), (spark.range(0),))] == [8, 128, 8]
