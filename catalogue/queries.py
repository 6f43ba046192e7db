"""The registered queries: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalogue import proxies as P
from cohortmill import streaming
from cohortmill.functions import clean_phase
from cohortmill.operators import (
    checks,
    conditions,
    envelope,
    features,
    learn,
    marts,
    monitor,
    reports,
    scoring,
    sketches,
    staging,
    variants,
)
from cohortmill.operators.joins import measured
from cohortmill.plans import medallion, upkeep, views
from cohortmill.schemas import SILVER_COLUMNS
from cohortmill.session import prepare, scratch
from cohortmill.sources import archive, bus, mark, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir.rstrip("/"))

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` by way of a table, for operators that read their input several times."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return tables.read_table(df.sparkSession, path)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_trials(P.trials_raw(spark, sf_dir))


# --- staging -----------------------------------------------------------------
@query
def stg_trials(spark, sf_dir):
    return silver(spark, sf_dir)


@query
def latest_version(spark, sf_dir):
    events = P.table(spark, sf_dir, "events")
    return staging.latest_version(events, "user_id", ["ts", "event_id"])


@query
def stg_trials_dedup(spark, sf_dir):
    return staging.stage_trials(P.versions_raw(P.table(spark, sf_dir, "events")))


@query
def stg_conditions(spark, sf_dir):
    return P.conditions(spark, sf_dir)


@query
def stg_sponsors(spark, sf_dir):
    return staging.stage_sponsors(P.trials_raw(spark, sf_dir))


@query
def clean_phase_dist(spark, sf_dir):
    raw = P.versions_raw(P.table(spark, sf_dir, "events"))
    return (
        raw.select(F.col("phase").alias("raw_phase"), clean_phase(F.col("phase")).alias("phase"))
        .groupBy("raw_phase", "phase")
        .agg(F.count("*").alias("n"))
    )


# --- marts and reports -------------------------------------------------------
@query
def enrollment_mart(spark, sf_dir):
    return marts.enrollment_mart(silver(spark, sf_dir), P.conditions(spark, sf_dir), P.AS_OF)


@query
def enrollment_mart_trial_grain(spark, sf_dir):
    return marts.enrollment_mart(
        silver(spark, sf_dir), P.conditions(spark, sf_dir), P.AS_OF, grain="trial"
    )


@query
def phase_outcomes(spark, sf_dir):
    return marts.phase_outcomes_mart(silver(spark, sf_dir))


@query
def sponsor_activity(spark, sf_dir):
    return marts.sponsor_activity_mart(silver(spark, sf_dir))


@query
def top_sponsors(spark, sf_dir):
    activity = marts.sponsor_activity_mart(silver(spark, sf_dir))
    return reports.top(
        activity.select("lead_sponsor_name", "trial_count", "country_count"),
        [F.desc("trial_count"), F.asc("lead_sponsor_name")],
        20,
    )


@query
def dropout_by_area(spark, sf_dir):
    return reports.dropout_by_area(silver(spark, sf_dir), P.conditions(spark, sf_dir))


@query
def timeline_percentiles(spark, sf_dir):
    return reports.timeline_percentiles(silver(spark, sf_dir), P.AS_OF)


@query
def design_completion(spark, sf_dir):
    return reports.design_completion(silver(spark, sf_dir), P.AS_OF)


@query
def trials_by_country(spark, sf_dir):
    return reports.trials_by_country(silver(spark, sf_dir))


@query
def geo_gaps(spark, sf_dir):
    return reports.geo_gaps(
        silver(spark, sf_dir),
        P.conditions(spark, sf_dir),
        places(spark, sf_dir),
        category="condition_name",
        min_trials=30,
    )


def places(spark, sf_dir) -> DataFrame:
    nation, region = P.table(spark, sf_dir, "nation"), P.table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("country"), F.col("r_name").alias("region")
    )


@query
def geo_gaps_by_category(spark, sf_dir):
    """Gaps by category over trials with several countries each; every country listed twice."""
    listed = places(spark, sf_dir)
    return reports.geo_gaps(passing(spark, sf_dir), P.conditions(spark, sf_dir), listed.union(listed), min_trials=1_000_000)


def passing(spark, sf_dir) -> DataFrame:
    """Silver of the trials with all nine statuses and several countries."""
    return staging.stage_trials(P.trials_passing(spark, sf_dir))


@query
def phase_outcomes_all_statuses(spark, sf_dir):
    return marts.phase_outcomes_mart(passing(spark, sf_dir))


@query
def sponsor_activity_countries(spark, sf_dir):
    return marts.sponsor_activity_mart(passing(spark, sf_dir))


@query
def trials_by_countries(spark, sf_dir):
    return reports.trials_by_country(passing(spark, sf_dir))


# --- raw archive, incremental scan, messages ------------------------------------
@query
def raw_archive_scan(spark, sf_dir):
    """Studies written to the archive by run day and read back."""
    path = scratch(spark, "archive")
    archive.write_archive(P.studies(spark, sf_dir), path)
    rows = archive.read_archive(spark, path)
    flat = envelope.flatten_studies(rows, keep=["run_date", "year", "month", "day"])
    return flat.select(
        "nct_id",
        "overall_status",
        "brief_title",
        "phase",
        "enrollment_count",
        "lead_sponsor_class",
        "location_country",
        "run_date",
        "year",
        "month",
        "day",
    )


@query
def incremental_scan(spark, sf_dir):
    """Two scans: from the default mark, then from the mark the first one left."""
    path = scratch(spark, "mark")
    run_day = dt.date.fromisoformat(P.RUN_DAY)
    records = P.scan_records(spark, sf_dir)
    first = mark.updated_since(records, mark.read_mark(spark, path, run_day))
    mark.write_mark(spark, path, run_day, mark.newest_day(first, run_day))
    second = mark.updated_since(records, mark.read_mark(spark, path, run_day))
    return first.withColumn("scan", F.lit(1)).unionByName(second.withColumn("scan", F.lit(2)))


@query
def clustered_scan(spark, sf_dir):
    """A scan from a mark over records that lie in files by their update day."""
    path = scratch(spark, "by-update")
    mark.write_by_update(P.scan_records(spark, sf_dir), path, files=16)
    found = mark.read_updated_since(spark, path, dt.date.fromisoformat(P.RUN_DAY))
    return found.select("nct_id", "last_update_post_date", "update_day")


@query
def ordered_scan(spark, sf_dir):
    """A scan in the order of the updates: its rows, and whether each task's follow those of the task before."""
    found = mark.updated_since(P.scan_records(spark, sf_dir), dt.date(2001, 1, 1), ordered=True)
    day = mark.update_day(found, "last_update_post_date")
    tasks = found.groupBy(F.spark_partition_id().alias("task")).agg(
        F.min(day).alias("first"), F.max(day).alias("last"), F.count("*").alias("n")
    )
    before = F.max("last").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    return tasks.withColumn("ordered", F.coalesce(before <= F.col("first"), F.lit(True))).agg(
        F.sum("n").alias("n"), F.bool_and("ordered").alias("is_ordered")
    )


def wrapped(rows: DataFrame, each: int = 750) -> DataFrame:
    """The studies of a run dealt to as many documents as hold `each` of them on average, far from 1,000."""
    runs = rows.groupBy(F.col("run_date").alias("run")).agg(F.ceil(F.count("*") / each).alias("documents"))
    dealt = rows.join(measured(runs), F.col("run_date").eqNullSafe(F.col("run")))
    part = F.pmod(F.xxhash64("study"), F.col("documents")).alias("part")
    return dealt.groupBy("run_date", part).agg(F.collect_list("study").alias("studies"))


@query
def wrapped_archive_scan(spark, sf_dir):
    """Studies written as documents that wrap up to 1,000 of them, read back as their union."""
    path = scratch(spark, "wrapped")
    wrapped(P.studies(spark, sf_dir)).select(
        F.col("run_date").cast("string").alias("run_date"), F.size("studies").cast("bigint").alias("count"), "studies"
    ).write.option("maxRecordsPerFile", 1).json(path)
    flat = envelope.flatten_studies(archive.read_wrapped_archive(spark, path), keep=["run_date"])
    return flat.select("nct_id", "overall_status", "brief_title", "phase", "enrollment_count", "location_country", "run_date")


@query
def topic_bytes(spark, sf_dir):
    """Messages as a topic holds them, in bytes, through the parsing behind the topic source."""
    topic = P.versions_bus(spark, sf_dir).select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "timestamp",
        F.lit(0).alias("partition"),
    )
    bronze = envelope.accepted(envelope.parse_messages(bus.from_bytes(topic)))
    return bronze.select("nct_id", "overall_status", "brief_title", "last_update_post_date", "raw")


@query
def json_envelope(spark, sf_dir):
    """Study -> message text -> parsed message, with fields of the study inside."""
    messages = envelope.to_messages(P.studies(spark, sf_dir)).withColumn(
        "timestamp", F.current_timestamp()
    )
    bronze = envelope.accepted(envelope.parse_messages(messages))
    raw = envelope.bronze_to_raw_trials(bronze)
    return raw.select(
        "nct_id",
        "overall_status",
        "brief_title",
        "last_update_post_date",
        "phase",
        "enrollment_count",
        "lead_sponsor_name",
        "sex",
    )


@query
def variant_studies(spark, sf_dir):
    """Study -> message text -> message parsed once -> bronze with VARIANT studies -> fields by path."""
    path = scratch(spark, "variants")
    messages = envelope.to_messages(P.studies(spark, sf_dir)).withColumn("timestamp", F.current_timestamp())
    envelope.accepted(variants.parse_messages(messages)).write.parquet(path)
    raw = variants.to_raw_trials(tables.read_table(spark, path))
    return raw.select(
        "nct_id", "overall_status", "brief_title", "last_update_post_date", "phase", "enrollment_count",
        "lead_sponsor_name", "sex", "location_country", "conditions",
    )


@query
def schema_drift(spark, sf_dir):
    """Where each quarter's studies depart from the schema; a module, a number for a text and a gap are planted."""
    text = F.to_json("study")
    k = F.get_json_object(text, "$.protocolSection.identificationModule.nctId").substr(4, 20).cast("bigint")
    extra = F.regexp_replace(text, r'^\{"protocolSection":\{', '{"protocolSection":{"extraModule":{"x":1},')
    number = F.regexp_replace(text, '"sex":"[^"]*"', '"sex":5')
    gap = F.regexp_replace(text, '"officialTitle":"[^"]*"', '"newTitle":[]')
    planted = F.when(F.col("run_date") == "1996-01-01", gap).when(k % 50 == 0, extra).when(k % 40 == 0, number).otherwise(text)
    rows = P.studies(spark, sf_dir).select("run_date", F.parse_json(planted).alias("raw"))
    return variants.drift(stored(rows, "variants"), "run_date")


@query
def publish_counters(spark, sf_dir):
    """Messages dropped for the bus: sent and failed, and how many arrived."""
    path = scratch(spark, "drop")
    sent = bus.publish(P.versions_bus(spark, sf_dir), path)
    landed = bus.read_drop(spark, path, stream=False)
    return landed.agg(F.count("*").alias("landed")).select(
        F.lit(sent["sent"]).cast("bigint").alias("sent"),
        F.lit(sent["failed"]).cast("bigint").alias("failed"),
        "landed",
    )


def land_bronze(spark, sf_dir) -> str:
    """A batch of bronze, landed under the days its messages are from."""
    path = scratch(spark, "bronze")
    parsed = envelope.parse_messages(P.versions_bus(spark, sf_dir), at=F.col("timestamp"))
    tables.append_bronze(envelope.accepted(parsed), path)
    return path


@query
def bronze_batch(spark, sf_dir):
    bronze = tables.read_bronze(spark, land_bronze(spark, sf_dir))
    return bronze.groupBy("ingest_date", "overall_status").agg(F.count("*").alias("n"))


@query
def bronze_compacted(spark, sf_dir):
    target = scratch(spark, "compacted")
    tables.compact_days(
        spark, land_bronze(spark, sf_dir), target, dt.date(1970, 1, 1), dt.date(2100, 1, 1)
    )
    return tables.read_bronze(spark, target).select(
        "nct_id", "overall_status", "brief_title", "last_update_post_date", "raw", "ingest_date"
    )


@query
def partition_arrival(spark, sf_dir):
    bronze = tables.read_bronze(spark, land_bronze(spark, sf_dir))
    days = [dt.date(2024, 1, 15), dt.date(2024, 2, 15)]
    return reduce(DataFrame.unionByName, [tables.day_arrived(bronze, day) for day in days])


# --- streams -----------------------------------------------------------------------
@query
def stream_bronze(spark, sf_dir):
    """The bus as a stream into bronze, read back; restarted once, which adds nothing."""
    path, checkpoint = scratch(spark, "bronze"), scratch(spark, "checkpoint")
    for _ in range(2):
        source = P.versions_bus(spark, sf_dir, stream=True)
        streaming.start_bronze(source, path, checkpoint, once=True).awaitTermination()
    return tables.read_bronze(spark, path).select(
        "nct_id",
        "overall_status",
        "brief_title",
        "last_update_post_date",
        "raw",
        F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp"),
    )


@query
def stream_rejects(spark, sf_dir):
    path, checkpoint = scratch(spark, "rejects"), scratch(spark, "checkpoint")
    source = P.versions_bus(spark, sf_dir, stream=True)
    streaming.start_rejects(source, path, checkpoint, once=True).awaitTermination()
    return tables.read_table(spark, path).select(
        "reason", F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp")
    )


@query
def stream_dedup(spark, sf_dir):
    """Every message delivered twice, in two drops; repeats left out by the stream."""
    drop, path, checkpoint = (scratch(spark, n) for n in ("drop", "once", "checkpoint"))
    for _ in range(2):
        bus.publish(P.versions_bus(spark, sf_dir), drop)
    parsed = envelope.accepted(
        envelope.parse_messages(bus.read_drop(spark, drop, maxFilesPerTrigger="8"))
    )
    job = (
        streaming.drop_repeats(parsed)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return tables.read_table(spark, path).select(
        "nct_id", "overall_status", "brief_title", "last_update_post_date", "raw"
    )


@query
def silver_upsert(spark, sf_dir):
    """Versions arriving in four batches; silver holds the newest of each trial."""
    events = P.table(spark, sf_dir, "events")
    arrivals, path, checkpoint = (scratch(spark, n) for n in ("arrivals", "silver", "checkpoint"))
    events.repartition(4).write.parquet(arrivals)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
    trials = staging.standardize_trials(P.versions_raw(stream))
    streaming.start_silver(trials, path, checkpoint, once=True, buckets=16).awaitTermination()
    return streaming.read_silver(spark, path, trials.schema)


def early_and_late(spark, sf_dir) -> list[DataFrame]:
    """Versions of the events' trials, with conditions, in two batches."""
    raw = P.versions_raw(P.table(spark, sf_dir, "events"))
    named = raw.withColumn("conditions", F.array("lead_sponsor_class", "healthy_volunteers", "lead_sponsor_class"))
    trials = staging.standardize_trials(named)
    early = F.col("ingest_timestamp") < F.lit("2024-01-15").cast("timestamp_ntz")
    return [trials.filter(early), trials.filter(~early)]


@query
def incremental_mart(spark, sf_dir):
    """The enrollment mart after two upserts, made of what they changed."""
    silver_path, counts = scratch(spark, "silver"), scratch(spark, "counts")
    words = conditions.keyword_dictionary(spark, P.EVENT_KEYWORDS)
    for i, batch in enumerate(early_and_late(spark, sf_dir)):
        streaming.upsert_silver(batch, i, silver_path, buckets=8, after=upkeep.keep_counts(counts, words, parts=8))
    return upkeep.enrollment_mart(spark, counts, P.AS_OF)


@query
def silver_changes(spark, sf_dir):
    """The rows that the second upsert replaced and those it put in their place."""
    path, passed = scratch(spark, "silver"), []
    for i, batch in enumerate(early_and_late(spark, sf_dir)):
        def keep(changes, name):
            passed.append(stored(changes, "changes"))
        streaming.upsert_silver(batch, i, path, buckets=8, after=keep)
    return passed[-1].select("nct_id", "overall_status", "phase", "ingest_timestamp", "enrollment_count", "sign")


@query
def stream_volume(spark, sf_dir):
    """Events per day of event time: a drop with 19 of 20, then, after a restart, the others; what is late is counted apart."""
    events = P.table(spark, sf_dir, "events")
    arrivals, path = scratch(spark, "arrivals"), scratch(spark, "volume")
    held_back = F.col("event_id") % 20 == 0
    for part in (events.filter(~held_back), events.filter(held_back)):
        part.write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(events.schema).parquet(arrivals)
        for job in streaming.start_daily_volume(stream, "ts", path, once=True):
            job.awaitTermination()
    return streaming.daily_volume(spark, path)


@query
def stream_suite(spark, sf_dir):
    """The bronze suite over versions that stream in three micro-batches: its result over all of them."""
    events = P.table(spark, sf_dir, "events")
    arrivals, path, checkpoint, out = (scratch(spark, n) for n in ("arrivals", "suite", "checkpoint", "out"))
    events.repartition(3).write.parquet(arrivals)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
    watch = streaming.SuiteWatch(spark, checks.BRONZE_SUITE, path)
    rows = watch.over(P.versions_raw(stream)).select("nct_id")
    job = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    job = job.trigger(availableNow=True).start()
    job.awaitTermination()
    watch.finish(job)
    n = F.lit(watch.batches().filter("n > 0").count()).cast("bigint").alias("batches")
    return watch.totals().drop("params").select("*", n)


# --- conditions ---------------------------------------------------------------------
@query
def condition_bridge(spark, sf_dir):
    """One row per different element of the studies' condition arrays."""
    flat = envelope.flatten_studies(P.studies(spark, sf_dir))
    return conditions.explode_distinct(flat, "conditions", "condition_name", ["nct_id"])


@query
def condition_category(spark, sf_dir):
    named = P.conditions(spark, sf_dir).select("nct_id", "condition_name").distinct()
    return conditions.categorize(named, conditions.keyword_dictionary(spark, P.NOUN_KEYWORDS))


@query
def condition_category_large(spark, sf_dir):
    """A dictionary of the different part names and their last words, some null: phrases and words."""
    named = P.conditions(spark, sf_dir).select("nct_id", "condition_name").distinct()
    part = P.table(spark, sf_dir, "part")
    size = (F.col("p_partkey") % 3).cast("string")
    phrases = part.select(
        F.when(F.col("p_partkey") % 7 != 0, F.upper("p_name")).alias("keyword"), F.concat(F.lit("phrase "), size).alias("category")
    )
    words = part.select(
        F.element_at(F.split("p_name", " "), -1).alias("keyword"), F.concat(F.lit("word "), size).alias("category")
    )
    return conditions.categorize(named, phrases.unionByName(words))


# --- quality -------------------------------------------------------------------------
@query
def bronze_suite(spark, sf_dir):
    return checks.run_suite(P.trials_raw(spark, sf_dir), checks.BRONZE_SUITE).drop("params")


@query
def silver_suite(spark, sf_dir):
    trials = stored(silver(spark, sf_dir), "trials")
    bridge = stored(P.conditions(spark, sf_dir).select("nct_id"), "bridge")
    bridge = checks.run_suite(bridge, checks.BRIDGE_SUITE, {"stg_trials": trials})
    return checks.run_suite(trials, checks.SILVER_SUITE).unionByName(bridge).drop("params")


@query
def model_tests(spark, sf_dir):
    trials = stored(silver(spark, sf_dir), "trials")
    results = checks.run_model_tests(
        {
            "trials_raw": stored(P.versions_raw(P.table(spark, sf_dir, "events")), "versions"),
            "stg_trials": trials,
            "trial_enrollment_mart": marts.enrollment_mart(
                trials, P.conditions(spark, sf_dir), P.AS_OF
            ),
        }
    )
    return results.select(
        "model",
        "check_name",
        "severity",
        F.col("n_unexpected").alias("n_failures"),
        "success",
    )


@query
def ri_violations(spark, sf_dir):
    """Trials without any condition."""
    trials = P.trials_raw(spark, sf_dir).select("nct_id")
    return checks.ri_violations(trials, P.conditions(spark, sf_dir), "nct_id")


@query
def volume_anomaly(spark, sf_dir):
    days = monitor.daily_counts(P.table(spark, sf_dir, "events"), F.col("ts").cast("date"))
    found = monitor.volume_anomaly(days, k=7, z=1.5)
    return found.select(
        "day",
        "n",
        F.round("mean", 6).alias("mean"),
        F.round("spread", 6).alias("spread"),
        "is_anomaly",
    )


@query
def freshness(spark, sf_dir):
    return monitor.freshness(
        P.table(spark, sf_dir, "events"), "ts", dt.timedelta(days=1), dt.datetime(2024, 2, 1)
    )


@query
def sketched_days(spark, sf_dir):
    """Different users and quartiles of the values of some days by type, from sketches of each day, beside the exact ones."""
    events = P.table(spark, sf_dir, "events")
    path = scratch(spark, "sketches")
    sketches.daily_sketches(events, F.col("ts").cast("date"), ["event_type"], "user_id", "value").write.parquet(path)
    first, last = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
    got = sketches.over_days(tables.read_table(spark, path), first, last, ["event_type"])
    days = events.filter(F.col("ts").cast("date").between(F.lit(first), F.lit(last)))
    users = days.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    # How many values lie below and up to each estimate: the rank asked for has to be near.
    estimates = got.select("event_type", "n_values", F.posexplode("quantiles").alias("i", "q"))
    ranks = days.join(F.broadcast(estimates), "event_type").groupBy("event_type", "i", "n_values").agg(
        F.count_if(F.col("value") < F.col("q")).alias("below"), F.count_if(F.col("value") <= F.col("q")).alias("upto")
    )
    wanted = F.element_at(F.array(*map(F.lit, sketches.QUARTILES)), F.col("i") + 1) * F.col("n_values")
    slack = F.lit(sketches.rank_error()) * F.col("n_values") + 1
    near = (F.col("below") - slack <= wanted) & (wanted <= F.col("upto") + slack)
    ranks = ranks.groupBy("event_type").agg(F.bool_and(near).alias("quartiles_hold"))
    bound = F.lit(sketches.distinct_error()) * F.col("users") + 0.5
    return got.join(users, "event_type").join(ranks, "event_type").select(
        "event_type", "n", "users", (F.abs(F.col("n_distinct") - F.col("users")) <= bound).alias("users_hold"), "quartiles_hold"
    )


# --- features and models ---------------------------------------------------------------
def trial_rows(spark, sf_dir) -> DataFrame:
    return features.fill_features(
        features.trial_features(silver(spark, sf_dir), P.conditions(spark, sf_dir), P.AS_OF),
        features.TRIAL_CATEGORICAL,
    )


@query
def mart_features(spark, sf_dir):
    mart = marts.enrollment_mart(silver(spark, sf_dir), P.conditions(spark, sf_dir), P.AS_OF)
    return features.fill_features(features.mart_features(mart))


@query
def trial_features(spark, sf_dir):
    return trial_rows(spark, sf_dir)


@query
def feature_matrix(spark, sf_dir):
    rows = stored(trial_rows(spark, sf_dir), "features")
    codes = features.write_label_codes(
        rows, features.TRIAL_CATEGORICAL, scratch(spark, "labels")
    )
    return features.encode_labels(rows, codes, features.TRIAL_CATEGORICAL)


@query
def stratified_split(spark, sf_dir):
    rows = stored(trial_rows(spark, sf_dir).select("nct_id", features.TARGET), "features")
    return features.stratified_split(rows, ["nct_id"], features.TARGET)


@query
def balanced_weights(spark, sf_dir):
    rows = trial_rows(spark, sf_dir).select(features.TARGET)
    return (
        learn.balanced_weights(rows)
        .groupBy(features.TARGET)
        .agg(F.count("*").alias("n"), F.round(F.max("w"), 9).alias("weight"))
    )


def scored(spark, sf_dir) -> DataFrame:
    """Predictions by a rule over the trial rows, in place of a model: what SQL can follow."""
    rows = trial_rows(spark, sf_dir)
    probability = (F.col("enrollment_count") % 1000) / 1000.0
    return rows.select(
        "nct_id",
        F.when(probability >= 0.4, 1).otherwise(0).alias("predicted_completed"),
        probability.alias("completion_probability"),
        F.col(features.TARGET).alias("actual"),
    )


@query
def model_metrics(spark, sf_dir):
    """Accuracy, AUC, weighted F1 and error of the rule's predictions."""
    metrics = learn.evaluate(stored(scored(spark, sf_dir), "scored"))
    names = ["accuracy", "auc", "f1", "mae"]
    row = spark.createDataFrame([tuple(float(metrics[n]) for n in names)], ", ".join(f"{n} double" for n in names))
    return row.select(*(F.round(n, 9).alias(n) for n in names))


@query
def best_of_runs(spark, sf_dir):
    """The best of runs whose AUC is undefined for some: a run for each country, by its share of completed trials."""
    shares = trial_rows(spark, sf_dir).groupBy("location_country").agg(F.avg(features.TARGET).alias("share"))
    odd = F.pmod(F.length("location_country"), F.lit(2)) == 0
    runs = shares.select(
        F.col("location_country").alias("model_type"),
        F.regexp_extract("location_country", r"(\d+)$", 1).cast("int").alias("position"),
        F.when(odd, F.lit(float("nan"))).otherwise(F.round("share", 2)).alias("auc"),
    )
    return learn.best_run(runs)


@query
def predictions_csv(spark, sf_dir):
    """The rule's predictions, by way of the CSV they are handed on as."""
    path = scratch(spark, "predictions")
    tables.write_csv(scored(spark, sf_dir), path)
    return spark.read.schema(PREDICTIONS).option("header", True).csv(path)


PREDICTIONS = "nct_id string, predicted_completed int, completion_probability double, actual int"


@query
def assembled_features(spark, sf_dir):
    """The model's input vectors, taken apart again."""
    assembled = learn.assembler(features.TRIAL_FEATURES).transform(feature_matrix(spark, sf_dir))
    values = assembled.select("nct_id", vector_to_array("features").alias("v"))
    return values.select("nct_id", *(F.col("v")[i].alias(name) for i, name in enumerate(features.TRIAL_FEATURES)))


RUN_DATE = "2003-01-01"


def trained(spark, sf_dir, *models: str) -> str:
    """A folder with these models, trained on the trial rows."""
    root = scratch(spark, "learn")
    split = features.stratified_split(feature_matrix(spark, sf_dir), ["nct_id"], features.TARGET)
    learn.train_models(
        split, features.TRIAL_FEATURES, root, RUN_DATE, ["nct_id"], {m: {} for m in models}, features.TRIAL_CATEGORICAL
    )
    return root


def run_of(spark, sf_dir, model: str) -> DataFrame:
    """What can be said of a run whatever the trees: sizes, and metrics within their bounds."""
    runs = learn.read_runs(spark, trained(spark, sf_dir, model))
    bounded = [F.col(m).between(0, 1) for m in ("accuracy", "auc", "f1", "mae")]
    consistent = F.abs(F.col("accuracy") + F.col("mae") - 1) < 1e-9
    return runs.select(
        "model_type", "n_train", "n_test", reduce(lambda a, b: a & b, bounded, consistent).alias("metrics_hold")
    )


@query
def train_random_forest(spark, sf_dir):
    return run_of(spark, sf_dir, "random_forest")


@query
def train_gradient_boosting(spark, sf_dir):
    return run_of(spark, sf_dir, "gradient_boosting")


@query
def best_model(spark, sf_dir):
    """Both models' runs, and whether the best one has the highest AUC."""
    runs = learn.read_runs(spark, trained(spark, sf_dir, *learn.MODELS))
    best = learn.best_run(runs).select(F.col("auc").alias("best"))
    return runs.agg(F.count("*").alias("n_runs"), F.max("auc").alias("highest")).join(best).select(
        "n_runs", (F.col("best") == F.col("highest")).alias("is_highest")
    )


@query
def model_predictions(spark, sf_dir):
    """The best model's predictions of the test rows, by way of their CSV; scores within their bounds."""
    path = scratch(spark, "predictions")
    tables.write_csv(learn.best_predictions(spark, trained(spark, sf_dir, *learn.MODELS), RUN_DATE), path)
    rows = spark.read.schema(PREDICTIONS).option("header", True).csv(path)
    agree = (F.col("completion_probability") > 0.5) == (F.col("predicted_completed") == 1)
    holds = F.col("completion_probability").between(0, 1) & F.col("predicted_completed").isin(0, 1)
    return rows.select("nct_id", "actual", (holds & (agree | (F.col("completion_probability") == 0.5))).alias("holds"))


@query
def feature_importances(spark, sf_dir):
    """Each feature's share, and whether the shares make up a whole."""
    root = trained(spark, sf_dir, "random_forest")
    model = learn.PipelineModel.load(f"{root}/models/random_forest/{RUN_DATE}")
    shares = learn.importances(model, spark, features.TRIAL_FEATURES)
    whole = F.abs(F.sum("importance").over(Window.partitionBy()) - 1) < 1e-9
    return shares.select("feature", (F.col("importance").between(0, 1) & whole).alias("holds"))


SMALL = {"random_forest": {"numTrees": 20, "maxDepth": 6}, "gradient_boosting": {"maxIter": 15, "maxDepth": 4}}


@query
def learned_rule(spark, sf_dir):
    """Both models on rows whose outcome follows from phase and size but for one in ten: whether they have learned it."""
    early = F.col("phase").isin("phase 1/phase 2", "early phase 1")
    rule = early | (F.col("enrollment_count") > 1500)
    odd = F.crc32("nct_id") % 10 == 0
    rows = stored(trial_rows(spark, sf_dir).withColumn(features.TARGET, (rule != odd).cast("int")), "features")
    codes = features.write_label_codes(rows, features.TRIAL_CATEGORICAL, scratch(spark, "labels"))
    coded = features.encode_labels(rows, codes, features.TRIAL_CATEGORICAL)
    split = features.stratified_split(coded, ["nct_id"], features.TARGET)
    runs = learn.train_models(
        split, features.TRIAL_FEATURES, scratch(spark, "learn"), RUN_DATE, ["nct_id"], SMALL, features.TRIAL_CATEGORICAL
    )
    # Guessing gives an AUC of 0.5; who knows the rule has about 0.9 of both.
    learned = (F.col("auc") >= 0.75) & (F.col("accuracy") >= 0.8) & (F.col("mae") <= 0.2)
    return runs.select("model_type", (F.col("n_train") + F.col("n_test")).alias("n_rows"), learned.alias("learned"))


@query
def open_trial_scores(spark, sf_dir):
    """Open trials scored by a stored model that was trained on closed ones; some have a country it hasn't seen."""
    root, trials, bridge = scratch(spark, "scorers"), stored(silver(spark, sf_dir), "trials"), P.conditions(spark, sf_dir)
    closed = stored(trial_rows(spark, sf_dir), "features")
    model = scoring.fit("random_forest", closed, **SMALL["random_forest"])
    scoring.store(model, root, "random_forest", RUN_DATE)
    new_country = F.when(P.order_number() % 7 == 0, "Atlantis").otherwise(F.col("location_country"))
    rows = features.trial_features(trials.withColumn("location_country", new_country), bridge, P.AS_OF, open_trials=True)
    rows = features.fill_features(rows, features.TRIAL_CATEGORICAL)
    got = scoring.score(scoring.load(spark, root, "random_forest", "2004-01-01"), rows, ["nct_id", "location_country"])
    p = F.col("completion_probability")
    holds = p.between(0, 1) & (F.col("predicted_completed") == (p > 0.5).cast("int"))
    return got.select("nct_id", "location_country", (holds | (p == 0.5)).alias("holds"))


@query
def sql_mart(spark, sf_dir):
    """The enrollment mart as a query text over views, whose silver is SQL over the raw trials."""
    views.register(spark, trials_raw=P.trials_raw(spark, sf_dir), stg_conditions=P.conditions(spark, sf_dir))
    return views.enrollment_mart(spark, P.AS_OF)


# --- layout, whole run ---------------------------------------------------------------------
@query
def warehouse_layout(spark, sf_dir):
    """Silver as a table bucketed by trial and sorted by completion, read back."""
    path = scratch(spark, "warehouse")
    table = f"trials_{path[-8:]}"
    buckets = tables.buckets_for(P.table(spark, sf_dir, "orders"), least=8)
    tables.write_clustered(silver(spark, sf_dir), table, path, buckets=buckets)
    return spark.table(table)


@query
def bucketed_mart(spark, sf_dir):
    """The enrollment mart of trials and bridge that are bucketed alike by trial."""
    path = scratch(spark, "warehouse")
    named = [f"{name}_{path[-8:]}" for name in ("trials", "bridge")]
    # A trial comes from an order, a row of the bridge from a line item.
    buckets = tables.buckets_for(*(P.table(spark, sf_dir, t) for t in ("orders", "lineitem")), least=8)
    tables.write_clustered(silver(spark, sf_dir), named[0], f"{path}/trials", buckets=buckets)
    tables.write_clustered(
        P.conditions(spark, sf_dir), named[1], f"{path}/bridge", sort="condition_category", buckets=buckets
    )
    return marts.enrollment_mart(spark.table(named[0]), spark.table(named[1]), P.AS_OF)


@query
def silver_updates(spark, sf_dir):
    """Two ingests, each followed by an upsert of what it brought into silver, the second by a new checkpoint."""
    layers = medallion.Layers(scratch(spark, "layers"))
    for day in (dt.date(2002, 1, 1), dt.date(2002, 1, 2)):
        medallion.ingest(spark, P.studies(spark, sf_dir), layers, day)
        trials = medallion.refine_updates(spark, layers, buckets=8, enforce=False)
        tables.remove(spark, layers.silver_checkpoint)
    return trials.select(
        *(c for c in SILVER_COLUMNS if c not in ("ingest_date", "ingest_timestamp"))
    )


@query
def silver_rebucketed(spark, sf_dir):
    """Versions upserted by two sources, with more buckets for the second."""
    events = P.versions_raw(P.table(spark, sf_dir, "events"))
    trials = staging.standardize_trials(events)
    early = F.col("ingest_timestamp") < F.lit("2024-01-15").cast("timestamp_ntz")
    path = scratch(spark, "silver")
    streaming.upsert_silver(trials.filter(early), 0, path, buckets=4, source="a")
    streaming.rebucket_silver(spark, path, trials.schema, 16)
    streaming.upsert_silver(trials.filter(~early), 0, path, buckets=16, source="b")
    return streaming.read_silver(spark, path, trials.schema)


@query
def medallion_run(spark, sf_dir):
    """Studies -> archive -> bus -> bronze stream -> silver -> enrollment mart, every gate shut."""
    layers = medallion.Layers(scratch(spark, "layers"))
    studies = P.studies(spark, sf_dir, P.trials_passing(spark, sf_dir))
    medallion.ingest(spark, studies, layers, dt.date(2002, 1, 1))
    medallion.refine(spark, layers, conditions.keyword_dictionary(spark, P.WORD_KEYWORDS))
    medallion.build_marts(spark, layers, P.AS_OF)
    return tables.read_table(spark, layers.gold("trial_enrollment_mart"))


@query
def incremental_run(spark, sf_dir):
    """Two days' whole runs on the upserted silver, gates shut; the second day brings all studies again."""
    layers = medallion.Layers(scratch(spark, "layers"))
    studies = P.studies(spark, sf_dir, P.trials_passing(spark, sf_dir))
    early = F.col("run_date") < F.lit(dt.date(1998, 1, 1))
    keywords = conditions.keyword_dictionary(spark, P.WORD_KEYWORDS)
    for part, day in ((studies.filter(early), dt.date(2002, 1, 1)), (studies, dt.date(2002, 1, 2))):
        medallion.ingest(spark, part, layers, day, since=dt.date(1900, 1, 1))
        medallion.refine_updates(spark, layers, keywords, buckets=8)
    medallion.build_marts(spark, layers, P.AS_OF, upserted=True)
    return tables.read_table(spark, layers.gold("trial_enrollment_mart"))
