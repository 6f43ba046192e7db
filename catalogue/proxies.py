"""Registry-shaped inputs projected from the generic test tables.

The tables hold no nulls and no malformed text, so some values are spoilt by the
remainder of the key. That changes values only: every row of every table goes
through. `oracles.py` states the same projections in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.schemas import REGISTRY_STATUSES

AS_OF = "2003-01-01"
RUN_DAY = "2001-08-15"

# Condition keywords for the nouns the part names are made of.
NOUN_KEYWORDS = {
    "ring": "cardiology",
    "bolt": "oncology",
    "gear": "neurology",
    "widget": "oncology",
    "small": "respiratory",
}
# Condition keywords for the words the studies' condition arrays hold.
WORD_KEYWORDS = {"yes": "endocrinology", "household": "oncology", "machinery": "cardiology"}

# Condition keywords for the conditions made of events.
EVENT_KEYWORDS = {"click": "cardiology", "view": "neurology", "yes": "endocrinology"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry_id(key: Column) -> Column:
    """`NCT` and at least eight digits; a longer key is never cut."""
    digits = key.cast("string")
    return F.concat(F.lit("NCT"), F.repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.length(digits))), digits)


def day_text(moment: Column) -> Column:
    return moment.cast("date").cast("string")


def trials_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One untyped trial record per order, with its sponsor and country."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").join(
        nation, customer.c_nationkey == nation.n_nationkey, "left"
    )
    k = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    status = F.col("o_orderstatus")
    priority = F.col("o_orderpriority")
    return joined.select(
        registry_id(k).alias("nct_id"),
        F.when(k % 29 == 0, None)
        .when(status == "F", " Completed ")
        .when(status == "O", "Recruiting")
        .when(status == "P", "TERMINATED")
        .alias("overall_status"),
        F.when(F.col("c_acctbal") < 0, " Observational")
        .otherwise("INTERVENTIONAL ")
        .alias("study_type"),
        F.when(priority == "1-URGENT", "Early Phase 1")
        .when(priority == "2-HIGH", " Phase 1/Phase 2 ")
        .when(priority == "3-MEDIUM", "PHASE 2")
        .when(priority == "5-LOW", "Phase 4")
        .alias("phase"),
        F.concat(F.lit("Study "), k.cast("string")).alias("brief_title"),
        F.concat_ws(" / ", F.col("c_name"), priority).alias("official_title"),
        F.when(k % 17 == 0, "not a date").otherwise(day_text(day)).alias("start_date"),
        F.when(k % 11 == 0, None).otherwise(day_text(F.date_add(day, 90))).alias("completion_date"),
        F.when(k % 19 == 0, "2001-05").otherwise(day_text(F.date_add(day, 30))).alias(
            "last_update_post_date"
        ),
        F.when(k % 23 == 0, "abc")
        .otherwise(F.floor(F.col("o_totalprice") / 100).cast("int").cast("string"))
        .alias("enrollment_count"),
        F.col("c_name").alias("lead_sponsor_name"),
        F.concat(F.lower("c_mktsegment"), F.lit(" ")).alias("lead_sponsor_class"),
        F.concat(F.lit(" "), F.col("n_name")).alias("location_country"),
        F.concat(F.lit(" "), (F.lit(18) + F.col("c_nationkey")).cast("string"), F.lit(" Years")).alias(
            "minimum_age"
        ),
        F.lit("65 Years ").alias("maximum_age"),
        F.when(F.col("o_custkey") % 3 == 0, "ALL ")
        .when(F.col("o_custkey") % 3 == 1, " Female")
        .otherwise("Male")
        .alias("sex"),
        F.when(priority == "5-LOW", " YES").otherwise("No").alias("healthy_volunteers"),
        F.date_add(day, 31).alias("ingest_date"),
        F.date_add(day, 31).cast("timestamp_ntz").alias("ingest_timestamp"),
    )


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The condition bridge: the different parts of every order."""
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return (
        lineitem.join(part, lineitem.l_partkey == part.p_partkey)
        .select("l_orderkey", "p_name", "p_type")
        .distinct()
        .select(
            registry_id(F.col("l_orderkey")).alias("nct_id"),
            F.col("p_name").alias("condition_name"),
            F.col("p_type").alias("condition_category"),
        )
    )


def versions_raw(events: DataFrame) -> DataFrame:
    """Many untyped versions per trial: one per event, the user as the trial."""
    k = F.get_json_object("props", "$.k").cast("int")
    user = F.col("user_id")
    kind = F.col("event_type")
    day = F.col("ts").cast("date")
    phase = (
        F.when(k < 12, "Early Phase 1")
        .when(k < 24, "Phase 1/Phase 2")
        .when(k < 36, " phase 2/phase 3")
        .when(k < 48, "PHASE 1")
        .when(k < 60, "Phase 2 ")
        .when(k < 72, "phase 3")
        .when(k < 84, "Phase 4")
        .when(k < 92, "PHASE1")
        .otherwise(" ")
    )
    return events.select(
        registry_id(user).alias("nct_id"),
        F.when(kind == "click", " Recruiting ")
        .when(kind == "view", "Suspended")
        .when(kind == "purchase", "Completed")
        .when(kind == "error", "TERMINATED")
        .alias("overall_status"),
        F.when(F.col("value") >= 20, "Interventional ").otherwise(" OBSERVATIONAL").alias("study_type"),
        phase.alias("phase"),
        F.concat(F.lit("Study "), user.cast("string")).alias("brief_title"),
        F.col("props").alias("official_title"),
        F.when(k % 17 == 0, "01/15/2024").otherwise(day_text(F.date_sub(day, 400))).alias("start_date"),
        F.when(k % 11 == 0, None).otherwise(day_text(F.date_sub(day, 10))).alias("completion_date"),
        F.when(k % 10 == 0, "unknown").otherwise(day_text(day)).alias("last_update_post_date"),
        F.when(k % 23 == 0, "12.7")
        .otherwise(F.floor(F.col("value") * 10).cast("int").cast("string"))
        .alias("enrollment_count"),
        F.concat(F.lit(" Sponsor "), k.cast("string")).alias("lead_sponsor_name"),
        kind.alias("lead_sponsor_class"),
        F.concat(F.lit("Country "), (k % 7).cast("string"), F.lit(" ")).alias("location_country"),
        F.lit("18 Years").alias("minimum_age"),
        F.lit(None).cast("string").alias("maximum_age"),
        F.lit(" All").alias("sex"),
        F.when(k > 50, "yes ").otherwise("NO").alias("healthy_volunteers"),
        day.alias("ingest_date"),
        F.col("ts").alias("ingest_timestamp"),
    )


def order_number() -> Column:
    """The number in a trial's id."""
    return F.substring("nct_id", 4, 20).cast("bigint")


def scan_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials with update dates of every kind: readable, missing, partial, in slashes, far ahead."""
    k, day = order_number(), F.col("last_update_post_date")
    return trials_raw(spark, sf_dir).select(
        "nct_id",
        F.when(k % 31 == 0, None)
        .when(k % 37 == 0, "01/15/2024")
        .when(k % 41 == 0, "2999-01-01")
        .otherwise(day)
        .alias("last_update_post_date"),
    )


def trials_passing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped trials that pass the suites: all nine statuses, several countries, few bad counts."""
    k = order_number()
    raw = trials_raw(spark, sf_dir)
    statuses = F.array(*map(F.lit, REGISTRY_STATUSES))
    other = F.concat(F.lit("NATION_"), (k % 25).cast("string"))
    return raw.withColumns(
        {
            "overall_status": F.element_at(statuses, (k % 9 + 1).cast("int")),
            "enrollment_count": F.when(k % 211 == 0, "abc").otherwise((k % 5000).cast("string")),
            "location_countries": F.array("location_country", other, F.concat(other, F.lit(" "))),
        }
    )


def studies(spark: SparkSession, sf_dir: str, flat: DataFrame | None = None) -> DataFrame:
    """One nested study per order, as the registry nests it (column `study`).

    The quarter of its update stands for the run it came in with. `flat` are other
    trials than `trials_raw`.
    """
    flat = trials_raw(spark, sf_dir) if flat is None else flat
    countries = (
        F.transform("location_countries", lambda c: F.struct(c.alias("country")))
        if "location_countries" in flat.columns
        else F.array(F.struct(F.col("location_country").alias("country")))
    )

    def box(name):
        return F.struct(F.col(name).alias("date"))

    protocol = F.struct(
        F.struct(
            F.col("nct_id").alias("nctId"),
            F.col("brief_title").alias("briefTitle"),
            F.col("official_title").alias("officialTitle"),
        ).alias("identificationModule"),
        F.struct(
            F.col("overall_status").alias("overallStatus"),
            box("start_date").alias("startDateStruct"),
            box("completion_date").alias("completionDateStruct"),
            box("last_update_post_date").alias("lastUpdatePostDateStruct"),
        ).alias("statusModule"),
        F.struct(
            F.col("study_type").alias("studyType"),
            F.when(F.col("phase").isNotNull(), F.array("phase")).alias("phases"),
            F.struct(F.col("enrollment_count").alias("count")).alias("enrollmentInfo"),
        ).alias("designModule"),
        F.struct(
            F.array("healthy_volunteers", "lead_sponsor_class", "healthy_volunteers").alias("conditions"),
            F.array("phase").alias("keywords"),
        ).alias("conditionsModule"),
        F.struct(
            F.struct(
                F.col("lead_sponsor_name").alias("name"), F.col("lead_sponsor_class").alias("class")
            ).alias("leadSponsor")
        ).alias("sponsorCollaboratorsModule"),
        F.struct(
            F.col("minimum_age").alias("minimumAge"),
            F.col("maximum_age").alias("maximumAge"),
            F.col("sex"),
            F.col("healthy_volunteers").alias("healthyVolunteers"),
        ).alias("eligibilityModule"),
        F.struct(
            countries.alias("locations")
        ).alias("contactsLocationsModule"),
        F.struct(
            F.array(F.struct(F.col("brief_title").alias("measure"))).alias("primaryOutcomes")
        ).alias("outcomesModule"),
    )
    return flat.select(
        F.struct(protocol.alias("protocolSection")).alias("study"),
        F.trunc("ingest_date", "quarter").alias("run_date"),
    )


def versions_bus(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Bus messages made of the events: key, value, timestamp.

    Every `signup` body lacks an id and every `error` body is cut off, so both
    ways of being rejected occur.
    """
    if stream:
        schema = table(spark, sf_dir, "events").schema
        events = (
            spark.readStream.schema(schema)
            .option("pathGlobFilter", "events.parquet")
            .parquet(sf_dir)
        )
    else:
        events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    body = F.to_json(
        F.struct(
            F.when(kind != "signup", registry_id(F.col("user_id"))).alias("nctId"),
            F.when(kind != "view", F.initcap(kind)).alias("overallStatus"),
            F.concat(F.lit("Event "), F.col("event_id").cast("string")).alias("briefTitle"),
            day_text(F.col("ts")).alias("lastUpdatePostDate"),
            F.from_json("props", "k int").alias("raw"),
        )
    )
    return events.select(
        F.when(kind != "signup", registry_id(F.col("user_id"))).alias("key"),
        F.when(kind == "error", F.concat(F.lit("{"), body)).otherwise(body).alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
