"""Record schemas, controlled vocabularies and column groups."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the registry's controlled vocabularies -------------------
# Bronze keeps the registry's own spelling of a status.
REGISTRY_STATUSES = [
    "Recruiting",
    "Completed",
    "Terminated",
    "Withdrawn",
    "Active, not recruiting",
    "Not yet recruiting",
    "Enrolling by invitation",
    "Suspended",
    "Unknown status",
]
# Silver keeps phases in lower case, as `clean_phase` gives them.
SILVER_PHASES = [
    "phase 1",
    "phase 2",
    "phase 3",
    "phase 4",
    "phase 1/phase 2",
    "phase 2/phase 3",
    "early phase 1",
    "n/a",
]
# Values standing in for fields a study lacks.
UNKNOWN_ID = "UNKNOWN"
UNKNOWN_STATUS = "Unknown status"
# --- end of fixed values -----------------------------------------------------

# Silver statuses of a trial that will not change any more.
CLOSED_STATUSES = ["completed", "terminated", "withdrawn"]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S = T.StringType()
_DATE_BOX = _struct(date=_S)

# One study as the public registry API nests it. Counts and flags are read as
# text: typing them is the silver layer's work, and a bad value must not void
# the whole record.
RAW_STUDY = _struct(
    protocolSection=_struct(
        identificationModule=_struct(nctId=_S, briefTitle=_S, officialTitle=_S),
        statusModule=_struct(
            overallStatus=_S,
            startDateStruct=_DATE_BOX,
            completionDateStruct=_DATE_BOX,
            lastUpdatePostDateStruct=_DATE_BOX,
        ),
        designModule=_struct(
            studyType=_S, phases=T.ArrayType(_S), enrollmentInfo=_struct(count=_S)
        ),
        conditionsModule=_struct(conditions=T.ArrayType(_S), keywords=T.ArrayType(_S)),
        sponsorCollaboratorsModule=T.StructType(
            [T.StructField("leadSponsor", T.StructType([T.StructField("name", _S), T.StructField("class", _S)]))]
        ),
        eligibilityModule=_struct(minimumAge=_S, maximumAge=_S, sex=_S, healthyVolunteers=_S),
        contactsLocationsModule=_struct(locations=T.ArrayType(_struct(country=_S))),
        outcomesModule=_struct(primaryOutcomes=T.ArrayType(_struct(measure=_S))),
    )
)

# Where each flat column lies in a study; pass another mapping for another layout.
STUDY_PATHS = {
    "nct_id": "protocolSection.identificationModule.nctId",
    "brief_title": "protocolSection.identificationModule.briefTitle",
    "official_title": "protocolSection.identificationModule.officialTitle",
    "overall_status": "protocolSection.statusModule.overallStatus",
    "start_date": "protocolSection.statusModule.startDateStruct.date",
    "completion_date": "protocolSection.statusModule.completionDateStruct.date",
    "last_update_post_date": "protocolSection.statusModule.lastUpdatePostDateStruct.date",
    "study_type": "protocolSection.designModule.studyType",
    "phases": "protocolSection.designModule.phases",
    "enrollment_count": "protocolSection.designModule.enrollmentInfo.count",
    "conditions": "protocolSection.conditionsModule.conditions",
    "keywords": "protocolSection.conditionsModule.keywords",
    "lead_sponsor_name": "protocolSection.sponsorCollaboratorsModule.leadSponsor.name",
    "lead_sponsor_class": "protocolSection.sponsorCollaboratorsModule.leadSponsor.class",
    "minimum_age": "protocolSection.eligibilityModule.minimumAge",
    "maximum_age": "protocolSection.eligibilityModule.maximumAge",
    "sex": "protocolSection.eligibilityModule.sex",
    "healthy_volunteers": "protocolSection.eligibilityModule.healthyVolunteers",
    "location_countries": "protocolSection.contactsLocationsModule.locations.country",
    "primary_outcome_measures": "protocolSection.outcomesModule.primaryOutcomes.measure",
}

# One document per run: a wrapper around all studies of that run.
WRAPPED_ARCHIVE = T.StructType(
    [
        T.StructField("run_date", _S),
        T.StructField("count", T.LongType()),
        T.StructField("studies", T.ArrayType(RAW_STUDY)),
    ]
)

# The message on the bus. `raw` is the study's own JSON text: silver needs more
# fields than the four flat ones.
CORRUPT = "_corrupt"
MESSAGE = _struct(
    nctId=_S, overallStatus=_S, briefTitle=_S, lastUpdatePostDate=_S, raw=_S, **{CORRUPT: _S}
)

# Columns of the bus, as a topic source gives them.
BUS = T.StructType(
    [
        T.StructField("key", _S),
        T.StructField("value", _S),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("nct_id", _S),
        T.StructField("overall_status", _S),
        T.StructField("brief_title", _S),
        T.StructField("last_update_post_date", _S),
        T.StructField("raw", _S),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("ingest_timestamp", T.TimestampType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)

# Columns of the silver trial table, in order.
SILVER_COLUMNS = [
    "nct_id",
    "overall_status",
    "study_type",
    "phase",
    "brief_title",
    "official_title",
    "start_date",
    "completion_date",
    "last_update_post_date",
    "enrollment_count",
    "lead_sponsor_name",
    "lead_sponsor_class",
    "location_country",
    "minimum_age",
    "maximum_age",
    "sex",
    "healthy_volunteers",
    "ingest_date",
    "ingest_timestamp",
]

CHECK_RESULT = T.StructType(
    [
        T.StructField("check_name", _S),
        T.StructField("check_type", _S),
        T.StructField("column_name", _S),
        T.StructField("severity", _S),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_evaluated", T.LongType()),
        T.StructField("n_unexpected", T.LongType()),
        T.StructField("unexpected_pct", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("params", T.MapType(_S, _S)),
    ]
)
