"""The layers for people who write SQL: functions, views and the marts as query texts.

`register` makes the column helpers SQL functions of the session and the layers views;
`ENROLLMENT_MART` is a query text over these views that gives what `marts.enrollment_mart` gives. All of it is
Spark's own SQL, planned like any other query.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from cohortmill.functions import casts
from cohortmill.functions.text import COMPOUND_PHASES
from cohortmill.schemas import SILVER_PHASES


def _quoted(text: str) -> str:
    return "r'" + text + "'"


def _phases() -> str:
    none = "n/a"
    labels = [*COMPOUND_PHASES, *(p for p in SILVER_PHASES if p not in COMPOUND_PHASES and p != none)]
    return "CASE " + " ".join(f"WHEN contains(lower(text), '{p}') THEN '{p}'" for p in labels) + f" ELSE '{none}' END"


# Name, parameters, type, body.
FUNCTIONS = [
    ("clean_phase", "text STRING", "STRING", _phases()),
    ("strict_date", "text STRING", "DATE", f"CASE WHEN trim(text) RLIKE {_quoted(casts.FULL_DATE)} THEN try_cast(trim(text) AS DATE) END"),
    ("strict_int", "text STRING", "INT", f"CASE WHEN text RLIKE {_quoted(casts.WHOLE_NUMBER)} THEN try_cast(text AS INT) END"),
    ("open_days", "first DATE, last DATE, as_of DATE", "INT", "datediff(coalesce(last, as_of), first)"),
    ("share_pct", "part BIGINT, whole BIGINT", "DOUBLE", "CAST(part AS DOUBLE) * 100.0D / nullif(whole, 0)"),
]

# Silver from untyped trials in the view `trials_raw`, of which each trial has one row per version.
STG_TRIALS = """
SELECT * EXCEPT (newest) FROM (
  SELECT nct_id, lower(trim(overall_status)) AS overall_status, lower(trim(study_type)) AS study_type,
    clean_phase(phase) AS phase, brief_title, official_title, strict_date(start_date) AS start_date,
    strict_date(completion_date) AS completion_date, strict_date(last_update_post_date) AS last_update_post_date,
    strict_int(enrollment_count) AS enrollment_count, trim(lead_sponsor_name) AS lead_sponsor_name,
    upper(trim(lead_sponsor_class)) AS lead_sponsor_class, trim(location_country) AS location_country,
    trim(minimum_age) AS minimum_age, trim(maximum_age) AS maximum_age, lower(trim(sex)) AS sex,
    lower(trim(healthy_volunteers)) AS healthy_volunteers, ingest_date, ingest_timestamp,
    row_number() OVER (PARTITION BY nct_id ORDER BY strict_date(last_update_post_date) DESC NULLS LAST,
      ingest_timestamp DESC NULLS LAST) AS newest
  FROM trials_raw WHERE nct_id IS NOT NULL AND overall_status IS NOT NULL
) WHERE newest = 1
"""

# The enrollment mart over the views `stg_trials` and `stg_conditions`; `:as_of` is the day open studies run until, today if null.
ENROLLMENT_MART = """
WITH per_category AS (
  SELECT nct_id, condition_category, count(*) AS rows FROM stg_conditions GROUP BY nct_id, condition_category
), weighed AS (
  SELECT t.*, c.condition_category, coalesce(c.rows, 1) AS rows,
    open_days(t.start_date, t.completion_date, coalesce(CAST(:as_of AS DATE), current_date())) AS days
  FROM stg_trials t LEFT JOIN per_category c ON c.nct_id = t.nct_id
)
SELECT phase, condition_category, lead_sponsor_class, location_country, count(*) AS trial_count,
  sum(enrollment_count * rows) AS total_enrollment,
  CAST(sum(enrollment_count * rows) AS DOUBLE) / CAST(sum(rows) FILTER (WHERE enrollment_count IS NOT NULL) AS DOUBLE)
    AS avg_enrollment,
  percentile(enrollment_count, 0.5D, rows) AS median_enrollment,
  CAST(sum(days * rows) AS DOUBLE) / CAST(sum(rows) FILTER (WHERE days IS NOT NULL) AS DOUBLE) AS avg_duration_days,
  share_pct(coalesce(sum(rows) FILTER (WHERE overall_status = 'completed'), 0), sum(rows)) AS completion_rate_pct,
  share_pct(coalesce(sum(rows) FILTER (WHERE overall_status = 'terminated'), 0), sum(rows)) AS termination_rate_pct
FROM weighed
GROUP BY phase, condition_category, lead_sponsor_class, location_country
"""


def register_functions(spark: SparkSession) -> None:
    """The column helpers as temporary SQL functions."""
    for name, parameters, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")


def register(spark: SparkSession, **layers: DataFrame) -> None:
    """The functions, and a view of each layer by its name; `stg_trials` is made of `trials_raw` if it isn't given."""
    register_functions(spark)
    for name, df in layers.items():
        df.createOrReplaceTempView(name)
    if "trials_raw" in layers and "stg_trials" not in layers:
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW stg_trials AS {STG_TRIALS}")


def enrollment_mart(spark: SparkSession, as_of: dt.date | str | None = None) -> DataFrame:
    """The mart's query text over the registered views; open studies run until `as_of`, or today."""
    day = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return spark.sql(ENROLLMENT_MART, args={"as_of": day})
