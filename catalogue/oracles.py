"""An independent SQL statement for each registered query that has one."""

from __future__ import annotations

AS_OF = "DATE '2003-01-01'"


def _id(key: str) -> str:
    text = f"CAST({key} AS VARCHAR)"
    return f"('NCT' || repeat('0', greatest(0, 8 - length({text}))::INTEGER) || {text})"


# --- inputs over the base tables, as in proxies.py ---------------------------
TRIALS_RAW = f"""
trials_raw AS (
  SELECT {_id('o_orderkey')} AS nct_id,
    CASE WHEN o_orderkey % 29 = 0 THEN NULL
         WHEN o_orderstatus = 'F' THEN ' Completed '
         WHEN o_orderstatus = 'O' THEN 'Recruiting'
         WHEN o_orderstatus = 'P' THEN 'TERMINATED' END AS overall_status,
    CASE WHEN c_acctbal < 0 THEN ' Observational' ELSE 'INTERVENTIONAL ' END AS study_type,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Early Phase 1' WHEN '2-HIGH' THEN ' Phase 1/Phase 2 '
         WHEN '3-MEDIUM' THEN 'PHASE 2' WHEN '5-LOW' THEN 'Phase 4' END AS phase,
    'Study ' || CAST(o_orderkey AS VARCHAR) AS brief_title,
    concat_ws(' / ', c_name, o_orderpriority) AS official_title,
    CASE WHEN o_orderkey % 17 = 0 THEN 'not a date'
         ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS start_date,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL
         ELSE CAST(CAST(o_orderdate AS DATE) + 90 AS VARCHAR) END AS completion_date,
    CASE WHEN o_orderkey % 19 = 0 THEN '2001-05'
         ELSE CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) END AS last_update_post_date,
    CASE WHEN o_orderkey % 23 = 0 THEN 'abc'
         ELSE CAST(CAST(floor(o_totalprice / 100) AS INTEGER) AS VARCHAR) END AS enrollment_count,
    c_name AS lead_sponsor_name,
    lower(c_mktsegment) || ' ' AS lead_sponsor_class,
    ' ' || n_name AS location_country,
    ' ' || CAST(18 + c_nationkey AS VARCHAR) || ' Years' AS minimum_age,
    '65 Years ' AS maximum_age,
    CASE o_custkey % 3 WHEN 0 THEN 'ALL ' WHEN 1 THEN ' Female' ELSE 'Male' END AS sex,
    CASE WHEN o_orderpriority = '5-LOW' THEN ' YES' ELSE 'No' END AS healthy_volunteers,
    CAST(o_orderdate AS DATE) + 31 AS ingest_date,
    CAST(CAST(o_orderdate AS DATE) + 31 AS TIMESTAMP) AS ingest_timestamp
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

VERSIONS_RAW = f"""
versions_raw AS (
  SELECT {_id('user_id')} AS nct_id,
    CASE event_type WHEN 'click' THEN ' Recruiting ' WHEN 'view' THEN 'Suspended'
         WHEN 'purchase' THEN 'Completed' WHEN 'error' THEN 'TERMINATED' END AS overall_status,
    CASE WHEN value >= 20 THEN 'Interventional ' ELSE ' OBSERVATIONAL' END AS study_type,
    CASE WHEN k < 12 THEN 'Early Phase 1' WHEN k < 24 THEN 'Phase 1/Phase 2'
         WHEN k < 36 THEN ' phase 2/phase 3' WHEN k < 48 THEN 'PHASE 1' WHEN k < 60 THEN 'Phase 2 '
         WHEN k < 72 THEN 'phase 3' WHEN k < 84 THEN 'Phase 4' WHEN k < 92 THEN 'PHASE1' ELSE ' ' END AS phase,
    'Study ' || CAST(user_id AS VARCHAR) AS brief_title,
    props AS official_title,
    CASE WHEN k % 17 = 0 THEN '01/15/2024' ELSE CAST(CAST(ts AS DATE) - 400 AS VARCHAR) END AS start_date,
    CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) - 10 AS VARCHAR) END AS completion_date,
    CASE WHEN k % 10 = 0 THEN 'unknown' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS last_update_post_date,
    CASE WHEN k % 23 = 0 THEN '12.7' ELSE CAST(CAST(floor(value * 10) AS INTEGER) AS VARCHAR) END AS enrollment_count,
    ' Sponsor ' || CAST(k AS VARCHAR) AS lead_sponsor_name,
    event_type AS lead_sponsor_class,
    'Country ' || CAST(k % 7 AS VARCHAR) || ' ' AS location_country,
    '18 Years' AS minimum_age,
    CAST(NULL AS VARCHAR) AS maximum_age,
    ' All' AS sex,
    CASE WHEN k > 50 THEN 'yes ' ELSE 'NO' END AS healthy_volunteers,
    CAST(ts AS DATE) AS ingest_date,
    ts AS ingest_timestamp
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

CONDITIONS = f"""
conditions AS (
  SELECT DISTINCT {_id('l_orderkey')} AS nct_id, p_name AS condition_name, p_type AS condition_category
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

_PHASE = """CASE
      WHEN lower(trim(phase)) LIKE '%early phase 1%' THEN 'early phase 1'
      WHEN lower(trim(phase)) LIKE '%phase 1/phase 2%' THEN 'phase 1/phase 2'
      WHEN lower(trim(phase)) LIKE '%phase 2/phase 3%' THEN 'phase 2/phase 3'
      WHEN regexp_matches(lower(trim(phase)), 'phase [1-4]')
        THEN 'phase ' || list_min(regexp_extract_all(lower(trim(phase)), 'phase ([1-4])', 1))
      ELSE 'n/a' END"""


def _date(name: str) -> str:
    return (
        f"CASE WHEN regexp_matches(trim({name}), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN try_cast(trim({name}) AS DATE) END"
    )


def _standard(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT nct_id, lower(trim(overall_status)) AS overall_status, lower(trim(study_type)) AS study_type,
    {_PHASE} AS phase, brief_title, official_title,
    {_date('start_date')} AS start_date, {_date('completion_date')} AS completion_date,
    {_date('last_update_post_date')} AS last_update_post_date,
    CASE WHEN regexp_matches(enrollment_count, '^\\s*[+-]?[0-9]+\\s*$')
         THEN try_cast(enrollment_count AS INTEGER) END AS enrollment_count,
    trim(lead_sponsor_name) AS lead_sponsor_name, upper(trim(lead_sponsor_class)) AS lead_sponsor_class,
    trim(location_country) AS location_country, trim(minimum_age) AS minimum_age,
    trim(maximum_age) AS maximum_age, lower(trim(sex)) AS sex,
    lower(trim(healthy_volunteers)) AS healthy_volunteers, ingest_date, ingest_timestamp
  FROM {source} WHERE nct_id IS NOT NULL AND overall_status IS NOT NULL
)"""


_SILVER = """nct_id, overall_status, study_type, phase, brief_title, official_title, start_date,
  completion_date, last_update_post_date, enrollment_count, lead_sponsor_name, lead_sponsor_class,
  location_country, minimum_age, maximum_age, sex, healthy_volunteers, ingest_date, ingest_timestamp"""

# o_orderkey is unique, so the newest version of an order's trial is the trial.
STG = _standard("trials_raw", "stg")

_REST = [
    "overall_status", "study_type", "phase", "brief_title", "official_title", "start_date",
    "completion_date", "enrollment_count", "lead_sponsor_name", "lead_sponsor_class",
    "location_country", "minimum_age", "maximum_age", "sex", "healthy_volunteers", "ingest_date",
]
_TIES = ", ".join(f"{c} ASC NULLS LAST" for c in _REST)

STG_VERSIONS = (
    _standard("versions_raw", "std_versions")
    + f""",
stg_versions AS (
  SELECT {_SILVER} FROM (
    SELECT *, row_number() OVER (PARTITION BY nct_id ORDER BY last_update_post_date DESC NULLS LAST,
      ingest_timestamp DESC NULLS LAST, {_TIES}) AS r FROM std_versions) WHERE r = 1
)"""
)

JOINED = f"""
joined AS (
  SELECT t.*, c.condition_name, c.condition_category,
    date_diff('day', start_date, coalesce(completion_date, {AS_OF})) AS days,
    CASE WHEN overall_status = 'completed' THEN 1 ELSE 0 END AS done,
    CASE WHEN overall_status = 'terminated' THEN 1 ELSE 0 END AS ended
  FROM stg t LEFT JOIN conditions c USING (nct_id)
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_TRIALS = _with(TRIALS_RAW, STG)
_ALL = _with(TRIALS_RAW, STG, CONDITIONS, JOINED)

_MART_AGG = """count(DISTINCT nct_id) AS trial_count,
  CAST(sum(enrollment_count) AS BIGINT) AS total_enrollment, avg(enrollment_count) AS avg_enrollment,
  CAST(median(enrollment_count) AS DOUBLE) AS median_enrollment, avg(days) AS avg_duration_days,
  CAST(sum(done) AS DOUBLE) * 100.0::DOUBLE / nullif(count(*), 0) AS completion_rate_pct,
  CAST(sum(ended) AS DOUBLE) * 100.0::DOUBLE / nullif(count(*), 0) AS termination_rate_pct"""

_MART_KEYS = "phase, condition_category, lead_sponsor_class, location_country"


def _pct(part: str, whole: str = "count(*)") -> str:
    return f"CAST({part} AS DOUBLE) * 100.0::DOUBLE / nullif({whole}, 0)"


def _n(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


ORACLES: dict[str, str] = {
    "stg_trials": f"{_TRIALS} SELECT {_SILVER} FROM stg",
    "latest_version": """
        SELECT user_id, event_id, ts, event_type, value, props FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
        WHERE r = 1""",
    "stg_trials_dedup": f"{_with(VERSIONS_RAW, STG_VERSIONS)} SELECT * FROM stg_versions",
    "stg_conditions": f"{_with(CONDITIONS)} SELECT * FROM conditions",
    "stg_sponsors": """
        SELECT DISTINCT trim(c_name) AS lead_sponsor_name, upper(c_mktsegment) AS lead_sponsor_class
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "clean_phase_dist": f"""{_with(VERSIONS_RAW)}
        SELECT phase AS raw_phase, {_PHASE} AS phase, count(*) AS n FROM versions_raw GROUP BY 1, 2""",
    "enrollment_mart": f"{_ALL} SELECT {_MART_KEYS}, {_MART_AGG} FROM joined GROUP BY ALL",
    "enrollment_mart_trial_grain": f"""{_ALL} SELECT {_MART_KEYS}, {_MART_AGG}
        FROM (SELECT DISTINCT ON (nct_id, condition_category) * FROM joined) GROUP BY ALL""",
    "phase_outcomes": f"""{_TRIALS} SELECT phase, lead_sponsor_class, count(*) AS trial_count,
        {_n("overall_status = 'completed'")} AS completed_count,
        {_n("overall_status = 'terminated'")} AS terminated_count,
        {_n("overall_status = 'withdrawn'")} AS withdrawn_count,
        {_n("overall_status = 'suspended'")} AS suspended_count,
        {_pct(_n("overall_status = 'completed'"))} AS completion_rate_pct,
        {_pct(_n("overall_status = 'terminated'"))} AS termination_rate_pct,
        {_pct(_n("overall_status = 'withdrawn'"))} AS withdrawal_rate_pct,
        {_pct(_n("overall_status = 'suspended'"))} AS suspension_rate_pct
        FROM stg GROUP BY ALL""",
    "sponsor_activity": f"""{_TRIALS} SELECT lead_sponsor_name, count(*) AS trial_count,
        count(DISTINCT location_country) AS country_count,
        CAST(sum(enrollment_count) AS BIGINT) AS total_enrollment,
        {_n("overall_status = 'completed'")} AS completed_count,
        {_pct(_n("overall_status = 'completed'"))} AS completion_rate_pct,
        {_pct(_n("overall_status = 'completed'"),
              _n("overall_status IN ('completed', 'terminated', 'withdrawn')"))} AS success_rate_pct
        FROM stg GROUP BY ALL""",
    "top_sponsors": f"""{_TRIALS} SELECT lead_sponsor_name, count(*) AS trial_count,
        count(DISTINCT location_country) AS country_count
        FROM stg GROUP BY ALL ORDER BY trial_count DESC, lead_sponsor_name LIMIT 20""",
    "dropout_by_area": f"""{_ALL} SELECT condition_category, count(DISTINCT nct_id) AS trial_count,
        count(DISTINCT nct_id) FILTER (WHERE ended = 1) AS terminated_count,
        {_pct("count(DISTINCT nct_id) FILTER (WHERE ended = 1)", "count(DISTINCT nct_id)")} AS dropout_rate_pct
        FROM joined WHERE condition_category IS NOT NULL GROUP BY ALL
        ORDER BY dropout_rate_pct DESC, condition_category LIMIT 10""",
    "timeline_percentiles": f"""{_TRIALS} SELECT phase, lead_sponsor_class, count(*) AS trial_count,
        quantile_cont(days, 0.25) AS p25_days, quantile_cont(days, 0.5) AS p50_days,
        quantile_cont(days, 0.75) AS p75_days
        FROM (SELECT *, CAST(date_diff('day', start_date, coalesce(completion_date, {AS_OF})) AS DOUBLE) AS days
              FROM stg) WHERE days IS NOT NULL GROUP BY phase, lead_sponsor_class""",
    "design_completion": f"""{_TRIALS} SELECT study_type, phase, count(*) AS trial_count,
        {_n("overall_status = 'completed'")} AS completed_count,
        {_pct(_n("overall_status = 'completed'"))} AS completion_rate_pct FROM stg GROUP BY ALL""",
    "trials_by_country": f"""{_TRIALS} SELECT location_country AS country, count(*) AS trial_count,
        {_n("overall_status = 'recruiting'")} AS recruiting_count,
        CAST(sum(enrollment_count) AS BIGINT) AS total_enrollment
        FROM stg WHERE location_country IS NOT NULL GROUP BY ALL""",
    "geo_gaps": f"""{_ALL},
        seen AS (SELECT condition_name, location_country AS country, count(DISTINCT nct_id) AS n
                 FROM joined WHERE condition_name IS NOT NULL AND location_country IS NOT NULL GROUP BY ALL),
        places AS (SELECT n_name AS country, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey),
        active AS (SELECT DISTINCT condition_name, region FROM seen JOIN places USING (country))
        SELECT a.condition_name, p.region, p.country, coalesce(s.n, 0) AS trial_count
        FROM active a JOIN places p USING (region)
        LEFT JOIN seen s ON s.condition_name = a.condition_name AND s.country = p.country
        WHERE coalesce(s.n, 0) < 30""",
}

# --- raw archive, messages, streams -----------------------------------------------
_GOOD_EVENTS = f"""
good AS (
  SELECT {_id('user_id')} AS nct_id,
    CASE WHEN event_type <> 'view' THEN upper(event_type[1]) || event_type[2:] END AS overall_status,
    'Event ' || CAST(event_id AS VARCHAR) AS brief_title,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS last_update_post_date,
    '{{"k":' || json_extract_string(props, '$.k') || '}}' AS raw, ts
  FROM events WHERE event_type NOT IN ('signup', 'error')
)"""

_SCAN_RECORDS = f"""
records AS (
  SELECT *, {_date('last_update_post_date')} AS day FROM (
    SELECT nct_id, CASE WHEN k % 31 = 0 THEN NULL WHEN k % 37 = 0 THEN '01/15/2024' WHEN k % 41 = 0 THEN '2999-01-01'
      ELSE last_update_post_date END AS last_update_post_date
    FROM (SELECT *, CAST(nct_id[4:] AS BIGINT) AS k FROM trials_raw))
)"""

_EVENT_CONDITIONS = f"""
named AS (
  SELECT nct_id, unnest(list_distinct([lower(lead_sponsor_class), healthy_volunteers])) AS condition_name FROM stg_versions
),
with_category AS (
  SELECT t.*, CASE condition_name WHEN 'click' THEN 'cardiology' WHEN 'view' THEN 'neurology'
      WHEN 'yes' THEN 'endocrinology' ELSE 'other' END AS condition_category,
    date_diff('day', start_date, coalesce(completion_date, {AS_OF})) AS days,
    CASE WHEN overall_status = 'completed' THEN 1 ELSE 0 END AS done,
    CASE WHEN overall_status = 'terminated' THEN 1 ELSE 0 END AS ended
  FROM stg_versions t JOIN named USING (nct_id)
)"""

_CHANGED = "nct_id, overall_status, phase, ingest_timestamp, enrollment_count"

_STUDY_CONDITIONS = f"""
names AS (
  SELECT nct_id, healthy_volunteers AS condition_name FROM trials_raw
  UNION SELECT nct_id, lead_sponsor_class FROM trials_raw
)"""

ORACLES |= {
    "raw_archive_scan": f"""{_with(TRIALS_RAW)}
        SELECT nct_id, overall_status, brief_title, phase, enrollment_count, lead_sponsor_class, location_country,
          run_date, strftime(run_date, '%Y') AS year, strftime(run_date, '%m') AS month,
          strftime(run_date, '%d') AS day
        FROM (SELECT *, CAST(date_trunc('quarter', ingest_date) AS DATE) AS run_date FROM trials_raw)""",
    "incremental_scan": f"""{_with(TRIALS_RAW, _SCAN_RECORDS)},
        first AS (SELECT * FROM records WHERE day IS NULL OR day >= DATE '2001-08-15' - 30)
        SELECT nct_id, last_update_post_date, 1 AS scan FROM first
        UNION ALL SELECT nct_id, last_update_post_date, 2 FROM records
        WHERE day IS NULL OR day >= (SELECT max(day) FROM first WHERE day <= DATE '2001-08-15')""",
    "clustered_scan": f"""{_with(TRIALS_RAW, _SCAN_RECORDS)}
        SELECT nct_id, last_update_post_date, day AS update_day FROM records WHERE day IS NULL OR day >= DATE '2001-08-15'""",
    "ordered_scan": f"""{_with(TRIALS_RAW, _SCAN_RECORDS)}
        SELECT count(*) AS n, true AS is_ordered FROM records WHERE day IS NULL OR day >= DATE '2001-01-01'""",
    "wrapped_archive_scan": f"""{_with(TRIALS_RAW)}
        SELECT nct_id, overall_status, brief_title, phase, enrollment_count, location_country,
          CAST(date_trunc('quarter', ingest_date) AS DATE) AS run_date FROM trials_raw""",
    "topic_bytes": f"""{_with(_GOOD_EVENTS)}
        SELECT nct_id, overall_status, brief_title, last_update_post_date, raw FROM good""",
    "json_envelope": f"""{_with(TRIALS_RAW)}
        SELECT nct_id, coalesce(overall_status, 'Unknown status') AS overall_status, brief_title,
          last_update_post_date, phase, enrollment_count, lead_sponsor_name, sex FROM trials_raw""",
    "variant_studies": f"""{_with(TRIALS_RAW)}
        SELECT nct_id, coalesce(overall_status, 'Unknown status') AS overall_status, brief_title,
          last_update_post_date, phase, enrollment_count, lead_sponsor_name, sex, location_country,
          [healthy_volunteers, lead_sponsor_class, healthy_volunteers] AS conditions FROM trials_raw""",
    "schema_drift": f"""{_with(TRIALS_RAW)},
        s AS (SELECT CAST(date_trunc('quarter', ingest_date) AS DATE) AS day, CAST(nct_id[4:] AS BIGINT) AS k FROM trials_raw),
        found AS (
          SELECT day, '$.protocolSection.identificationModule.newTitle' AS path, 'new' AS change FROM s WHERE day = DATE '1996-01-01'
          UNION ALL SELECT day, '$.protocolSection.identificationModule.officialTitle', 'gone' FROM s WHERE day = DATE '1996-01-01'
          UNION ALL SELECT day, '$.protocolSection.extraModule', 'new' FROM s WHERE day <> DATE '1996-01-01' AND k % 50 = 0
          UNION ALL SELECT day, '$.protocolSection.eligibilityModule.sex', 'retyped' FROM s
            WHERE day <> DATE '1996-01-01' AND k % 50 <> 0 AND k % 40 = 0)
        SELECT day, path, change, count(*) AS n FROM found GROUP BY ALL""",
    "publish_counters": """
        SELECT count(*) FILTER (WHERE event_type <> 'signup') AS sent,
          count(*) FILTER (WHERE event_type = 'signup') AS failed,
          count(*) FILTER (WHERE event_type <> 'signup') AS landed FROM events""",
    "bronze_batch": f"""{_with(_GOOD_EVENTS)}
        SELECT CAST(ts AS DATE) AS ingest_date, overall_status, count(*) AS n FROM good GROUP BY ALL""",
    "bronze_compacted": f"""{_with(_GOOD_EVENTS)}
        SELECT nct_id, overall_status, brief_title, last_update_post_date, raw, CAST(ts AS DATE) AS ingest_date
        FROM good""",
    "partition_arrival": """
        SELECT d AS ingest_date,
          EXISTS (SELECT 1 FROM events WHERE CAST(ts AS DATE) = d AND event_type NOT IN ('signup', 'error')) AS arrived
        FROM (VALUES (DATE '2024-01-15'), (DATE '2024-02-15')) AS t(d)""",
    "stream_bronze": f"""{_with(_GOOD_EVENTS)}
        SELECT nct_id, overall_status, brief_title, last_update_post_date, raw, ts AS kafka_timestamp FROM good""",
    "stream_rejects": """
        SELECT CASE event_type WHEN 'error' THEN 'unparsable' ELSE 'no id' END AS reason, ts AS kafka_timestamp
        FROM events WHERE event_type IN ('signup', 'error')""",
    "stream_dedup": f"""{_with(_GOOD_EVENTS)}
        SELECT nct_id, overall_status, brief_title, last_update_post_date, raw FROM good""",
    "silver_upsert": f"{_with(VERSIONS_RAW, STG_VERSIONS)} SELECT * FROM stg_versions",
    "incremental_mart": f"""{_with(VERSIONS_RAW, STG_VERSIONS, _EVENT_CONDITIONS)}
        SELECT {_MART_KEYS}, {_MART_AGG} FROM with_category GROUP BY ALL""",
    "silver_changes": f"""{_with(VERSIONS_RAW, STG_VERSIONS)},
        before AS (SELECT {_SILVER} FROM (SELECT *, row_number() OVER (PARTITION BY nct_id
            ORDER BY last_update_post_date DESC NULLS LAST, ingest_timestamp DESC NULLS LAST, {_TIES}) AS r
          FROM std_versions WHERE ingest_timestamp < TIMESTAMP '2024-01-15') WHERE r = 1),
        late AS (SELECT nct_id FROM std_versions WHERE ingest_timestamp >= TIMESTAMP '2024-01-15'),
        old AS (SELECT * FROM before WHERE nct_id IN (SELECT nct_id FROM late)),
        new AS (SELECT * FROM stg_versions WHERE nct_id IN (SELECT nct_id FROM late))
        SELECT {_CHANGED}, 1 AS sign FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old)
        UNION ALL SELECT {_CHANGED}, -1 FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new)""",
    "stream_volume": """
        WITH e AS (SELECT CAST(ts AS DATE) AS day, event_id % 20 = 0 AS held, ts FROM events),
        marks AS (SELECT max(ts) FILTER (NOT held) - INTERVAL 1 DAY AS first, max(ts) - INTERVAL 1 DAY AS last FROM e),
        days AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM e)
        SELECT d.day, count(ts) FILTER (NOT held OR d.day + INTERVAL 1 DAY > m.first) AS n,
          count(ts) FILTER (held AND d.day + INTERVAL 1 DAY <= m.first) AS late,
          d.day + INTERVAL 1 DAY <= m.last AS is_closed
        FROM days d CROSS JOIN marks m LEFT JOIN e USING (day) GROUP BY d.day, m.first, m.last""",
    "condition_bridge": f"{_with(TRIALS_RAW, _STUDY_CONDITIONS)} SELECT * FROM names",
    "condition_category": f"""{_with(CONDITIONS)},
        words(word, category) AS (VALUES ('ring', 'cardiology'), ('bolt', 'oncology'), ('gear', 'neurology'),
          ('widget', 'oncology'), ('small', 'respiratory')),
        hits AS (SELECT p_name, min(category) AS category
                 FROM (SELECT DISTINCT p_name, unnest(string_split(lower(p_name), ' ')) AS word FROM part)
                 JOIN words USING (word) GROUP BY 1)
        SELECT DISTINCT nct_id, condition_name, coalesce(category, 'other') AS condition_category
        FROM conditions LEFT JOIN hits ON p_name = condition_name""",
    "condition_category_large": f"""{_with(CONDITIONS)},
        dictionary AS (
          SELECT lower(p_name) AS keyword, 'phrase ' || CAST(p_partkey % 3 AS VARCHAR) AS category FROM part
          WHERE p_partkey % 7 <> 0
          UNION ALL SELECT string_split(p_name, ' ')[-1], 'word ' || CAST(p_partkey % 3 AS VARCHAR) FROM part),
        keywords AS (SELECT keyword, min(category) AS category FROM dictionary GROUP BY 1),
        names AS (SELECT DISTINCT condition_name, string_split(lower(condition_name), ' ') AS w FROM conditions),
        runs AS (SELECT condition_name, array_to_string(w[i:i + n - 1], ' ') AS run
                 FROM names, (SELECT unnest(range(1, 8)) AS i), (SELECT unnest(range(1, 8)) AS n) WHERE i + n - 1 <= len(w)),
        hits AS (SELECT condition_name, min(category) AS category FROM runs JOIN keywords ON run = keyword GROUP BY 1)
        SELECT DISTINCT nct_id, condition_name, coalesce(category, 'other') AS condition_category
        FROM conditions LEFT JOIN hits USING (condition_name)""",
}


# --- quality ---------------------------------------------------------------------------
def _check(kind, column, evaluated, unexpected, mostly=1.0, severity="error", success=None) -> str:
    """One result row over a table `t` already in scope."""
    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    if success is None:
        success = f"(e = 0 OR (CAST(e - u AS DOUBLE) / e >= {mostly}::DOUBLE))"
    return f"""
      SELECT '{kind}:{column or 'table'}' AS check_name, '{kind}' AS check_type, {name} AS column_name,
        '{severity}' AS severity, n AS n_rows, e AS n_evaluated, u AS n_unexpected,
        CASE WHEN e <> 0 THEN u * 100.0::DOUBLE / e END AS unexpected_pct,
        {mostly}::DOUBLE AS threshold, {success} AS success
      FROM (SELECT count(*) AS n, {evaluated} AS e, CAST({unexpected} AS BIGINT) AS u FROM t)"""


_STATUSES = """('Recruiting', 'Completed', 'Terminated', 'Withdrawn', 'Active, not recruiting',
  'Not yet recruiting', 'Enrolling by invitation', 'Suspended', 'Unknown status')"""
_PHASES = """('phase 1', 'phase 2', 'phase 3', 'phase 4', 'phase 1/phase 2', 'phase 2/phase 3',
  'early phase 1', 'n/a')"""
_NOT_NULL = "expect_column_values_to_not_be_null"
_IN_SET = "expect_column_values_to_be_in_set"
_BETWEEN = "expect_column_values_to_be_between"


def _nulls(column, mostly=1.0, severity="error"):
    return _check(_NOT_NULL, column, "count(*)", _n(f"{column} IS NULL"), mostly, severity)


_BRONZE_CHECKS = " UNION ALL ".join(
    [
        _check("expect_table_row_count_to_be_between", None, "CAST(1 AS BIGINT)",
               "CASE WHEN count(*) BETWEEN 1 AND 1000000 THEN 0 ELSE 1 END", success="n BETWEEN 1 AND 1000000"),
        _check("expect_column_to_exist", "nct_id", "CAST(1 AS BIGINT)", "0"),
        _nulls("nct_id"),
        _check("expect_column_values_to_match_regex", "nct_id", "count(nct_id)",
               _n("NOT regexp_full_match(nct_id, 'NCT[0-9]{8}')"), 0.99),
        _nulls("overall_status", 0.99),
        _check(_IN_SET, "overall_status", "count(overall_status)", _n(f"overall_status NOT IN {_STATUSES}"), 0.95),
        _nulls("ingest_date"),
        _check(_BETWEEN, "enrollment_count", "count(enrollment_count)",
               _n("enrollment_count IS NOT NULL AND NOT coalesce(try_cast(enrollment_count AS DOUBLE) "
                  "BETWEEN 0 AND 1000000, false)"), 0.99),
        _check("date_format", "last_update_post_date", "count(last_update_post_date)",
               _n("NOT regexp_full_match(last_update_post_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}')"), 0.99, "warn"),
    ]
)

_UNIQUE_ROWS = "(SELECT coalesce(sum(k), 0) FROM (SELECT count(*) AS k FROM t WHERE nct_id IS NOT NULL GROUP BY nct_id) WHERE k > 1)"
_UNIQUE_KEYS = "(SELECT count(*) FROM (SELECT 1 FROM t WHERE nct_id IS NOT NULL GROUP BY nct_id HAVING count(*) > 1))"


def _over(source: str, *selects: str) -> str:
    return f"SELECT * FROM (WITH t AS (SELECT * FROM {source}) {' UNION ALL '.join(selects)})"


def _tests(model: str, source: str, *selects: str) -> str:
    return f"""SELECT '{model}' AS model, check_name, severity, n_unexpected AS n_failures, success
      FROM ({_over(source, *selects)})"""


ORACLES |= {
    "bronze_suite": f"{_with(TRIALS_RAW)} {_over('trials_raw', _BRONZE_CHECKS)}",
    "stream_suite": f"SELECT *, CAST(3 AS BIGINT) AS batches FROM ({_with(VERSIONS_RAW)} {_over('versions_raw', _BRONZE_CHECKS)})",
    "sketched_days": """
        SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, true AS users_hold, true AS quartiles_hold
        FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY ALL""",
    "silver_suite": f"""{_with(TRIALS_RAW, STG, CONDITIONS)}
        {_over('stg', _nulls('nct_id'),
               _check('unique', 'nct_id', 'count(nct_id)', _UNIQUE_ROWS),
               _check(_IN_SET, 'phase', 'count(phase)', _n(f'phase NOT IN {_PHASES}')))}
        UNION ALL
        {_over('conditions', _nulls('nct_id'),
               _check('referential_integrity', 'nct_id', 'count(nct_id)',
                      _n('nct_id NOT IN (SELECT nct_id FROM stg)')))}""",
    "model_tests": f"""{_with(TRIALS_RAW, VERSIONS_RAW, STG, CONDITIONS, JOINED)},
        mart AS (SELECT {_MART_KEYS}, {_MART_AGG} FROM joined GROUP BY ALL)
        {_tests('trials_raw', 'versions_raw', _nulls('nct_id'),
                _check('unique', 'nct_id', 'count(nct_id)', _UNIQUE_KEYS, severity='warn'),
                _nulls('overall_status'),
                _check(_IN_SET, 'overall_status', 'count(overall_status)', _n(f'overall_status NOT IN {_STATUSES}')))}
        UNION ALL
        {_tests('stg_trials', 'stg', _nulls('nct_id'),
                _check('unique', 'nct_id', 'count(nct_id)', _UNIQUE_KEYS), _nulls('overall_status'),
                _check(_IN_SET, 'phase', 'count(phase)', _n(f'phase NOT IN {_PHASES}')),
                _nulls('enrollment_count', severity='warn'),
                _check(_BETWEEN, 'enrollment_count', 'count(enrollment_count)',
                       _n('enrollment_count NOT BETWEEN 0 AND 1000000')))}
        UNION ALL
        {_tests('trial_enrollment_mart', 'mart', _nulls('trial_count'),
                _check(_BETWEEN, 'trial_count', 'count(trial_count)', _n('trial_count < 0')),
                _check(_BETWEEN, 'completion_rate_pct', 'count(completion_rate_pct)',
                       _n('completion_rate_pct NOT BETWEEN 0 AND 100')))}""",
    "ri_violations": f"""
        SELECT {_id('o_orderkey')} AS nct_id FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey = o_orderkey)""",
    "volume_anomaly": """
        WITH days AS (SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE),
                        INTERVAL 1 DAY)) AS DATE) AS day FROM events),
        daily AS (SELECT day, count(event_id) AS n FROM days LEFT JOIN events ON CAST(ts AS DATE) = day GROUP BY day),
        base AS (SELECT day, n, avg(n) OVER w AS mean, stddev_samp(n) OVER w AS spread FROM daily
                 WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
        SELECT day, n, round(mean, 6) AS mean, round(spread, 6) AS spread,
          coalesce(abs(n - mean) > 1.5 * spread, false) AS is_anomaly FROM base""",
    "freshness": """
        SELECT max(ts) AS newest, datesub('second', max(ts), TIMESTAMP '2024-02-01') AS age_seconds,
          CAST(86400 AS BIGINT) AS limit_seconds,
          datesub('second', max(ts), TIMESTAMP '2024-02-01') <= 86400 AS success FROM events""",
}


# --- features, layout, whole run ----------------------------------------------------------
_TRIAL_FEATURES = f"""
bridge AS (
  SELECT nct_id, min(condition_category) AS condition_category, count(*) AS n_conditions,
    count(DISTINCT condition_category) AS n_categories FROM conditions GROUP BY nct_id
),
feats AS (
  SELECT nct_id, coalesce(phase, 'unknown') AS phase,
    coalesce(lead_sponsor_class, 'unknown') AS lead_sponsor_class,
    coalesce(location_country, 'unknown') AS location_country,
    least(coalesce(enrollment_count, 0), 100000) AS enrollment_count,
    CAST(coalesce(date_diff('day', start_date, coalesce(completion_date, {AS_OF})), 365) AS INTEGER)
      AS study_duration_days,
    coalesce(sex, 'unknown') AS sex, coalesce(healthy_volunteers, 'unknown') AS healthy_volunteers,
    coalesce(condition_category, 'unknown') AS condition_category,
    coalesce(n_conditions, 0) AS n_conditions, coalesce(n_categories, 0) AS n_categories,
    CASE WHEN location_country IS NOT NULL THEN 1 ELSE 0 END AS n_countries,
    CASE WHEN overall_status = 'completed' THEN 1 ELSE 0 END AS is_completed
  FROM stg LEFT JOIN bridge USING (nct_id)
  WHERE overall_status IN ('completed', 'terminated', 'withdrawn')
)"""
_FEATS = _with(TRIALS_RAW, STG, CONDITIONS, _TRIAL_FEATURES)


# Trials that went through the message envelope, which fills a missing status.
_ENVELOPED = (
    TRIALS_RAW.replace("trials_raw AS", "spoilt AS"),
    "trials_raw AS (SELECT * REPLACE (coalesce(overall_status, 'Unknown status') AS overall_status) FROM spoilt)",
)


# Trials with all nine statuses and several countries.
_PASSING = (
    TRIALS_RAW.replace("trials_raw AS", "plain AS"),
    f"""trials_raw AS (
      SELECT * REPLACE (
          [{_STATUSES[1:-1]}][k % 9 + 1] AS overall_status,
          CASE WHEN k % 211 = 0 THEN 'abc' ELSE CAST(k % 5000 AS VARCHAR) END AS enrollment_count),
        'NATION_' || CAST(k % 25 AS VARCHAR) AS other_country
      FROM (SELECT *, CAST(nct_id[4:] AS BIGINT) AS k FROM plain))""",
    STG,
    """places AS (
      SELECT DISTINCT nct_id, trim(c) AS country
      FROM (SELECT nct_id, unnest([location_country, other_country]) AS c FROM trials_raw))""",
)


def _code(column: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY {column}) - 1 AS INTEGER) AS {column}"


ORACLES |= {
    "mart_features": f"""{_ALL},
        mart AS (SELECT {_MART_KEYS}, {_MART_AGG} FROM joined GROUP BY ALL)
        SELECT coalesce(phase, 'unknown') AS phase, condition_category,
          coalesce(lead_sponsor_class, 'unknown') AS lead_sponsor_class,
          coalesce(location_country, 'unknown') AS location_country,
          least(avg_enrollment, 100000) AS enrollment_count, avg_duration_days AS study_duration_days,
          'all' AS sex, 'no' AS healthy_volunteers,
          CASE WHEN completion_rate_pct > 50 THEN 1 ELSE 0 END AS is_completed
        FROM mart WHERE avg_enrollment IS NOT NULL AND avg_duration_days IS NOT NULL""",
    "trial_features": f"{_FEATS} SELECT * FROM feats",
    "feature_matrix": f"""{_FEATS}
        SELECT nct_id, {_code('phase')}, {_code('lead_sponsor_class')}, {_code('location_country')},
          enrollment_count, study_duration_days, {_code('sex')}, {_code('healthy_volunteers')},
          {_code('condition_category')}, n_conditions, n_categories, n_countries, is_completed FROM feats""",
    "stratified_split": f"""{_FEATS}
        SELECT nct_id, is_completed,
          row_number() OVER (PARTITION BY is_completed ORDER BY md5(nct_id || '|42'))
            <= count(*) OVER (PARTITION BY is_completed)
               - floor(count(*) OVER (PARTITION BY is_completed) * 0.2 + 0.5) AS is_train
        FROM feats""",
    "balanced_weights": f"""{_FEATS}
        SELECT is_completed, count(*) AS n,
          round((SELECT count(*) FROM feats) / (2.0::DOUBLE * count(*)), 9) AS weight FROM feats GROUP BY 1""",
    "warehouse_layout": f"{_TRIALS} SELECT {_SILVER} FROM stg",
    "silver_updates": f"""{_with(*_ENVELOPED, STG)}
        SELECT * EXCLUDE (ingest_date, ingest_timestamp) FROM stg""",
    "silver_rebucketed": f"{_with(VERSIONS_RAW, STG_VERSIONS)} SELECT * FROM stg_versions",
    **dict.fromkeys(
        ("medallion_run", "incremental_run"),
        f"""{_with(
            *_PASSING,
            _STUDY_CONDITIONS,
            """conditions AS (SELECT DISTINCT nct_id, lower(trim(condition_name)) AS condition_name,
                 CASE lower(trim(condition_name)) WHEN 'yes' THEN 'endocrinology' WHEN 'household' THEN 'oncology'
                 WHEN 'machinery' THEN 'cardiology' ELSE 'other' END AS condition_category FROM names)""",
            JOINED,
        )} SELECT {_MART_KEYS}, {_MART_AGG} FROM joined GROUP BY ALL""",
    ),
    "phase_outcomes_all_statuses": ORACLES["phase_outcomes"].replace(_TRIALS, _with(*_PASSING)),
    "sponsor_activity_countries": f"""{_with(*_PASSING)},
        reach AS (SELECT lead_sponsor_name, count(DISTINCT country) AS country_count
                  FROM stg JOIN places USING (nct_id) GROUP BY 1)
        SELECT lead_sponsor_name, count(*) AS trial_count, any_value(country_count) AS country_count,
          CAST(sum(enrollment_count) AS BIGINT) AS total_enrollment,
          {_n("overall_status = 'completed'")} AS completed_count,
          {_pct(_n("overall_status = 'completed'"))} AS completion_rate_pct,
          {_pct(_n("overall_status = 'completed'"),
                _n("overall_status IN ('completed', 'terminated', 'withdrawn')"))} AS success_rate_pct
        FROM stg JOIN reach USING (lead_sponsor_name) GROUP BY 1""",
    "trials_by_countries": f"""{_with(*_PASSING)}
        SELECT country, count(*) AS trial_count, {_n("overall_status = 'recruiting'")} AS recruiting_count,
          CAST(sum(enrollment_count) AS BIGINT) AS total_enrollment
        FROM stg JOIN places USING (nct_id) GROUP BY 1""",
    "geo_gaps_by_category": f"""{_with(*_PASSING, CONDITIONS)},
        seen AS (SELECT condition_category, country, count(DISTINCT nct_id) AS n
                 FROM stg JOIN places USING (nct_id) JOIN conditions USING (nct_id) GROUP BY ALL),
        listed AS (SELECT n_name AS country, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey),
        active AS (SELECT DISTINCT condition_category, region FROM seen JOIN listed USING (country))
        SELECT condition_category, region, l.country, coalesce(n, 0) AS trial_count
        FROM active JOIN listed l USING (region) LEFT JOIN seen USING (condition_category, country)
        WHERE coalesce(n, 0) < 1000000""",
}

# --- models: what can be said without the trees ------------------------------------------------
_SPLIT = f"""{_FEATS},
split AS (
  SELECT nct_id, is_completed,
    row_number() OVER (PARTITION BY is_completed ORDER BY md5(nct_id || '|42'))
      <= count(*) OVER (PARTITION BY is_completed)
         - floor(count(*) OVER (PARTITION BY is_completed) * 0.2 + 0.5) AS is_train
  FROM feats
)"""

_SCORED = f"""{_FEATS},
scored AS (
  SELECT nct_id, CASE WHEN p >= 0.4 THEN 1 ELSE 0 END AS predicted_completed, p AS completion_probability,
    is_completed AS actual
  FROM (SELECT *, CAST(enrollment_count % 1000 AS DOUBLE) / 1000 AS p FROM feats)
)"""


def _run(model: str) -> str:
    return f"""{_SPLIT} SELECT '{model}' AS model_type, {_n("is_train")} AS n_train, {_n("NOT is_train")} AS n_test,
        true AS metrics_hold FROM split"""


ORACLES |= {
    "model_metrics": f"""{_SCORED},
        ranked AS (SELECT *, rank() OVER (ORDER BY completion_probability)
                     + (count(*) OVER (PARTITION BY completion_probability) - 1) / 2.0::DOUBLE AS r FROM scored),
        cells AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(actual) AS DOUBLE) AS p,
                    CAST(sum(predicted_completed) AS DOUBLE) AS said,
                    CAST({_n("actual = 1 AND predicted_completed = 1")} AS DOUBLE) AS hit1,
                    CAST({_n("actual = 0 AND predicted_completed = 0")} AS DOUBLE) AS hit0,
                    sum(r) FILTER (WHERE actual = 1) AS ranks FROM ranked)
        SELECT round((hit1 + hit0) / n, 9) AS accuracy, round((ranks - p * (p + 1) / 2) / (p * (n - p)), 9) AS auc,
          round((2 * hit1 / (said + p) * p + 2 * hit0 / (n - said + n - p) * (n - p)) / n, 9) AS f1,
          round((n - hit1 - hit0) / n, 9) AS mae FROM cells""",
    "best_of_runs": f"""{_FEATS}
        SELECT location_country AS model_type, CAST(regexp_extract(location_country, '([0-9]+)$', 1) AS INTEGER) AS position,
          round(avg(is_completed), 2) AS auc FROM feats WHERE length(location_country) % 2 <> 0
        GROUP BY location_country ORDER BY auc DESC, position LIMIT 1""",
    "predictions_csv": f"{_SCORED} SELECT * FROM scored",
    "assembled_features": f"""SELECT nct_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in (
        'phase', 'lead_sponsor_class', 'location_country', 'enrollment_count', 'study_duration_days', 'sex',
        'healthy_volunteers', 'condition_category', 'n_conditions', 'n_categories', 'n_countries'))}
        FROM ({ORACLES['feature_matrix']})""",
    "train_random_forest": _run("random_forest"),
    "train_gradient_boosting": _run("gradient_boosting"),
    "best_model": "SELECT CAST(2 AS BIGINT) AS n_runs, true AS is_highest",
    "model_predictions": f"{_SPLIT} SELECT nct_id, is_completed AS actual, true AS holds FROM split WHERE NOT is_train",
    "feature_importances": """SELECT unnest(['phase', 'lead_sponsor_class', 'location_country', 'enrollment_count',
        'study_duration_days', 'sex', 'healthy_volunteers', 'condition_category', 'n_conditions', 'n_categories',
        'n_countries']) AS feature, true AS holds""",
}

# The same rows by other ways.
ORACLES |= dict.fromkeys(("bucketed_mart", "sql_mart"), ORACLES["enrollment_mart"])

ORACLES |= {
    "learned_rule": f"""{_FEATS},
        n AS (SELECT count(*) AS n_rows FROM feats)
        SELECT model_type, n_rows, true AS learned
        FROM (VALUES ('random_forest'), ('gradient_boosting')) m(model_type), n""",
    "open_trial_scores": f"""{_TRIALS}
        SELECT nct_id, CASE WHEN CAST(nct_id[4:] AS BIGINT) % 7 = 0 THEN 'Atlantis' ELSE location_country END AS location_country,
          true AS holds FROM stg WHERE overall_status NOT IN ('completed', 'terminated', 'withdrawn')""",
}
