"""The same results as ANSI SQL, for DuckDB over the same tables."""

from __future__ import annotations

from chartfold.functions.privacy import hmac_pads
from chartfold.plans.queries import AS_OF, FIRST_CUT, ROUTE_BYTES
from chartfold.plans.views import FIXTURE_KEY

_IN, _OUT = (pad.hex() for pad in hmac_pads(FIXTURE_KEY))


def _hmac(text: str) -> str:
    return f"sha256(unhex('{_OUT}') || unhex(sha256(unhex('{_IN}') || encode({text}))))"


_VITALS = f"""
vitals AS (
  SELECT 'E' || user_id AS encounter_id,
         {_hmac("'P' || user_id")} AS hashed_patient_id,
         CAST(round(value) AS BIGINT) AS heart_rate,
         json_extract_string(props, '$.k') AS blood_pressure,
         value AS temperature,
         event_type AS source_vendor,
         'f' || strftime(ts, '%Y%m%d') AS lineage_file_uuid,
         ts AS ingested_at
  FROM events)"""

_ENROLLMENT = """
enrollment AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS encounter_id,
         CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN '  '
              ELSE 'P' || o_custkey END AS patient_id,
         strftime(o_orderdate, '%Y-%m-%d') AS enrollment_date,
         CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_orderkey % 400 AS VARCHAR) END AS gpa,
         'vendor_' || o_orderstatus AS source_vendor,
         o_orderdate AS landed_on,
         o_orderkey AS row_number
  FROM orders)"""

_HASH_KEY = (
    "md5(encounter_id || '_' || source_vendor || '_' || "
    "strftime(ingested_at, '%Y-%m-%d %H:%M:%S.%g'))"
)
_PAYLOAD = (
    "encounter_id, hashed_patient_id, heart_rate, blood_pressure, temperature, "
    "source_vendor, lineage_file_uuid"
)
# The latest row first, and among rows of one time the one that Spark keeps, too.
_LATEST = "ingested_at DESC, " + ", ".join(
    f"{column} DESC NULLS LAST"
    for column in (
        "lineage_file_uuid", "encounter_id", "hashed_patient_id", "heart_rate",
        "blood_pressure", "temperature", "source_vendor",
    )
)


def history_ctes(batch: str) -> str:
    """CTE ``history`` as folding the batches in order gives it."""
    return f"""{_VITALS},
offered AS (
  SELECT *, {batch} AS batch FROM vitals
  QUALIFY row_number() OVER (PARTITION BY encounter_id, {batch} ORDER BY {_LATEST}) = 1),
ended AS (
  SELECT *, lead(ingested_at) OVER (PARTITION BY encounter_id ORDER BY batch) AS end_time FROM offered),
history AS (
  SELECT {_HASH_KEY} AS vitals_hash_key, {_PAYLOAD},
         ingested_at AS start_time, end_time, end_time IS NULL AS is_current
  FROM ended)"""


_DAILY = history_ctes("CAST(ingested_at AS DATE)")

_OBJECT_KEYS = """
named AS (
  SELECT s_suppkey, lower(replace(n_name, ' ', '_')) AS vendor
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
files AS (
  SELECT s_suppkey, CASE s_suppkey % 6
    WHEN 0 THEN vendor || '__vitals__20260614__u' || s_suppkey || '.csv'
    WHEN 1 THEN vendor || '__vitals__20260614__u' || s_suppkey || '.CSV'
    WHEN 2 THEN 'a__' || vendor || '__vitals__20260614__u' || s_suppkey || '.csv'
    WHEN 3 THEN vendor || '__vitals__20260614.csv'
    WHEN 4 THEN vendor || '__vitals__20260614__u' || s_suppkey || '.xml'
    ELSE vendor || '-notes.csv' END AS file_name
  FROM named)"""

_TWO_BATCHES = f"""{_VITALS},
active AS (
  SELECT {_HASH_KEY} AS vitals_hash_key, * FROM vitals
  WHERE ingested_at < TIMESTAMP '{FIRST_CUT}'
  QUALIFY row_number() OVER (PARTITION BY encounter_id ORDER BY {_LATEST}) = 1),
batch AS (
  SELECT * FROM vitals WHERE ingested_at >= TIMESTAMP '{FIRST_CUT}'
  QUALIFY row_number() OVER (PARTITION BY encounter_id ORDER BY {_LATEST}) = 1)"""

_GOOD_ROW = "trim(patient_id) <> ''"

# Equal spans of load time, as the fold queries cut them.
_SLICED = history_ctes(
    "(SELECT count(*) FROM cuts WHERE ingested_at >= cut)"
)
_CUTS = """cuts AS (
  SELECT min(ts) + to_microseconds((epoch_us(max(ts)) - epoch_us(min(ts))) * i // 3) AS cut
  FROM events, (VALUES (1), (2)) AS parts(i) GROUP BY i)"""

_OBJECT = "source_vendor || '__vitals__' || strftime(landed_on, '%Y%m') || '__u' || strftime(landed_on, '%Y%m')"
_SILVER = f"""
SELECT encounter_id, {_hmac("patient_id")} AS hashed_patient_id, enrollment_date,
       CASE WHEN gpa = '' THEN '0.00' ELSE gpa END AS gpa,
       source_vendor, 'u' || strftime(landed_on, '%Y%m') AS lineage_file_uuid
FROM enrollment WHERE {_GOOD_ROW}"""
_ROUTES = """
WITH good AS (SELECT * FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0),
objects AS (
  SELECT 'r' || o_orderkey AS receipt, 'clinic-bronze' AS bucket,
         'v ' || o_orderstatus || '/x+' || o_orderkey || '.csv' AS object_key,
         CAST(floor(o_totalprice) AS BIGINT) AS object_size FROM good
  UNION ALL
  SELECT 'r' || o_orderkey, 'clinic-bronze', 'v ' || o_orderstatus || '/x+' || o_orderkey || '.xml',
         CAST(floor(o_totalprice) AS BIGINT) + 1 FROM good)
SELECT *, CASE WHEN object_size >= 250000 OR object_key LIKE '%.xml' THEN 'bulk' ELSE 'small' END AS lane
FROM objects"""

ORACLES = {
    "contract_gate": f"""
WITH {_ENROLLMENT} {_SILVER} AND source_vendor <> 'vendor_P'""",
    "ingest_silver": f"""
WITH {_ENROLLMENT} {_SILVER} AND source_vendor <> 'vendor_P'""",
    "redelivered_objects": f"""
WITH {_ENROLLMENT}
SELECT DISTINCT * EXCLUDE (lineage_file_uuid), TRUE AS is_current FROM ({_SILVER} AND source_vendor <> 'vendor_P')""",
    "merged_ledger": f"""
WITH {_ENROLLMENT}
SELECT DISTINCT * EXCLUDE (lineage_file_uuid), TRUE AS is_current FROM ({_SILVER} AND source_vendor <> 'vendor_P')""",
    "interrupted_batch": f"""
WITH {_ENROLLMENT}
SELECT DISTINCT * EXCLUDE (lineage_file_uuid), TRUE AS is_current FROM ({_SILVER} AND source_vendor <> 'vendor_P')""",
    "bulk_csv": f"""
WITH {_ENROLLMENT} {_SILVER} AND source_vendor <> 'vendor_P'""",
    "mixed_line_ends": f"""
WITH {_ENROLLMENT}
SELECT * REPLACE (CASE WHEN CAST(encounter_id AS BIGINT) % 5 = 0 THEN enrollment_date || chr(13) || chr(10)
         || '"late", twice' ELSE enrollment_date END AS enrollment_date)
FROM ({_SILVER}), (VALUES ('small'), ('bulk')) AS lanes(lane)""",
    "split_xml": f"""
WITH {_ENROLLMENT} {_SILVER}""",
    "nested_xml": f"""
WITH {_ENROLLMENT}
SELECT * REPLACE (CASE WHEN gpa = '0.00' THEN gpa ELSE gpa || ',' || gpa END AS gpa)
FROM ({_SILVER}), (VALUES ('whole'), ('split')) AS lanes(lane)""",
    "acknowledged_messages": f"""
WITH {_ENROLLMENT}, objects AS (
  SELECT source_vendor = 'vendor_P' AS bad, strftime(landed_on, '%Y%m') AS month,
         source_vendor = 'vendor_P' OR count(*) FILTER (WHERE {_GOOD_ROW}) = 0 AS failed
  FROM enrollment GROUP BY source_vendor, 1, 2)
SELECT CASE WHEN bad THEN 'p' ELSE 'g' END || month AS receipt, count(*) AS files,
       count(*) FILTER (WHERE failed) AS failed_files, bool_and(NOT failed) AS acknowledge
FROM objects GROUP BY 1""",
    "landing_xml": f"""
WITH {_ENROLLMENT} {_SILVER}""",
    "ingest_outcomes": f"""
WITH {_ENROLLMENT}, counts AS (
  SELECT {_OBJECT} AS object, source_vendor = 'vendor_P' AS bad, count(*) AS seen,
         count(*) FILTER (WHERE {_GOOD_ROW}) AS good
  FROM enrollment GROUP BY 1, 2)
SELECT object || '.csv' AS object_key,
       CASE WHEN bad OR good = 0 THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN bad THEN 'HEADER_CONTRACT' WHEN good = 0 THEN 'NO_VALID_ROWS' END AS error,
       CASE WHEN bad THEN 0 ELSE seen END AS rows_seen,
       CASE WHEN bad THEN 0 ELSE good END AS rows_written,
       CASE WHEN NOT bad AND good > 0 THEN 'silver/csv/batch_id=0' END AS target
FROM counts""",
    "quarantine": f"""
WITH {_ENROLLMENT}, counted AS (
  SELECT *, {_OBJECT} || '.csv' AS file_name,
         count(*) FILTER (WHERE {_GOOD_ROW}) OVER (PARTITION BY {_OBJECT}) AS good
  FROM enrollment)
SELECT file_name,
       CASE WHEN source_vendor = 'vendor_F' THEN concat_ws(',', CASE gpa WHEN '' THEN '""' ELSE gpa END,
            CASE patient_id WHEN '' THEN '""' ELSE patient_id END, row_number, encounter_id, enrollment_date)
       ELSE concat_ws(',', encounter_id, CASE patient_id WHEN '' THEN '""' ELSE patient_id END,
            enrollment_date, CASE gpa WHEN '' THEN '""' ELSE gpa END) END AS value
FROM counted WHERE source_vendor = 'vendor_P' OR good = 0
UNION ALL
SELECT DISTINCT file_name, CASE source_vendor WHEN 'vendor_P' THEN 'encounter_id,patient,enrollment_date,gpa'
       WHEN 'vendor_F' THEN 'gpa,patient_id,row_number,encounter_id,enrollment_date'
       ELSE 'encounter_id,patient_id,enrollment_date,gpa' END
FROM counted WHERE source_vendor = 'vendor_P' OR good = 0""",
    "raw_text": f"""
WITH {_ENROLLMENT} SELECT {_OBJECT} || '.csv' AS object, count(*) AS lines, CAST(1 AS BIGINT) AS headers
FROM enrollment GROUP BY 1""",
    "select_files_by_pattern": f"""
WITH {_ENROLLMENT} SELECT encounter_id, enrollment_date FROM enrollment
WHERE source_vendor = 'vendor_F' AND month(landed_on) <= 6""",
    "silver_csv_roundtrip": f"WITH {_VITALS} SELECT {_PAYLOAD} FROM vitals",
    "silver_parquet_roundtrip": f"WITH {_VITALS} SELECT {_PAYLOAD} FROM vitals",
    "merge_lanes": f"WITH {_VITALS} SELECT {_PAYLOAD} FROM vitals",
    "survivor_count": f"""
WITH {_ENROLLMENT}
SELECT count(*) AS rows_seen, count(*) FILTER (WHERE {_GOOD_ROW}) AS rows_written FROM enrollment""",
    "read_notifications": _ROUTES,
    "stream_notifications": _ROUTES,
    "scd2_apply": f"WITH {_CUTS}, {_SLICED} SELECT * FROM history",
    "stream_fold": f"WITH {_CUTS}, {_SLICED} SELECT * FROM history",
    "rebuild_from_staging": f"WITH {_CUTS}, {_SLICED} SELECT * FROM history",
    "replayed_batches": f"WITH {_CUTS}, {_SLICED} SELECT * FROM history",
    "late_rows": f"""
WITH {_CUTS}, {_SLICED}
SELECT {_HASH_KEY} AS vitals_hash_key, {_PAYLOAD}, ingested_at AS start_time,
       CAST(NULL AS TIMESTAMP) AS end_time, TRUE AS is_current
FROM offered
WHERE batch = 0 AND encounter_id IN (SELECT encounter_id FROM offered WHERE batch = 1)""",
    "skip_unchanged": f"""
WITH {_CUTS}, {_VITALS}, warm AS (
  SELECT encounter_id, hashed_patient_id, CAST(temperature > 25 AS BIGINT) AS heart_rate,
         '' AS blood_pressure, CAST(0 AS DOUBLE) AS temperature, 'one' AS source_vendor,
         lineage_file_uuid, ingested_at,
         (SELECT count(*) FROM cuts WHERE ingested_at >= cut) AS batch
  FROM vitals),
offered AS (
  SELECT * FROM warm
  QUALIFY row_number() OVER (PARTITION BY encounter_id, batch ORDER BY {_LATEST}) = 1),
compared AS (
  SELECT *, lag(heart_rate) OVER (PARTITION BY encounter_id ORDER BY batch) AS warm_before FROM offered),
changed AS (SELECT * FROM compared WHERE warm_before IS NULL OR warm_before <> heart_rate)
SELECT {_HASH_KEY} AS vitals_hash_key, {_PAYLOAD}, ingested_at AS start_time,
       lead(ingested_at) OVER w AS end_time, lead(ingested_at) OVER w IS NULL AS is_current
FROM changed WINDOW w AS (PARTITION BY encounter_id ORDER BY ingested_at)""",
    "history_layout": f"""
WITH {_DAILY} SELECT * FROM history""",
    "staging_rejects": """
SELECT CAST(event_id AS VARCHAR) AS encounter_id, CAST(NULL AS BIGINT) AS heart_rate,
       value AS temperature, 'heart_rate' AS cast_errors
FROM events WHERE event_id % 10 = 0""",
    "read_current_versions": f"WITH {_CUTS}, {_SLICED} SELECT * FROM history WHERE is_current",
    "pseudonymize_hmac": f"""
SELECT c_custkey, {_hmac("upper(trim(c_name))")} AS hashed_id FROM customer""",
    "pseudonymize_concat": f"""
SELECT c_custkey, sha256(c_name || '{FIXTURE_KEY}') AS hashed_id FROM customer""",
    "clear_identities": f"""
WITH {_ENROLLMENT}
SELECT 'landing' AS side, count(DISTINCT patient_id) AS leaked FROM enrollment WHERE {_GOOD_ROW}
UNION ALL SELECT 'silver', 0""",
    "surrogate_key": f"""
WITH {_VITALS}
SELECT encounter_id, strftime(ingested_at, '%Y-%m-%d %H:%M:%S.%g') AS loaded,
       {_HASH_KEY} AS vitals_hash_key FROM vitals""",
    "required_keys": f"""
WITH {_ENROLLMENT}
SELECT encounter_id, patient_id, gpa FROM enrollment WHERE {_GOOD_ROW}""",
    "required_keys_null_only": f"""
WITH {_ENROLLMENT}
SELECT encounter_id, patient_id FROM enrollment WHERE patient_id <> ''""",
    "default_fill": f"""
WITH {_ENROLLMENT}
SELECT encounter_id, CASE WHEN gpa = '' THEN '0.00' ELSE gpa END AS gpa FROM enrollment""",
    "trim_columns": f"""
WITH {_ENROLLMENT} SELECT encounter_id, enrollment_date FROM enrollment""",
    "null_tokens": f"""
WITH {_ENROLLMENT}
SELECT encounter_id, CASE WHEN row_number % 5 IN (0, 1) THEN NULL WHEN row_number % 5 = 2 THEN 'none'
       ELSE nullif(gpa, '') END AS gpa
FROM enrollment""",
    "drop_identity": f"""
WITH {_ENROLLMENT}
SELECT encounter_id, CASE WHEN {_GOOD_ROW} THEN {_hmac("patient_id")} END AS hashed_patient_id,
       enrollment_date, gpa, source_vendor, 'UNKNOWN_UUID' AS lineage_file_uuid, landed_on
FROM enrollment""",
    "clean_rows": f"""
WITH {_ENROLLMENT}
SELECT encounter_id, {_hmac("patient_id")} AS hashed_patient_id, enrollment_date,
       CASE WHEN gpa = '' THEN '0.00' ELSE gpa END AS gpa,
       source_vendor, strftime(landed_on, '%Y%m') AS lineage_file_uuid
FROM enrollment WHERE {_GOOD_ROW}""",
    "typed_cast": """
WITH texts AS (
  SELECT event_id, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS txt FROM events)
SELECT CAST(event_id AS VARCHAR) AS encounter_id,
       CASE WHEN event_id % 10 <> 0 THEN CAST(round(CAST(txt AS DECIMAL(38,9))) AS BIGINT) END AS heart_rate,
       CAST(txt AS DOUBLE) AS temperature,
       CAST(NULL AS VARCHAR) AS source_vendor,
       CASE WHEN event_id % 10 = 0 THEN 'heart_rate' ELSE '' END AS cast_errors
FROM texts""",
    "key_lineage": f"""
WITH {_OBJECT_KEYS}
SELECT s_suppkey, file_name,
       split_part(replace(file_name, '.csv', ''), '__', 1) AS vendor_from_name,
       regexp_extract(file_name, '([^/]+)__vitals__', 1) AS vendor_from_path,
       coalesce(nullif(split_part(replace(file_name, '.csv', ''), '__', 4), ''), 'UNKNOWN_UUID') AS lineage_uuid,
       nullif(regexp_extract(file_name, '^(.+)__vitals__', 1), '') AS object_vendor,
       CASE WHEN s_suppkey % 6 IN (3, 5) THEN 'UNKNOWN_UUID' ELSE 'u' || s_suppkey END AS object_uuid,
       'clinic-silver-' || (s_suppkey % 3) AS bucket,
       'silver-vitals/' || regexp_replace(file_name, '\\.(csv|CSV)$', '_clean.csv') AS silver_key
FROM files""",
    "route_files": f"""
SELECT source || '/' || doc_id || CASE WHEN doc_id % 4 = 0 THEN '.XML' ELSE '.csv' END AS object_key,
       n_chars AS object_size,
       CASE WHEN n_chars >= {ROUTE_BYTES} OR doc_id % 4 = 0 THEN 'bulk' ELSE 'small' END AS lane
FROM documents""",
    "flatten_notifications": """
WITH good AS (SELECT * FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0)
SELECT 'r' || o_orderkey AS receipt, 'clinic-bronze' AS bucket,
       'v ' || o_orderstatus || '/x+' || o_orderkey || '.csv' AS object_key,
       CAST(floor(o_totalprice) AS BIGINT) AS object_size FROM good
UNION ALL
SELECT 'r' || o_orderkey, 'clinic-bronze', 'v ' || o_orderstatus || '/x+' || o_orderkey || '.xml',
       CAST(floor(o_totalprice) AS BIGINT) + 1 FROM good""",
    "notification_rejects": """
SELECT 'r' || o_orderkey AS receipt, '{broken' AS body, 'MALFORMED' AS reason
FROM orders WHERE o_orderkey % 19 = 0 AND o_orderkey % 17 <> 0""",
    "message_outcomes": """
SELECT 'r' || o_custkey AS receipt, count(*) AS files,
       count(*) FILTER (WHERE o_orderkey % 11 = 0) AS failed_files,
       bool_and(o_orderkey % 11 <> 0) AS acknowledge
FROM orders GROUP BY 1""",
    "file_row_counts": f"""
WITH {_ENROLLMENT}
SELECT strftime(landed_on, '%Y%m%d') AS object_key, count(*) AS rows_seen,
       count(*) FILTER (WHERE {_GOOD_ROW}) AS rows_written
FROM enrollment GROUP BY 1""",
    "file_outcomes": f"""
WITH {_ENROLLMENT}, counts AS (
  SELECT CASE WHEN day(landed_on) % 13 <> 0 THEN source_vendor || '__vitals__' ELSE 'scan-' END
           || strftime(landed_on, '%Y%m%d') || '__u1.csv' AS object_key,
         bool_or(day(landed_on) % 13 = 0) AS unnamed,
         count(*) AS seen, count(*) FILTER (WHERE {_GOOD_ROW} AND row_number % 3 = 0) AS good
  FROM enrollment GROUP BY 1)
SELECT object_key,
       CASE WHEN unnamed OR good = 0 THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN unnamed THEN 'NO_VENDOR' WHEN good = 0 THEN 'NO_VALID_ROWS' END AS error,
       seen AS rows_seen, CASE WHEN unnamed THEN 0 ELSE good END AS rows_written,
       CASE WHEN NOT unnamed AND good > 0
            THEN 'silver-vitals/' || replace(object_key, '.csv', '_clean.csv') END AS target
FROM counts""",
    "dedup_latest": f"""
WITH {_VITALS}
SELECT * FROM vitals
QUALIFY row_number() OVER (PARTITION BY encounter_id ORDER BY {_LATEST}) = 1""",
    "dedup_latest_daily": f"""
WITH {_VITALS}
SELECT *, CAST(ingested_at AS DATE) AS day FROM vitals
QUALIFY row_number() OVER (
  PARTITION BY encounter_id, CAST(ingested_at AS DATE) ORDER BY {_LATEST}) = 1""",
    "classify_action": f"""
WITH {_TWO_BATCHES}
SELECT b.encounter_id, b.ingested_at AS stream_ingested_at, a.vitals_hash_key AS target_hash_key,
       a.heart_rate AS target_heart_rate, a.ingested_at AS target_start_time,
       CASE WHEN a.encounter_id IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS action
FROM batch b LEFT JOIN active a ON a.encounter_id = b.encounter_id""",
    "scd2_delta_rows": f"""
WITH {_TWO_BATCHES}
SELECT {_HASH_KEY} AS vitals_hash_key, {_PAYLOAD}, ingested_at AS start_time,
       CAST(NULL AS TIMESTAMP) AS end_time, TRUE AS is_current FROM batch
UNION ALL
SELECT a.vitals_hash_key, b.encounter_id, b.hashed_patient_id, a.heart_rate, a.blood_pressure,
       a.temperature, b.source_vendor, a.lineage_file_uuid, a.ingested_at, b.ingested_at, FALSE
FROM batch b JOIN active a ON a.encounter_id = b.encounter_id""",
    "scd2_rebuild": f"WITH {_DAILY} SELECT * FROM history",
    "current_state": f"WITH {_DAILY} SELECT * FROM history WHERE is_current",
    "state_as_of": f"""
WITH {_DAILY}
SELECT * FROM history WHERE start_time <= TIMESTAMP '{AS_OF}'
  AND (end_time IS NULL OR TIMESTAMP '{AS_OF}' < end_time)""",
    "chain_every_arrival": f"""
WITH {_VITALS}, arrivals AS (
  SELECT * FROM vitals
  QUALIFY row_number() OVER (PARTITION BY encounter_id, ingested_at ORDER BY {_LATEST}) = 1)
SELECT {_HASH_KEY} AS vitals_hash_key, {_PAYLOAD}, ingested_at AS start_time,
       lead(ingested_at) OVER w AS end_time, lead(ingested_at) OVER w IS NULL AS is_current
FROM arrivals WINDOW w AS (PARTITION BY encounter_id ORDER BY ingested_at)""",
}
ORACLES["fold_every_arrival"] = ORACLES["chain_every_arrival"]
