"""Independent SQL for the registered queries, runnable by DuckDB on the same tables.

Written from the definition of each result, not from the DataFrame code, so that the two
can disagree.
"""

from __future__ import annotations

from meterlake.contracts import FIXED_COLUMNS, TECHNICAL_COLUMNS, base_contract
from meterlake.operators.quality import FIXED_DETAILS
from meterlake.operators.rules import fixed_rule_document
from meterlake.sources.metadata import ARTIFACTS, FIXED_ARTIFACT_NOTE, FIXED_NOTED_ARTIFACT

TRIPS = """
raw_trips AS (
  SELECT event_id AS trip_id, user_id, ts AS pickup, props, value,
    CASE WHEN user_id % 29 = 0 THEN NULL ELSE user_id % 3 END AS vendor,
    CASE WHEN event_type IN ('click', 'view', 'error') THEN 'yellow'
         WHEN event_type = 'purchase' THEN 'green' WHEN event_type = 'signup' THEN 'fhv' END AS service,
    CAST(CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 0 ELSE 1 + event_id % 4 END AS DOUBLE)
      AS passengers,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 41 = 0 THEN -value ELSE value END AS amount,
    CAST(CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 53 = 0 THEN -90
              WHEN event_id % 499 = 0 THEN 90000 ELSE floor(value * 60) END AS BIGINT) AS seconds,
    CASE WHEN event_id % 211 = 0 THEN '2024-02' WHEN event_id % 223 = 0 THEN '2023-12' ELSE '2024-01' END AS month
  FROM events
),
trips AS (
  SELECT *, pickup + seconds * INTERVAL '1' SECOND AS dropoff, pickup + INTERVAL '40' DAY AS ingested,
    service || '_tripdata_' || month || '.parquet' AS file
  FROM raw_trips
),
yellow AS (SELECT * FROM trips WHERE service = 'yellow' AND month BETWEEN '2023-12' AND '2024-01'),
green AS (SELECT * FROM trips WHERE service = 'green' AND month BETWEEN '2023-12' AND '2024-01'),
rides AS (
  SELECT *, date_sub('second', pickup, dropoff) / 60.0::DOUBLE AS minutes FROM yellow
)
"""

SHIPMENTS = """
shipments AS (
  SELECT o_custkey % 3 AS vendor, l_quantity AS passengers,
    CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount,
    l_shipdate AS pickup, l_shipdate + INTERVAL '1' HOUR AS dropoff, strftime(o_orderdate, '%Y-%m') AS month
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)
"""

HOURLY = """
hourly AS (
  SELECT CAST(hour(pickup) AS INTEGER) AS hour_of_day,
    avg(passengers) FILTER (WHERE passengers > 0) AS average_passenger_count,
    avg(passengers) FILTER (WHERE passengers > 0 AND service = 'yellow') AS average_yellow_passenger_count,
    avg(passengers) FILTER (WHERE passengers > 0 AND service = 'green') AS average_green_passenger_count,
    count(*) FILTER (WHERE passengers > 0) AS trips_considered,
    count(*) FILTER (WHERE passengers > 0 AND service = 'yellow') AS yellow_trips_considered,
    count(*) FILTER (WHERE passengers > 0 AND service = 'green') AS green_trips_considered,
    count(*) FILTER (WHERE passengers IS NULL OR passengers <= 0) AS trips_discarded,
    '2024-01' AS _reference_month,
    string_agg(DISTINCT service, ',' ORDER BY service) AS _service_types,
    string_agg(DISTINCT file, ',' ORDER BY file) AS _source_files,
    max(ingested) AS _latest_source_ingested_at
  FROM (SELECT * FROM yellow UNION ALL SELECT * FROM green)
  WHERE pickup >= TIMESTAMP '2024-01-01' AND pickup < TIMESTAMP '2024-02-01'
  GROUP BY 1
)
"""

_TYPES = {"long": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp": "TIMESTAMP", "integer": "INTEGER"}


def _with(*parts: str) -> str:
    return "WITH " + ",".join(part.strip() for part in parts) + "\n"


def _typed(service: str, values: dict[str, str], rename: dict[str, str]) -> str:
    """Select list over the contract columns of a service, null where nothing maps to them."""
    parts = []
    for item in FIXED_COLUMNS[service].split(","):
        name, kind = item.split()
        parts.append(f"CAST({values.get(name, 'NULL')} AS {_TYPES[kind]}) AS \"{rename.get(name, name)}\"")
    return ", ".join(parts)


_YELLOW = {
    "VendorID": "vendor",
    "tpep_pickup_datetime": "pickup",
    "tpep_dropoff_datetime": "dropoff",
    "passenger_count": "passengers",
    "total_amount": "amount",
    "PULocationID": "user_id",
    "fare_amount": "abs(amount)",
}
# The last yellow month brings amounts that are no numbers, fractions of a vendor and rescue text of its own.
_READ_AMOUNT = "CASE WHEN month = '2024-02' AND user_id % 11 = 0 THEN NULL ELSE amount END"
_RESCUED = """CASE WHEN month = '2024-02' THEN nullif('{' || concat_ws(',',
    CASE WHEN user_id % 5 = 0 THEN '"trip_note":"' || user_id || '"' END,
    CASE WHEN user_id % 7 = 0 AND vendor IS NOT NULL THEN '"VendorID":' || vendor || '.5' END,
    CASE WHEN user_id % 11 = 0 THEN '"total_amount":"n/a"' END,
    '"meter_note":' || CAST(to_json(props) AS VARCHAR)) || '}', '{}') END"""
_SILVER_NAMES = {
    "VendorID": "vendor_id",
    "RatecodeID": "ratecode_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
}


# ---------------------------------------------------------------- quality

_PREDICATES = {
    "vendor_id_null": "vendor IS NULL",
    "passenger_count_null": "passengers IS NULL",
    "total_amount_null": "amount IS NULL",
    "passenger_count_non_positive": "passengers <= 0",
    "total_amount_non_positive": "amount <= 0",
    "invalid_trip_chronology": "dropoff < pickup",
    "trip_duration_over_24_hours": "dropoff > pickup + INTERVAL '24' HOUR",
    "pickup_before_reference_month": "pickup < CAST(month || '-01' AS DATE)",
    "trip_datetime_after_reference_month": (
        "pickup >= CAST(month || '-01' AS DATE) + INTERVAL '1' MONTH "
        "OR dropoff >= CAST(month || '-01' AS DATE) + INTERVAL '1' MONTH"
    ),
}
_TABLES = {
    "landing": "landing/yellow",
    "bronze": "bronze.bronze_yellow_trips",
    "silver": "silver.silver_yellow_trips",
    "gold": "gold.gold_yellow_trips_consumption",
}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _rules_cte(graded: bool) -> str:
    """Rules with the severity and limit they end up with."""
    rows = []
    for rule in fixed_rule_document()["rules"]:
        severity, limit, active = "WARN", "0.0", True
        if graded:
            severity = "FAIL" if rule["id"] == "invalid_trip_chronology" else severity
            limit = "5.0" if rule["id"] == "passenger_count_null" else limit
            active = rule["id"] != "vendor_id_null"
        values = (rule["id"], rule["name"], rule["dimension"], rule["description"], severity)
        rows.append(f"({', '.join(map(_text, values))}, CAST({limit} AS DOUBLE), {active})")
    return (
        "rules(rule_id, rule_name, dimension, description, severity, maximum, active) AS (VALUES "
        + ", ".join(rows)
        + ")"
    )


def _results_cte(name: str, execution: str, executed_at: str, last_month: str, end: str) -> str:
    layers = ", ".join(f"({_text(layer)}, {_text(table)})" for layer, table in _TABLES.items())
    counts = ", ".join(f"count(*) FILTER (WHERE {p}) AS {rule}" for rule, p in _PREDICATES.items())
    return f"""
{name} AS (
  WITH counted AS (
    SELECT count(*) AS total_rows, {counts}
    FROM trips WHERE service = 'yellow' AND month BETWEEN '2023-12' AND '{last_month}'
  ),
  per_rule AS (UNPIVOT counted ON {', '.join(_PREDICATES)} INTO NAME rule_id VALUE violation_count)
  SELECT '{execution}' AS execution_id, TIMESTAMP '{executed_at}' AS executed_at, rules.rule_id, layers.layer,
    layers.table_name, DATE '2023-12-01' AS reference_start, DATE '{end}' AS reference_end,
    total_rows, violation_count,
    CASE WHEN total_rows = 0 THEN 0.0 ELSE 100.0::DOUBLE * violation_count / total_rows END AS violation_percentage,
    maximum AS maximum_violation_percentage,
    CASE WHEN total_rows = 0 OR 100.0::DOUBLE * violation_count / total_rows <= maximum THEN 'OK' ELSE severity END
      AS status,
    {_text(FIXED_DETAILS)} AS details
  FROM per_rule JOIN rules ON per_rule.rule_id = rules.rule_id AND rules.active
  CROSS JOIN (VALUES {layers}) AS layers(layer, table_name)
)"""


_RUN_1 = ("run_1", "run-1", "2024-03-01 02:30:00", "2024-01", "2024-01-31")
_RUN_3 = ("run_3", "run-3", "2024-03-01 18:00:00", "2024-02", "2024-02-29")
_HISTORY = ("history AS (SELECT * FROM run_1 UNION ALL SELECT * FROM run_3)",)
# The zone of the history has been three hours behind UTC, without summer time, since 2019.
_DASHBOARD = (
    """
dashboard AS (
  SELECT execution_id, executed_at, CAST(executed_at - INTERVAL '3' HOUR AS DATE) AS execution_date, rule_id,
    rule_name, dimension, description, severity, layer, table_name, reference_start, reference_end, total_rows,
    violation_count, violation_percentage, maximum_violation_percentage, status, details
  FROM history JOIN (SELECT rule_id, rule_name, dimension, description, severity FROM rules) USING (rule_id)
)""",
)


def _history_with(*more: str) -> str:
    return _with(TRIPS, _rules_cte(True), _results_cte(*_RUN_1), _results_cte(*_RUN_3), *_HISTORY, *more)


def _dashboard_with() -> str:
    # Results carry the severity in capitals; the catalogue keeps the text of its document.
    rules = _rules_cte(True)
    dashboard = _DASHBOARD[0].replace(
        "(SELECT rule_id, rule_name, dimension, description, severity FROM rules)",
        "(SELECT rule_id, rule_name, dimension, description, "
        "CASE severity WHEN 'FAIL' THEN 'fail' ELSE severity END AS severity FROM rules)",
    )
    return _with(TRIPS, rules, _results_cte(*_RUN_1), _results_cte(*_RUN_3), *_HISTORY, dashboard)


_LATEST = """
summary AS (
  SELECT * FROM history h WHERE NOT EXISTS (
    SELECT 1 FROM history later
    WHERE later.rule_id = h.rule_id AND later.layer = h.layer AND later.table_name = h.table_name
      AND (later.executed_at, later.execution_id) > (h.executed_at, h.execution_id))
)"""


def _success(keys: str) -> str:
    return f"""
SELECT execution_id, executed_at, execution_date, {keys}, reference_start, reference_end,
  count(*) AS evaluated_rules, CAST(sum(total_rows) AS BIGINT) AS evaluated_checks,
  CAST(sum(violation_count) AS BIGINT) AS failed_checks,
  round(100.0::DOUBLE * (1.0 - sum(violation_count)::DOUBLE / nullif(sum(total_rows), 0)), 6) AS success_percentage
FROM dashboard GROUP BY ALL"""


_PART_RULES = """
part_rules AS (
  SELECT 'r' || p_partkey AS rule_id, p_name AS rule_name, p_type AS dimension, p_brand AS description,
    'p_size > ' || p_size AS expression,
    CASE WHEN p_size % 3 <> 0 THEN 'FAIL' ELSE 'WARN' END AS severity,
    CASE WHEN p_size % 4 <> 0 THEN p_size::DOUBLE ELSE 0.0::DOUBLE END AS maximum_violation_percentage,
    'bronze,silver' AS layers,
    CASE WHEN p_size % 5 <> 0 THEN p_size % 5 <> 1 ELSE true END AS active
  FROM part
)"""

# ---------------------------------------------------------------- dictionaries

_CLEAN = r"""
texts AS (
  SELECT doc_id, lang, source,
    'Data Dictionary – Trip Records  Page 1 of 2' || chr(10) || 'This data dictionary describes documents of ' || source
    || '. As of 2024 it is current.' || chr(10)
    || CASE WHEN lang = 'de' THEN 'Fields' || chr(10)
            ELSE 'Field' || chr(9) || 'Name' || chr(10) || '  Description' || chr(10) END
    || 'doc_id ' || doc_id || chr(10) || 'lang ' || lang || chr(10)
    || 'DATA DICTIONARY - continued Page 2 of 2' || chr(10)
    || CASE lang WHEN 'fr' THEN '' WHEN 'es' THEN 'source ' ELSE 'source ' || source || chr(10) END
    || 'text ' || text AS body
  FROM documents
),
clean AS (
  SELECT doc_id, body AS original, trim(regexp_replace(
    regexp_replace(body, '(?i)Data Dictionary[\s\x0B\x85\pZ]*[–-].*?Page \d+ of \d+', ' ', 'g'),
    '[\s\x0B\x85\pZ]+', ' ', 'g')) AS t
  FROM texts
),
pieces AS (
  SELECT doc_id, original, t, regexp_matches(t, 'Field Name\s+Description') AS marked,
    regexp_extract(t, '(This data dictionary describes .*?)(?: For data dictionaries| As of \d{4}| Field Name)', 1) AS about,
    regexp_matches(t, 'Field Name\s+Description.*?\bdoc_id\b') AS has1,
    regexp_matches(t, 'Field Name\s+Description.*?\bdoc_id\b.*?\blang\b') AS has2,
    regexp_matches(t, 'Field Name\s+Description.*?\bdoc_id\b.*?\blang\b.*?\bsource\b') AS has3,
    regexp_matches(t, 'Field Name\s+Description.*?\bdoc_id\b.*?\blang\b.*?\bsource\b.*?\btext\b') AS has4,
    regexp_extract(t, 'Field Name\s+Description.*?\bdoc_id\b(.*?)\blang\b', 1) AS d1,
    regexp_extract(t, 'Field Name\s+Description.*?\bdoc_id\b.*?\blang\b(.*?)\bsource\b', 1) AS d2,
    regexp_extract(t, 'Field Name\s+Description.*?\bdoc_id\b.*?\blang\b.*?\bsource\b(.*?)\btext\b', 1) AS d3,
    regexp_extract(t, 'Field Name\s+Description.*?\bdoc_id\b(.*)$', 1) AS r1,
    regexp_extract(t, 'Field Name\s+Description.*?\bdoc_id\b.*?\blang\b(.*)$', 1) AS r2,
    regexp_extract(t, 'Field Name\s+Description.*?\bdoc_id\b.*?\blang\b.*?\bsource\b(.*)$', 1) AS r3,
    regexp_extract(t, 'Field Name\s+Description.*?\bdoc_id\b.*?\blang\b.*?\bsource\b.*?\btext\b(.*)$', 1) AS r4
  FROM clean
),
found AS (
  SELECT doc_id, original, marked, about, unnest([
    {'position': 0, 'name': 'doc_id', 'has': has1, 'description': CASE WHEN has2 THEN d1 ELSE r1 END},
    {'position': 1, 'name': 'lang', 'has': has2, 'description': CASE WHEN has3 THEN d2 ELSE r2 END},
    {'position': 2, 'name': 'source', 'has': has3, 'description': CASE WHEN has4 THEN d3 ELSE r3 END},
    {'position': 3, 'name': 'text', 'has': has4, 'description': r4}]) AS f
  FROM pieces
),
fields AS (
  SELECT doc_id, original, about, CAST(f.position AS INTEGER) AS position, f.name AS name,
    CASE WHEN f.has THEN trim(f.description) END AS description,
    CASE WHEN NOT marked THEN 'MARKER_NOT_FOUND' WHEN NOT f.has THEN 'FIELD_NOT_FOUND'
         WHEN trim(f.description) = '' THEN 'EMPTY_DESCRIPTION' ELSE 'OK' END AS status
  FROM found
)"""

# ---------------------------------------------------------------- coverage of contracts

#: What rows of each service hold: field, logical type, and the value in terms of ``trips``.
_HELD = {
    "yellow": [
        ("VendorID", "long", "vendor"), ("passenger_count", "double", "passengers"), ("total_amount", "double", "amount"),
        ("tpep_pickup_datetime", "timestamp", "pickup"), ("tpep_dropoff_datetime", "timestamp", "dropoff"),
        ("PULocationID", "long", "user_id"), ("fare_amount", "double", "amount"),
    ],
    "green": [
        ("VendorID", "long", "vendor"), ("passenger_count", "double", "passengers"), ("total_amount", "double", "amount"),
        ("lpep_pickup_datetime", "timestamp", "pickup"), ("lpep_dropoff_datetime", "timestamp", "dropoff"),
        ("PULocationID", "long", "user_id"), ("fare_amount", "double", "amount"),
    ],
    "fhv": [
        ("dispatching_base_num", "string", "user_id"), ("pickup_datetime", "timestamp", "pickup"),
        ("dropOff_datetime", "timestamp", "dropoff"), ("PUlocationID", "long", "user_id"), ("SR_Flag", "long", "vendor"),
    ],
    "fhvhv": [
        ("hvfhs_license_num", "string", "user_id"), ("request_datetime", "timestamp", "pickup"),
        ("pickup_datetime", "timestamp", "pickup"), ("dropoff_datetime", "timestamp", "dropoff"),
        ("PULocationID", "long", "user_id"), ("trip_time", "long", "seconds"), ("driver_pay", "double", "amount"),
    ],
}


def _coverage_sql() -> str:
    expected, held = [], []
    for service, fields in _HELD.items():
        contract = base_contract(service)
        for c in (*contract.columns, *TECHNICAL_COLUMNS):
            values = (service, contract.table, contract.dictionary_slug, c.name, c.logical_type, c.description)
            expected.append(f"({', '.join(map(_text, values))})")
        of_service = "fhv" if service == "fhvhv" else service
        lineage = [(c.name, c.logical_type, "month") for c in TECHNICAL_COLUMNS]
        for name, kind, value in (*fields, *lineage, ("k", "long", "json_extract(props, '$.k')")):
            held.append(
                f"SELECT {_text(service)} AS dataset, {_text(name)} AS name, {_text(kind)} AS kind, count({value}) AS n "
                f"FROM trips WHERE service = {_text(of_service)}"
            )
    return _with(TRIPS) + f""", expected(dataset, table_name, slug, name, kind, description) AS (VALUES {', '.join(expected)}),
actual AS (SELECT * FROM ({' UNION ALL '.join(held)}) WHERE n > 0),
identity AS (SELECT DISTINCT dataset, table_name, slug FROM expected)
SELECT i.dataset, i.table_name, coalesce(a.name, e.name) AS column_name, a.kind AS actual_type,
  e.kind AS expected_type, e.description, CAST(NULL AS VARCHAR) AS "references",
  CASE WHEN a.name IS NULL THEN 'MISSING_IN_SOURCE' WHEN e.name IS NULL THEN 'UNDOCUMENTED' ELSE 'DOCUMENTED' END
    AS status,
  i.slug AS dictionary_slug, a.n AS held_rows
FROM expected e FULL JOIN actual a ON e.dataset = a.dataset AND lower(e.name) = lower(a.name)
JOIN identity i ON i.dataset = coalesce(e.dataset, a.dataset)"""


def _artifact_case(index: int) -> str:
    whens = " ".join(f"WHEN {_text(name)} THEN {_text(values[index])}" for name, values in ARTIFACTS.items())
    return f"CASE name {whens} END"


def _artifacts_sql() -> str:
    names = " ".join(f"WHEN {i} THEN {_text(name)}" for i, name in enumerate(ARTIFACTS))
    return f"""
WITH named AS (
  SELECT *, CASE doc_id % 10 {names} ELSE 'document_' || doc_id || '.txt' END AS name FROM documents
)
SELECT name AS file_name, {_artifact_case(0)} AS artifact_type, {_artifact_case(1)} AS dataset_slug,
  {_artifact_case(2)} AS source_slug, {_artifact_case(3)} AS source_url,
  '/landing/_metadata/' || source || '/' || doc_id || '/' || name AS landing_path,
  CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes,
  TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL '1' SECOND AS modified_at,
  CASE WHEN name = {_text(FIXED_NOTED_ARTIFACT)} THEN {_text(FIXED_ARTIFACT_NOTE)} END AS governance_note
FROM named"""


def oracle_sql() -> dict[str, str]:
    rides = _with(TRIPS)
    shipments = _with(SHIPMENTS)
    history = _history_with()
    summary = _history_with(_LATEST)
    dashboard = _dashboard_with()
    consumption = """
SELECT vendor AS "VendorID", passengers AS passenger_count, amount AS total_amount, pickup AS tpep_pickup_datetime,
  dropoff AS tpep_dropoff_datetime, month AS _reference_month, file AS _source_file, ingested AS _ingested_at,
  service AS _service_type FROM yellow"""
    projection = """
SELECT vendor AS vendor_id, passengers AS passenger_count, amount AS total_amount, pickup AS pickup_datetime,
  dropoff AS dropoff_datetime, month AS reference_month FROM yellow"""
    return {
        "landing_canonical": rides
        + f"""SELECT vendor AS vendor_id, passengers AS passenger_count, {_READ_AMOUNT} AS total_amount,
  pickup AS pickup_datetime, dropoff AS dropoff_datetime, month AS reference_month FROM trips WHERE service = 'yellow'""",
        # Every service has a file for every month, if only one without rows.
        "landing_integrity": rides
        + """SELECT s.service, m.month AS reference_month, 'INTACT' AS status, count(trip_id) AS trip_rows
FROM (VALUES ('yellow'), ('green'), ('fhv'), ('fhvhv')) s(service)
CROSS JOIN (VALUES ('2023-12'), ('2024-01'), ('2024-02')) m(month)
LEFT JOIN trips ON trips.service = CASE s.service WHEN 'fhvhv' THEN 'fhv' ELSE s.service END AND trips.month = m.month GROUP BY ALL""",
        "landing_gaps": """
WITH present AS (
  SELECT DISTINCT CASE o_orderpriority WHEN '1-URGENT' THEN 'yellow' WHEN '2-HIGH' THEN 'green'
    WHEN '3-MEDIUM' THEN 'fhv' ELSE 'other' END AS service, strftime(o_orderdate, '%Y-%m') AS month FROM orders
),
expected AS (
  SELECT service, strftime(d, '%Y-%m') AS month, d
  FROM (VALUES ('yellow'), ('green'), ('fhv'), ('fhvhv')) s(service),
    generate_series(DATE '1994-10-01', DATE '2001-10-01', INTERVAL '1' MONTH) g(d)
)
SELECT service, month AS reference_month, month IN ('2001-09', '2001-10') AS tolerated FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.service = e.service AND p.month = e.month)""",
        "bronze_canonical": rides
        + f"""SELECT {_typed('yellow', {**_YELLOW, 'airport_fee': 'abs(amount) / 10', 'total_amount': _READ_AMOUNT}, {})},
  {_RESCUED} AS _rescued_data,
  service AS _service_type, month AS _reference_month
FROM trips WHERE service = 'yellow'""",
        "bronze_lineage": rides
        + """SELECT service AS _service_type, month AS _reference_month, service AS file_service,
  month AS file_month, count(*) AS trip_rows FROM trips WHERE service = 'green' GROUP BY ALL""",
        "bronze_ingest": rides
        + f"""SELECT vendor AS vendor_id, pickup AS pickup_datetime, dropoff AS dropoff_datetime,
  CASE WHEN service <> 'fhv' THEN passengers END AS passenger_count,
  CASE WHEN service = 'yellow' THEN {_READ_AMOUNT} WHEN service <> 'fhv' THEN amount END AS total_amount,
  CASE WHEN service = 'yellow' AND month = '2024-02' THEN {_RESCUED}
       WHEN service = 'green' AND month = '2023-12' THEN CAST(json_object('ehail_fee', user_id) AS VARCHAR)
  END AS _rescued_data,
  service AS _service_type, month AS _reference_month FROM trips
UNION ALL
SELECT NULL, pickup, dropoff, NULL, amount, CASE WHEN month = '2023-12' THEN CAST(json_object('base_note', props) AS VARCHAR) END,
  'fhvhv', month FROM trips WHERE service = 'fhv'""",
        "rescued_map": """
SELECT event_id, json_extract_string(props, '$.k') AS rescued_text,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS rescued_long,
  json_extract_string(props, '$.K') AS other_spelling FROM events""",
        "zone_lookup": """
SELECT CAST(s_suppkey AS INTEGER) AS "LocationID", r_name AS "Borough", s_name AS "Zone", n_name AS service_zone
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
        "zone_enrichment": """
WITH zones AS (
  SELECT s_suppkey AS id, r_name AS borough, s_name AS zone, n_name AS service_zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)
SELECT l_orderkey, l_linenumber, l_suppkey AS "PULocationID", l_partkey AS "DOLocationID",
  p.borough AS pickup_borough, p.zone AS pickup_zone, p.service_zone AS pickup_service_zone,
  d.borough AS dropoff_borough, d.zone AS dropoff_zone, d.service_zone AS dropoff_service_zone
FROM lineitem LEFT JOIN zones p ON p.id = l_suppkey LEFT JOIN zones d ON d.id = l_partkey""",
        "artifact_inventory": _artifacts_sql(),
        "artifact_sha256": """
SELECT 'document_' || doc_id || '.txt' AS file_name, sha256(text) AS source_sha256 FROM documents""",
        "contract_extract": _with(_CLEAN) + "SELECT doc_id, position, name, description, status FROM fields",
        "contract_build": _with(_CLEAN)
        + """, verdicts AS (
  SELECT doc_id, CASE WHEN coalesce(any_value(about), '') = '' THEN 'DESCRIPTION_NOT_FOUND'
    ELSE coalesce(arg_min(status, position) FILTER (WHERE status <> 'OK'), 'OK') END AS verdict
  FROM fields GROUP BY doc_id
)
SELECT CAST(doc_id AS VARCHAR) AS dataset, any_value(verdict) AS status,
  CASE WHEN any_value(verdict) = 'OK' THEN CAST(json_object('dataset', CAST(doc_id AS VARCHAR),
  'table', 'bronze_' || doc_id, 'description', any_value(trim(about)), 'dictionary_slug', 'documents',
  'source_file', 'document_' || doc_id || '.txt', 'source_sha256', sha256(any_value(original)),
  'extractor_version', '1.0.0', 'language', 'en',
  'columns', json_object(
    'doc_id', json_object('description', max(description) FILTER (WHERE position = 0), 'type', 'long'),
    'lang', json_object('description', max(description) FILTER (WHERE position = 1), 'type', 'string'),
    'source', json_object('description', max(description) FILTER (WHERE position = 2), 'type', 'string'),
    'text', json_object('description', max(description) FILTER (WHERE position = 3), 'type', 'string')
  )) AS VARCHAR) END AS contract
FROM fields JOIN verdicts USING (doc_id) GROUP BY doc_id""",
        "contract_coverage": _coverage_sql(),
        "silver_trips": rides
        + f"""SELECT {_typed('yellow', _YELLOW, _SILVER_NAMES)}, file AS _source_file, ingested AS _ingested_at,
  service AS _service_type, month AS _reference_month FROM yellow""",
        "gold_consumption": rides + consumption,
        "union_services": rides
        + """SELECT pickup AS pickup_datetime, passengers AS passenger_count, service AS service_type,
  file AS _source_file, ingested AS _ingested_at FROM (SELECT * FROM yellow UNION ALL SELECT * FROM green)""",
        "pickup_window": shipments
        + """SELECT vendor AS "VendorID", passengers AS passenger_count, amount AS total_amount,
  pickup AS tpep_pickup_datetime, dropoff AS tpep_dropoff_datetime, month AS _reference_month FROM shipments
WHERE pickup >= TIMESTAMP '1999-12-01' AND pickup < TIMESTAMP '2000-01-01'""",
        "gold_passengers_by_hour": _with(TRIPS, HOURLY) + "SELECT * FROM hourly ORDER BY hour_of_day",
        "coverage": rides
        + """SELECT min(pickup) AS primeira_coleta, max(pickup) AS ultima_coleta, count(*) AS quantidade_viagens,
  count(amount) AS viagens_com_total_amount, count(passengers) AS viagens_com_passenger_count
FROM yellow WHERE pickup >= TIMESTAMP '2024-01-01' AND pickup < TIMESTAMP '2024-02-01'""",
        "monthly_avg_amount": shipments
        + """SELECT strftime(pickup, '%Y-%m') AS mes_referencia, round(avg(amount), 2) AS media_total_amount,
  count(amount) AS viagens_com_total_amount FROM shipments
WHERE pickup >= TIMESTAMP '1995-01-01' AND pickup < TIMESTAMP '2002-01-01' GROUP BY 1 ORDER BY 1""",
        "answer_passengers_by_hour": _with(TRIPS, HOURLY)
        + """SELECT hour_of_day AS hora_do_dia, round(average_passenger_count, 2) AS media_yellow_green,
  round(average_yellow_passenger_count, 2) AS media_apenas_yellow,
  round(average_green_passenger_count, 2) AS media_apenas_green, trips_considered AS viagens_consideradas,
  yellow_trips_considered AS viagens_yellow, green_trips_considered AS viagens_green,
  trips_discarded AS viagens_descartadas FROM hourly ORDER BY 1""",
        "trips_with_duration": rides
        + """SELECT vendor AS "VendorID", passengers AS passenger_count, amount AS total_amount,
  pickup AS tpep_pickup_datetime, dropoff AS tpep_dropoff_datetime, month AS _reference_month,
  minutes AS trip_duration_minutes FROM rides""",
        "eda_monthly_volume": shipments
        + """SELECT month AS mes_referencia, n AS quantidade_corridas,
  round(100.0::DOUBLE * (n - lag(n) OVER (ORDER BY month)) / nullif(lag(n) OVER (ORDER BY month), 0), 2)
    AS variacao_percentual_mes_anterior
FROM (SELECT month, count(*) AS n FROM shipments GROUP BY month) ORDER BY month""",
        "eda_pickup_vs_reference": shipments
        + """, f AS (SELECT month, count(*) AS n FROM shipments GROUP BY month),
p AS (
  SELECT strftime(pickup, '%Y-%m') AS month, count(*) AS n FROM shipments
  WHERE pickup >= TIMESTAMP '1995-01-01' AND pickup < TIMESTAMP '2002-01-01' GROUP BY 1
)
SELECT f.month AS mes_pickup, f.n AS corridas_mes_arquivo, p.n AS corridas_mes_pickup, p.n - f.n AS diferenca,
  round(100.0::DOUBLE * (p.n - lag(p.n) OVER (ORDER BY f.month)) / nullif(lag(p.n) OVER (ORDER BY f.month), 0), 2)
    AS variacao_percentual_mes_anterior
FROM f LEFT JOIN p ON f.month = p.month ORDER BY 1""",
        "eda_revenue": rides
        + """SELECT month AS mes_referencia, round(sum(amount), 2) AS receita_total_registrada,
  round(avg(amount), 2) AS ticket_medio, count(amount) AS corridas_com_valor,
  count(*) - count(amount) AS corridas_sem_valor FROM rides GROUP BY month ORDER BY month""",
        "eda_revenue_sensitivity": shipments
        + """SELECT month AS mes_referencia, round(sum(amount) FILTER (WHERE amount >= 0), 2) AS receita_sem_negativos,
  round(avg(amount) FILTER (WHERE amount >= 0), 2) AS ticket_medio_sem_negativos,
  count(*) FILTER (WHERE amount >= 0) AS corridas_consideradas,
  count(*) FILTER (WHERE amount < 0) AS corridas_negativas_removidas,
  round(sum(amount) FILTER (WHERE amount >= 0) - sum(amount), 2) AS impacto_na_receita
FROM shipments GROUP BY month ORDER BY month""",
        "eda_vendor": rides
        + """SELECT coalesce(CAST(vendor AS VARCHAR), 'NÃO INFORMADO') AS vendor_id, count(*) AS quantidade_corridas,
  round(sum(amount), 2) AS receita_total_registrada, round(avg(amount), 2) AS ticket_medio,
  round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS percentual_corridas
FROM rides GROUP BY vendor""",
        "eda_vendor_sensitivity": rides
        + """SELECT coalesce(CAST(vendor AS VARCHAR), 'NÃO INFORMADO') AS vendor_id,
  count(*) FILTER (WHERE amount >= 0) AS corridas_consideradas,
  count(*) FILTER (WHERE amount < 0) AS corridas_negativas_removidas,
  round(sum(amount) FILTER (WHERE amount >= 0), 2) AS receita_sem_negativos,
  round(avg(amount) FILTER (WHERE amount >= 0), 2) AS ticket_medio_sem_negativos,
  round(sum(amount) FILTER (WHERE amount >= 0) - sum(amount), 2) AS impacto_na_receita
FROM rides GROUP BY vendor""",
        "eda_passengers": rides
        + """SELECT month AS mes_referencia, round(avg(passengers), 2) AS media_passageiros_informada,
  round(avg(passengers) FILTER (WHERE passengers > 0), 2) AS media_passageiros_validos,
  count(*) AS quantidade_corridas, count(passengers) AS corridas_com_passageiros_informados,
  count(*) FILTER (WHERE passengers IS NULL) AS corridas_sem_passageiros_informados,
  count(*) FILTER (WHERE passengers <= 0) AS corridas_com_passageiros_nao_positivos
FROM rides GROUP BY month ORDER BY month""",
        "eda_duration_buckets": rides
        + """, labelled AS (
  SELECT CASE WHEN minutes IS NULL THEN '00. Não informada' WHEN minutes < 0 THEN '01. Negativa'
    WHEN minutes <= 5 THEN '02. Até 5 min' WHEN minutes <= 15 THEN '03. 5 a 15 min'
    WHEN minutes <= 30 THEN '04. 15 a 30 min' WHEN minutes <= 60 THEN '05. 30 a 60 min'
    WHEN minutes <= 120 THEN '06. 1 a 2 h' WHEN minutes <= 1440 THEN '07. 2 a 24 h'
    ELSE '08. Acima de 24 h' END AS label FROM rides
)
SELECT label AS faixa_duracao, count(*) AS quantidade_corridas,
  round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS percentual_corridas
FROM labelled GROUP BY label ORDER BY label""",
        "eda_correlation": rides
        + """SELECT round(corr(minutes, amount), 4) AS correlacao_duracao_valor, count(*) AS corridas_consideradas
FROM rides WHERE minutes BETWEEN 0 AND 1440 AND amount IS NOT NULL""",
        "eda_duration_amount_buckets": rides
        + """SELECT CASE WHEN minutes <= 5 THEN '01. Até 5 min' WHEN minutes <= 15 THEN '02. 5 a 15 min'
    WHEN minutes <= 30 THEN '03. 15 a 30 min' WHEN minutes <= 60 THEN '04. 30 a 60 min'
    WHEN minutes <= 120 THEN '05. 1 a 2 h' ELSE '06. 2 a 24 h' END AS faixa_duracao,
  count(*) AS quantidade_corridas, round(avg(minutes), 2) AS duracao_media_minutos,
  round(avg(amount), 2) AS valor_total_medio, round(quantile_disc(amount, 0.5), 2) AS mediana_total_amount
FROM rides WHERE minutes BETWEEN 0 AND 1440 AND amount IS NOT NULL GROUP BY 1 ORDER BY 1""",
        "eda_rule_flags": summary
        + """SELECT layer AS camada, table_name AS tabela, rule_id AS regra, total_rows AS registros_avaliados,
  violation_count AS registros_sinalizados, round(violation_percentage, 6) AS percentual_sinalizado, status
FROM summary WHERE table_name LIKE '%yellow%'""",
        "eda_rule_flags_by_layer": summary
        + """SELECT layer AS camada, table_name AS tabela, CAST(sum(total_rows) AS BIGINT) AS verificacoes_executadas,
  CAST(sum(violation_count) AS BIGINT) AS sinalizacoes,
  round(100.0::DOUBLE * sum(violation_count) / nullif(sum(total_rows), 0), 6) AS percentual_sinalizacoes
FROM summary WHERE table_name LIKE '%yellow%' GROUP BY ALL""",
        "dq_projection": rides + projection,
        "dq_rules_resolved": _with(_PART_RULES) + "SELECT * FROM part_rules",
        "dq_active_rules": _with(_PART_RULES)
        + """SELECT rule_id, expression, severity, maximum_violation_percentage, layers
FROM part_rules WHERE active""",
        "dq_catalog_sync": _with(_PART_RULES)
        + """, incoming AS (
  SELECT 'r' || (l_partkey + 50) AS rule_id, count(*) || ' deliveries' AS rule_name,
    'quantity <= ' || CAST(max(l_quantity) AS INTEGER) AS expression, max(l_quantity) AS maximum
  FROM lineitem GROUP BY l_partkey
)
SELECT coalesce(i.rule_id, o.rule_id) AS rule_id,
  CASE WHEN i.rule_id IS NULL THEN o.rule_name ELSE i.rule_name END AS rule_name,
  CASE WHEN i.rule_id IS NULL THEN o.dimension ELSE 'validity' END AS dimension,
  CASE WHEN i.rule_id IS NULL THEN o.description ELSE 'synchronised' END AS description,
  CASE WHEN i.rule_id IS NULL THEN o.expression ELSE i.expression END AS expression,
  CASE WHEN i.rule_id IS NULL THEN o.severity ELSE 'WARN' END AS severity,
  CASE WHEN i.rule_id IS NULL THEN o.maximum_violation_percentage ELSE i.maximum END AS maximum_violation_percentage,
  CASE WHEN i.rule_id IS NULL THEN o.layers ELSE 'gold' END AS layers,
  i.rule_id IS NOT NULL AS active,
  CAST(CASE WHEN i.rule_id IS NULL THEN 1 ELSE 2 END AS INTEGER) AS contract_version,
  CASE WHEN o.rule_id IS NULL THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-01' END AS created_at,
  TIMESTAMP '2024-02-01' AS updated_at
FROM part_rules o FULL JOIN incoming i ON o.rule_id = i.rule_id""",
        "dq_evaluate": _with(TRIPS, _rules_cte(False), _results_cte(*_RUN_1)) + "SELECT * FROM run_1",
        "dq_evaluate_months": _with(TRIPS, _rules_cte(False), _results_cte(*_RUN_3))
        + "SELECT * FROM run_3 WHERE layer = 'silver'",
        "dq_history": history + "SELECT * FROM history",
        "dq_execution_summary": summary + "SELECT * FROM summary",
        "dq_dashboard_results": dashboard + "SELECT * FROM dashboard",
        "dq_table_success": dashboard + _success("layer, table_name"),
        "dq_dimension_success": dashboard + _success("layer, table_name, dimension"),
        "dq_run_summary": dashboard
        + """SELECT execution_id, executed_at, execution_date, reference_start, reference_end,
  count(*) AS evaluated_rules, count(*) FILTER (WHERE status = 'OK') AS ok_results,
  count(*) FILTER (WHERE status = 'WARN') AS warn_results, count(*) FILTER (WHERE status = 'FAIL') AS fail_results,
  count(DISTINCT layer) AS evaluated_layers FROM dashboard GROUP BY ALL""",
    }
