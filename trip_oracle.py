"""The registered queries as DuckDB SQL over the driver's tables, written independently of Spark.

`_rnd` rounds as a decimal does (half up on the printed digits); `_sum` adds four-decimal values
exactly. Both mirror the semantics documented for the engine.
"""

from __future__ import annotations

RUN = "ETL-20240101-000000-0000ABCD"
AT = "TIMESTAMP '2024-01-01 00:00:00'"


def _rnd(x: str, n: int = 2) -> str:
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def _sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def _rsum(x: str, n: int = 2) -> str:
    return _rnd(_sum(x), n)


def _ravg(x: str, n: int = 2) -> str:
    return _rnd(f"({_sum(x)} / COUNT({x}))", n)


def _pct(part: str, whole: str) -> str:
    return _rnd(f"(CAST({part} AS DOUBLE) / CAST(GREATEST({whole}, 1) AS DOUBLE) * 100.0)")


_FARE = "(floor(l_extendedprice / 10) / 100.0 - 1)"
_TIP = "(floor(l_discount * l_extendedprice / 80 * 100) / 100.0)"
_TOLLS = "(floor(l_tax * 1000) / 100.0)"
_PU = "CASE WHEN l_partkey % 227 <> 0 THEN l_partkey % 265 + 1 END"

_TRIPS = f"""
lines AS (
  SELECT l.*, o.o_custkey, o.o_orderdate + INTERVAL 24 YEAR AS base_ts,
         CASE o.o_custkey % 3 WHEN 0 THEN 'yellow' WHEN 1 THEN 'green' ELSE 'fhvhv' END AS service_type
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
arrived AS (
  SELECT * FROM lines
  UNION ALL
  SELECT * FROM lines WHERE l_orderkey % 97 = 0 AND l_linenumber = 1
),
timed AS (
  SELECT *,
    CASE WHEN l_partkey % 211 <> 0 THEN base_ts + to_minutes(l_partkey % 1440) END AS pickup_datetime,
    CASE WHEN l_partkey % 223 <> 0 THEN base_ts + to_minutes(l_partkey % 1440)
         + to_minutes((l_suppkey * 7 + l_partkey) % 520 - 20) END AS dropoff_datetime
  FROM arrived
),
trips AS (
  SELECT service_type, CAST(l_suppkey AS VARCHAR) AS vendor_id, pickup_datetime, dropoff_datetime,
    CAST(l_linenumber + l_partkey % 4 AS DOUBLE) AS passenger_count,
    (l_quantity - 2) * 0.5 AS trip_distance,
    {_PU} AS pickup_location_id,
    CASE WHEN l_partkey % 229 <> 0 THEN l_suppkey * 3 % 265 + 1 END AS dropoff_location_id,
    CAST(l_linenumber % 6 + 1 AS DOUBLE) AS rate_code_id,
    CASE l_returnflag WHEN 'N' THEN ' n ' WHEN 'A' THEN 'y' END AS store_and_fwd_flag,
    CAST(l_linenumber AS BIGINT) AS payment_type,
    CASE WHEN l_partkey % 233 <> 0 THEN {_FARE} END AS fare_amount,
    CASE WHEN l_linestatus <> 'O' THEN CAST(1.0 AS DOUBLE) END AS extra_amount,
    CAST(0.5 AS DOUBLE) AS mta_tax, {_TIP} AS tip_amount, {_TOLLS} AS tolls_amount,
    CAST(0.3 AS DOUBLE) AS improvement_surcharge,
    CASE WHEN l_partkey % 239 = 0 THEN NULL WHEN l_partkey % 241 = 0 THEN CAST(0.0 AS DOUBLE)
         ELSE {_rnd(f"({_FARE} + {_TIP} + {_TOLLS})")} END AS total_amount,
    CASE WHEN l_partkey % 3 <> 0 THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
    CASE WHEN {_PU} IN (1, 132, 138) THEN CAST(1.25 AS DOUBLE) END AS airport_fee,
    CAST(NULL AS DOUBLE) AS ehail_fee,
    CASE WHEN service_type = 'green' THEN CAST(1.0 AS DOUBLE) END AS trip_type,
    CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
    service_type || '_tripdata_' || strftime(base_ts, '%Y-%m') || '.parquet' AS source_file,
    {AT} AS ingestion_timestamp, ' pending ' AS quality_status
  FROM timed
)"""


def _from(source: str) -> str:
    """CTEs from a table of canonical trips to evidence and metrics."""
    return f"""
keyed AS (
  SELECT * REPLACE (
      upper(trim(store_and_fwd_flag)) AS store_and_fwd_flag, upper(trim(quality_status)) AS quality_status,
      coalesce(extra_amount, 0.0) AS extra_amount, coalesce(mta_tax, 0.0) AS mta_tax,
      coalesce(improvement_surcharge, 0.0) AS improvement_surcharge,
      coalesce(congestion_surcharge, 0.0) AS congestion_surcharge, coalesce(ehail_fee, 0.0) AS ehail_fee),
    sha256(service_type || '|' || coalesce(CAST(pickup_datetime AS VARCHAR), '')
      || '|' || coalesce(CAST(dropoff_datetime AS VARCHAR), '')
      || '|' || coalesce(CAST(pickup_location_id AS VARCHAR), '')
      || '|' || coalesce(CAST(dropoff_location_id AS VARCHAR), '')
      || '|' || coalesce(CAST(fare_amount AS VARCHAR), '') || '|' || source_file) AS trip_id
  FROM {source}
),
deduped AS (
  SELECT * FROM keyed
  QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY ingestion_timestamp NULLS FIRST,
    trip_distance NULLS FIRST, tip_amount NULLS FIRST, tolls_amount NULLS FIRST, payment_type NULLS FIRST,
    total_amount NULLS FIRST, vendor_id NULLS FIRST, passenger_count NULLS FIRST, rate_code_id NULLS FIRST,
    store_and_fwd_flag NULLS FIRST, extra_amount NULLS FIRST, mta_tax NULLS FIRST,
    improvement_surcharge NULLS FIRST, congestion_surcharge NULLS FIRST, airport_fee NULLS FIRST,
    ehail_fee NULLS FIRST, trip_type NULLS FIRST, quality_status NULLS FIRST) = 1
),
{_metrics("measured", "keyed")},
{_metrics("silver", "deduped")},
checked AS (
  SELECT *, coalesce(
      pickup_datetime IS NULL OR dropoff_datetime IS NULL OR pickup_location_id IS NULL
      OR dropoff_location_id IS NULL OR fare_amount IS NULL OR total_amount IS NULL
      OR pickup_datetime >= dropoff_datetime OR year < 2018 OR year > 2024 OR fare_amount < 0
      OR total_amount <= 0 OR trip_duration_minutes <= 0 OR trip_duration_minutes > 480, false) AS rejected,
    pickup_datetime IS NULL OR dropoff_datetime IS NULL OR pickup_location_id IS NULL
      OR dropoff_location_id IS NULL OR fare_amount IS NULL OR total_amount IS NULL AS null_critical
  FROM silver
),
valid AS (
  SELECT * EXCLUDE (rejected, null_critical) REPLACE (
    CASE WHEN is_suspicious_trip THEN 'SUSPICIOUS' ELSE 'VALID' END AS quality_status)
  FROM checked WHERE NOT rejected
),
gold_trips_clean AS (
  SELECT trip_id, service_type, pickup_datetime, dropoff_datetime, trip_duration_minutes, trip_distance,
    pickup_location_id, dropoff_location_id, payment_type, fare_amount, tip_amount, total_amount,
    tip_percentage, average_speed_mph, fare_per_mile, is_airport_trip, is_suspicious_trip, year, month,
    source_file, DATE '2024-01-01' AS processing_date, quality_status
  FROM valid
),
quality_rejected_records AS ({_EVIDENCE}),
gold_daily_revenue AS (
  SELECT service_type, CAST(pickup_datetime AS DATE) AS trip_date, COUNT(*) AS total_trips,
    {_rsum("total_amount")} AS total_revenue, {_ravg("fare_amount")} AS average_fare,
    {_ravg("tip_amount")} AS average_tip, {_ravg("trip_distance")} AS average_trip_distance,
    {_ravg("trip_duration_minutes")} AS average_trip_duration,
    COUNT(*) FILTER (is_suspicious_trip) AS suspicious_trips,
    {_pct("COUNT(*) FILTER (quality_status = 'VALID')", "COUNT(*)")} AS quality_percentage
  FROM gold_trips_clean GROUP BY 1, 2
),
gold_location_performance AS (
  SELECT service_type, pickup_location_id, dropoff_location_id, COUNT(*) AS total_trips,
    {_rsum("total_amount")} AS total_revenue, {_ravg("fare_amount")} AS average_fare,
    {_ravg("trip_distance")} AS average_distance, {_ravg("trip_duration_minutes")} AS average_duration,
    COUNT(*) FILTER (is_suspicious_trip) AS suspicious_trip_count,
    {_ravg("average_speed_mph")} AS average_speed_mph
  FROM gold_trips_clean GROUP BY 1, 2, 3
),
quality_metrics_summary AS (
  SELECT '{RUN}' AS process_id, v.service_type, year, month,
    valid_records + coalesce(evidence, 0) AS total_records, valid_records,
    coalesce(evidence, 0) AS rejected_records, CAST(0 AS BIGINT) AS duplicate_records,
    CAST(0 AS BIGINT) AS null_critical_records, suspicious_records,
    {_pct("valid_records", "valid_records + coalesce(evidence, 0)")} AS quality_percentage,
    {AT} AS processed_at
  FROM (SELECT service_type, year, month, COUNT(*) AS valid_records,
               COUNT(*) FILTER (is_suspicious_trip) AS suspicious_records
        FROM valid GROUP BY 1, 2, 3) v
  LEFT JOIN (SELECT service_type, COUNT(*) AS evidence FROM quality_rejected_records GROUP BY 1) r
    ON v.service_type = r.service_type
)"""


def _metrics(name: str, source: str) -> str:
    speed = _rnd(
        "(CASE WHEN trip_duration_minutes > 0 AND trip_distance > 0 "
        "THEN trip_distance / (trip_duration_minutes / 60.0) END)"
    )
    tip = _rnd("(CASE WHEN fare_amount > 0 THEN coalesce(tip_amount, 0.0) / fare_amount * 100.0 END)")
    return f"""
{name}_1 AS (
  SELECT *, {_rnd("(CAST(epoch(dropoff_datetime) - epoch(pickup_datetime) AS DOUBLE) / 60.0)")} AS trip_duration_minutes
  FROM {source}
),
{name}_2 AS (
  SELECT *, {speed} AS average_speed_mph,
    {_rnd("(CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END)", 4)} AS fare_per_mile,
    {tip} AS tip_percentage,
    pickup_location_id IN (1, 132, 138) OR dropoff_location_id IN (1, 132, 138) AS is_airport_trip
  FROM {name}_1
),
{name} AS (
  SELECT *, trip_distance <= 0 OR total_amount <= 0 OR fare_amount < 0 OR trip_duration_minutes <= 0
    OR trip_duration_minutes > 480 OR average_speed_mph > 100 OR tip_percentage > 100
    OR pickup_datetime >= dropoff_datetime AS is_suspicious_trip
  FROM {name}_2
)"""


# id, name, stage, column, category, condition, technical reason, business reason
_RULES = [
    ("BR-001", "null_pickup_datetime", "BRONZE", "pickup_datetime", "NULL_CRITICAL_FIELD",
     "pickup_datetime IS NULL", "IS NULL", "La fecha de recogida es obligatoria para cualquier análisis"),
    ("BR-002", "null_dropoff_datetime", "BRONZE", "dropoff_datetime", "NULL_CRITICAL_FIELD",
     "dropoff_datetime IS NULL", "IS NULL", "La fecha de llegada es obligatoria para calcular duración y tarifas"),
    ("BR-003", "null_pickup_location", "BRONZE", "pickup_location_id", "NULL_CRITICAL_FIELD",
     "pickup_location_id IS NULL", "IS NULL", "La zona de recogida es necesaria para análisis geoespacial"),
    ("BR-004", "null_dropoff_location", "BRONZE", "dropoff_location_id", "NULL_CRITICAL_FIELD",
     "dropoff_location_id IS NULL", "IS NULL", "La zona de destino es necesaria para análisis de rutas"),
    ("BR-014", "null_fare_amount", "BRONZE", "fare_amount", "NULL_CRITICAL_FIELD",
     "fare_amount IS NULL", "IS NULL", "La tarifa es crítica para análisis de ingresos"),
    ("BR-015", "null_total_amount", "BRONZE", "total_amount", "NULL_CRITICAL_FIELD",
     "total_amount IS NULL", "IS NULL", "El total pagado es fundamental para reportes financieros"),
    ("BR-005", "invalid_date_order", "SILVER", "pickup_datetime", "INVALID_DATE_ORDER",
     "pickup_datetime >= dropoff_datetime", "pickup_datetime >= dropoff_datetime",
     "Imposible que la recogida ocurra después o igual que la llegada"),
    ("BR-006", "out_of_range_year", "SILVER", "year", "OUT_OF_RANGE_DATE",
     "year < 2018 OR year > 2024", "year < 2018 OR year > 2024", "Solo se procesan datos del período 2018-2024"),
    ("BR-007", "negative_fare_amount", "SILVER", "fare_amount", "NEGATIVE_AMOUNT",
     "fare_amount < 0", "fare_amount < 0", "Una tarifa negativa indica error de registro o fraude potencial"),
    ("BR-008", "invalid_total_amount", "SILVER", "total_amount", "INVALID_AMOUNT",
     "total_amount <= 0", "total_amount <= 0", "Un pago de cero o negativo no puede corresponder a un viaje real"),
    ("BR-010", "invalid_duration", "SILVER", "trip_duration_minutes", "INVALID_DURATION",
     "trip_duration_minutes <= 0 OR trip_duration_minutes > 480", "trip_duration_minutes <= 0 OR > 480",
     "Viajes de 0 o más de 480 min son operacionalmente imposibles"),
]


def _evidence_of(rule: tuple) -> str:
    rule_id, name, stage, column, category, condition, technical, business = rule
    return f"""
  SELECT '{RUN}' AS process_id, trip_id, service_type, source_file, '{stage}' AS rejection_stage,
    '{rule_id}' AS rejection_rule_id, '{name}' AS rejection_rule, '{column}' AS rejection_column,
    coalesce(CAST({column} AS VARCHAR), 'NULL') AS original_value, '{technical}' AS technical_reason,
    '{business}' AS business_reason, '{category}' AS rejection_category, {AT} AS rejected_at
  FROM silver WHERE {condition}"""


_EVIDENCE = "\n  UNION ALL".join(_evidence_of(r) for r in _RULES)

# Trips as the conformance of the raw feeds leaves them.
_CONFORMED = """
conformed AS (
  SELECT * REPLACE (
    CASE WHEN service_type <> 'fhvhv' THEN passenger_count END AS passenger_count,
    CASE WHEN service_type <> 'fhvhv' THEN rate_code_id END AS rate_code_id,
    CASE WHEN service_type <> 'fhvhv' THEN store_and_fwd_flag END AS store_and_fwd_flag,
    CASE WHEN service_type <> 'fhvhv' THEN payment_type END AS payment_type,
    CASE WHEN service_type <> 'fhvhv' THEN extra_amount END AS extra_amount,
    CASE WHEN service_type <> 'fhvhv' THEN improvement_surcharge END AS improvement_surcharge,
    CASE WHEN service_type = 'fhvhv' THEN coalesce(fare_amount, 0.0) + coalesce(tolls_amount, 0.0)
         + coalesce(mta_tax, 0.0) + coalesce(congestion_surcharge, 0.0) + coalesce(airport_fee, 0.0)
         + coalesce(tip_amount, 0.0) + CAST(0.1 AS DOUBLE) ELSE total_amount END AS total_amount,
    CASE WHEN service_type <> 'green' THEN airport_fee END AS airport_fee,
    'PENDING' AS quality_status)
  FROM trips
),
recovered AS (
  SELECT * REPLACE (
    CASE WHEN NOT (service_type = 'yellow' AND source_file LIKE '%2024-%') THEN airport_fee END AS airport_fee)
  FROM conformed WHERE NOT (service_type = 'green' AND source_file LIKE '%2025-%')
)"""

_READ_ERRORS = [
    ("NOT_RECOVERABLE_CORRUPT_METADATA", ["magic number", "corrupt", "invalid header", "bad magic"]),
    ("NOT_RECOVERABLE_EMPTY_FILE", ["no files found", "empty", "file is empty", "0 rows"]),
    ("NOT_RECOVERABLE_UNSUPPORTED_FORMAT", ["codec", "unsupported", "not supported", "brotli", "lz4"]),
    ("RECOVERABLE_SCHEMA_MISMATCH", ["schema", "field", "column name"]),
    ("RECOVERABLE_MISSING_COLUMNS", ["missing", "not found", "column"]),
    ("RECOVERABLE_TYPE_CASTING", ["type", "cast", "cannot", "convert"]),
    ("PARTIALLY_RECOVERABLE", ["partial"]),
]
_ACTIONS = [
    ("SUCCESS", "Ninguna — archivo válido"),
    ("NOT_RECOVERABLE_CORRUPT_METADATA", "Solicitar re-extracción del archivo fuente. Verificar integridad con parquet-tools."),
    ("NOT_RECOVERABLE_EMPTY_FILE", "Verificar en fuente si el mes tiene datos. Podría ser un mes sin viajes."),
    ("NOT_RECOVERABLE_UNSUPPORTED_FORMAT", "Actualizar versión de PySpark o verificar codec disponible."),
    ("RECOVERABLE_SCHEMA_MISMATCH", "Aplicar reconstrucción de esquema canónico en Fase 2."),
    ("RECOVERABLE_MISSING_COLUMNS", "Completar columnas faltantes con NULL en Fase 2."),
    ("RECOVERABLE_TYPE_CASTING", "Aplicar conversión de tipos controlada en Fase 2."),
    ("PARTIALLY_RECOVERABLE", "Intentar lectura parcial y enviar registros inválidos a cuarentena."),
    ("NOT_RECOVERABLE_UNKNOWN", "Analizar el error manualmente. Considerar re-descarga."),
]

_TABLES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem",
    "nation", "orders", "pages", "part", "region", "supplier",
)

_PATHS = """
paths AS (
  SELECT CASE payment_type
      WHEN 1 THEN '/raw/' || service_type || '/year=' || y || '/month=' || m || '/part-0.parquet'
      WHEN 2 THEN '/raw/' || source_file
      WHEN 3 THEN '/raw/bad_parquet/x-' || y || '-' || m || '.parquet'
      WHEN 4 THEN '/raw/misc/FHVHV-' || y || '-' || m || '.parquet'
      WHEN 5 THEN '/raw/misc/trips-' || y || '-1.parquet'
      ELSE '/raw/misc/' || m || '.parquet' END AS file_path
  FROM (SELECT *, regexp_extract(source_file, '_(\\d{4})-', 1) AS y,
               regexp_extract(source_file, '-(\\d{2})\\.', 1) AS m FROM trips)
),
distinct_paths AS (SELECT file_path, COUNT(*) AS trips FROM paths GROUP BY 1)"""


_DELIVERIES = """(SELECT DISTINCT service_type, regexp_extract(source_file, '_(\\d{4})-', 1) AS y,
    regexp_extract(source_file, '-(\\d{2})\\.', 1) AS m FROM trips)"""
_LATE_GREEN = "(service_type = 'green' AND y = '2025')"
_LATE_YELLOW = "(service_type = 'yellow' AND y = '2024')"


# The contracts of the feeds, written out here so that they do not come from the engine. Fixed values.
_CONTRACT = """(SELECT * FROM (VALUES
  ('yellow', 'VendorID', 'long', 'vendor_id', false),
  ('yellow', 'tpep_pickup_datetime', 'timestamp', 'pickup_datetime', true),
  ('yellow', 'tpep_dropoff_datetime', 'timestamp', 'dropoff_datetime', true),
  ('yellow', 'passenger_count', 'double', 'passenger_count', false),
  ('yellow', 'trip_distance', 'double', 'trip_distance', true),
  ('yellow', 'RatecodeID', 'double', 'rate_code_id', false),
  ('yellow', 'store_and_fwd_flag', 'string', 'store_and_fwd_flag', false),
  ('yellow', 'PULocationID', 'long', 'pickup_location_id', true),
  ('yellow', 'DOLocationID', 'long', 'dropoff_location_id', true),
  ('yellow', 'payment_type', 'long', 'payment_type', false),
  ('yellow', 'fare_amount', 'double', 'fare_amount', true),
  ('yellow', 'extra', 'double', 'extra_amount', false),
  ('yellow', 'mta_tax', 'double', 'mta_tax', false),
  ('yellow', 'tip_amount', 'double', 'tip_amount', false),
  ('yellow', 'tolls_amount', 'double', 'tolls_amount', false),
  ('yellow', 'improvement_surcharge', 'double', 'improvement_surcharge', false),
  ('yellow', 'total_amount', 'double', 'total_amount', true),
  ('yellow', 'congestion_surcharge', 'double', 'congestion_surcharge', false),
  ('yellow', 'Airport_fee', 'double', 'airport_fee', false),
  ('green', 'VendorID', 'long', 'vendor_id', false),
  ('green', 'lpep_pickup_datetime', 'timestamp', 'pickup_datetime', true),
  ('green', 'lpep_dropoff_datetime', 'timestamp', 'dropoff_datetime', true),
  ('green', 'store_and_fwd_flag', 'string', 'store_and_fwd_flag', false),
  ('green', 'RatecodeID', 'double', 'rate_code_id', false),
  ('green', 'PULocationID', 'long', 'pickup_location_id', true),
  ('green', 'DOLocationID', 'long', 'dropoff_location_id', true),
  ('green', 'passenger_count', 'double', 'passenger_count', false),
  ('green', 'trip_distance', 'double', 'trip_distance', true),
  ('green', 'fare_amount', 'double', 'fare_amount', true),
  ('green', 'extra', 'double', 'extra_amount', false),
  ('green', 'mta_tax', 'double', 'mta_tax', false),
  ('green', 'tip_amount', 'double', 'tip_amount', false),
  ('green', 'tolls_amount', 'double', 'tolls_amount', false),
  ('green', 'ehail_fee', 'double', 'ehail_fee', false),
  ('green', 'improvement_surcharge', 'double', 'improvement_surcharge', false),
  ('green', 'total_amount', 'double', 'total_amount', true),
  ('green', 'payment_type', 'double', 'payment_type', false),
  ('green', 'trip_type', 'double', 'trip_type', false),
  ('green', 'congestion_surcharge', 'double', 'congestion_surcharge', false),
  ('fhvhv', 'hvfhs_license_num', 'string', 'vendor_id', true),
  ('fhvhv', 'dispatching_base_num', 'string', NULL, false),
  ('fhvhv', 'originating_base_num', 'string', NULL, false),
  ('fhvhv', 'request_datetime', 'timestamp', NULL, false),
  ('fhvhv', 'on_scene_datetime', 'timestamp', NULL, false),
  ('fhvhv', 'pickup_datetime', 'timestamp', 'pickup_datetime', true),
  ('fhvhv', 'dropoff_datetime', 'timestamp', 'dropoff_datetime', true),
  ('fhvhv', 'PULocationID', 'long', 'pickup_location_id', true),
  ('fhvhv', 'DOLocationID', 'long', 'dropoff_location_id', true),
  ('fhvhv', 'trip_miles', 'double', 'trip_distance', true),
  ('fhvhv', 'trip_time', 'long', NULL, false),
  ('fhvhv', 'base_passenger_fare', 'double', 'fare_amount', true),
  ('fhvhv', 'tolls', 'double', 'tolls_amount', false),
  ('fhvhv', 'bcf', 'double', NULL, false),
  ('fhvhv', 'sales_tax', 'double', 'mta_tax', false),
  ('fhvhv', 'congestion_surcharge', 'double', 'congestion_surcharge', false),
  ('fhvhv', 'airport_fee', 'double', 'airport_fee', false),
  ('fhvhv', 'tips', 'double', 'tip_amount', false),
  ('fhvhv', 'driver_pay', 'double', NULL, false),
  ('fhvhv', 'shared_request_flag', 'string', NULL, false),
  ('fhvhv', 'shared_match_flag', 'string', NULL, false),
  ('fhvhv', 'wav_request_flag', 'string', NULL, false),
  ('fhvhv', 'wav_match_flag', 'string', NULL, false)
) AS v(service_type, name, type, canonical, critical))"""


def _q(body: str, source: str = "trips") -> str:
    return f"WITH {_TRIPS},{_CONFORMED},{_PATHS},{_from(source)}\n{body}"


def _gate(columns: str, group: str) -> str:
    return f"SELECT {columns} FROM checked GROUP BY {group}"


def _aliases(column: str) -> str:
    groups = {
        "long": "'long','bigint','int64'", "double": "'double','float64','float'", "string": "'string','str','varchar'",
        "timestamp": "'timestamp','datetime'", "integer": "'integer','int','int32'", "boolean": "'boolean','bool'",
    }
    whens = " ".join(f"WHEN lower({column}) IN ({names}) THEN '{k}'" for k, names in groups.items())
    return f"(CASE {whens} ELSE lower({column}) END)"


def oracle_sql() -> dict[str, str]:
    status = "CASE " + " ".join(
        f"WHEN {' OR '.join(f'contains(t, {chr(39)}{w}{chr(39)})' for w in words)} THEN '{name}'"
        for name, words in _READ_ERRORS
    ) + " ELSE 'NOT_RECOVERABLE_UNKNOWN' END"
    action = "CASE s " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _ACTIONS) + " END"
    period = "service_type, year, month"
    found = {
        "file_inventory": " UNION ALL ".join(
            f"SELECT '{t}.parquet' AS file_name, '{'unknown'}' AS service_type, 'SUCCESS' AS read_status, "
            f"(SELECT COUNT(*) FROM {t}) AS record_count, "
            f"CAST((SELECT COUNT(*) FROM (DESCRIBE SELECT * FROM {t})) AS INTEGER) AS column_count"
            for t in _TABLES
        ),
        "deep_validate": " UNION ALL ".join(
            f"SELECT '{t}.parquet' AS file_name, (SELECT COUNT(*) FROM {t}) AS decoded_rows, 'OK' AS decode_status"
            for t in _TABLES
        ),
        "file_row_counts": _q("""
            SELECT service_type, y AS partition_year, m AS partition_month, 'SUCCESS' AS read_status,
                   COUNT(*) AS records,
                   CAST(CASE service_type WHEN 'yellow' THEN 19 WHEN 'fhvhv' THEN 23
                        ELSE CASE WHEN y = '2025' THEN 19 ELSE 20 END END AS INTEGER) AS column_count
            FROM (SELECT *, regexp_extract(source_file, '_(\\d{4})-', 1) AS y,
                         regexp_extract(source_file, '-(\\d{2})\\.', 1) AS m FROM trips)
            GROUP BY 1, 2, 3, 4, 6
            UNION ALL SELECT 'bad_parquet', NULL, NULL, 'NOT_RECOVERABLE_CORRUPT_METADATA', 0, 0
            UNION ALL SELECT 'bad_parquet', NULL, NULL, 'NOT_RECOVERABLE_EMPTY_FILE', 0, 0"""),
        "schema_diagnosis": _q(f"""
            SELECT service_type, y AS partition_year, m AS partition_month, 'DIAGNOSED' AS status,
              CAST(CASE WHEN service_type = 'fhvhv' THEN 23 WHEN service_type = 'yellow' THEN 19
                        WHEN {_LATE_GREEN} THEN 19 ELSE 20 END AS INTEGER) AS actual_columns,
              CAST(CASE service_type WHEN 'fhvhv' THEN 23 WHEN 'yellow' THEN 19 ELSE 20 END AS INTEGER)
                AS expected_columns,
              CASE WHEN {_LATE_GREEN} THEN 'total_amount' WHEN {_LATE_YELLOW} THEN 'Airport_fee' ELSE '' END
                AS missing_columns,
              CASE WHEN {_LATE_YELLOW} THEN 'cbd_fee' ELSE '' END AS extra_columns,
              CASE WHEN {_LATE_YELLOW} THEN 'VendorID long integertype()' ELSE '' END AS type_mismatches,
              CASE WHEN {_LATE_GREEN} THEN 'total_amount' ELSE '' END AS missing_critical,
              {_LATE_GREEN} OR {_LATE_YELLOW} AS has_issues, NOT ({_LATE_GREEN}) AS is_recoverable
            FROM {_DELIVERIES}"""),
        "versioned_diagnosis": _q(f"""
            SELECT service_type, y AS partition_year, m AS partition_month,
              CASE WHEN service_type = 'yellow' AND y || '-' || m >= '2024-01' THEN '2024-01' END AS contract_version,
              CAST(CASE service_type WHEN 'fhvhv' THEN 23 WHEN 'yellow' THEN 19 ELSE 20 END AS INTEGER) AS expected_columns,
              CASE WHEN {_LATE_GREEN} THEN 'total_amount' WHEN service_type = 'yellow' AND y > '2024' THEN 'cbd_fee' ELSE '' END AS missing_columns,
              CASE WHEN service_type = 'yellow' AND y > '2024' THEN 'Airport_fee' ELSE '' END AS extra_columns,
              {_LATE_GREEN} OR (service_type = 'yellow' AND y > '2024') AS has_issues, NOT ({_LATE_GREEN}) AS is_recoverable
            FROM {_DELIVERIES}"""),
        "contract_fields": _q(f"""
            SELECT c.service_type, c.name, c.type, c.canonical, c.critical, coalesce(n, 0) - coalesce(lost, 0) AS records
            FROM {_CONTRACT} c
            LEFT JOIN (SELECT service_type, COUNT(*) AS n FROM trips GROUP BY 1) t ON c.service_type = t.service_type
            LEFT JOIN (SELECT CASE service_type WHEN 'green' THEN 'total_amount' ELSE 'Airport_fee' END AS name,
                              service_type, COUNT(*) AS lost
                       FROM (SELECT *, regexp_extract(source_file, '_(\\d{{4}})-', 1) AS y FROM trips)
                       WHERE {_LATE_GREEN} OR {_LATE_YELLOW} GROUP BY 1, 2) l
              ON c.service_type = l.service_type AND c.name = l.name"""),
        "mapping_matrix": _q(f"""
            SELECT canonical, MAX(name) FILTER (c.service_type = 'yellow') AS yellow,
              MAX(name) FILTER (c.service_type = 'green') AS green, MAX(name) FILTER (c.service_type = 'fhvhv') AS fhvhv
            FROM {_CONTRACT} c JOIN (SELECT DISTINCT service_type FROM trips) t ON c.service_type = t.service_type
            WHERE canonical IS NOT NULL GROUP BY canonical"""),
        "schema_quarantine": _q(f"""
            SELECT service_type, y AS partition_year, m AS partition_month, 'total_amount' AS missing_critical,
              'SCHEMA_NOT_RECOVERABLE_OR_HOMOLOGATION_FAILED' AS quarantine_reason, 'SCHEMA_RECOVERY' AS stage,
              {AT} AS quarantine_timestamp
            FROM {_DELIVERIES} WHERE {_LATE_GREEN}"""),
        "file_quarantine": _q(f"""
            SELECT 'ETL-20240101-000000-0000ABCD' AS process_id, name AS file_name, 'bad_parquet' AS service_type,
                   status AS read_status, CAST(0 AS BIGINT) AS record_count, {AT} AS quarantine_timestamp,
                   'EXTRACTION' AS quarantine_stage, action AS recommended_action, FALSE AS is_recoverable
            FROM (VALUES
              ('wrong_magic.parquet', 'NOT_RECOVERABLE_CORRUPT_METADATA',
               'Solicitar re-extracción del archivo fuente. Verificar integridad con parquet-tools.'),
              ('empty.parquet', 'NOT_RECOVERABLE_EMPTY_FILE',
               'Verificar en fuente si el mes tiene datos. Podría ser un mes sin viajes.')) AS bad(name, status, action)"""),
        "problem_files": """
            SELECT * FROM (VALUES ('empty.parquet', 'NOT_RECOVERABLE_EMPTY_FILE'),
              ('wrong_magic.parquet', 'NOT_RECOVERABLE_CORRUPT_METADATA')) AS bad(file_name, read_status)""",
        "v4_inventory_status": _q("""
            SELECT service_type, 'SUCCESS' AS read_status, COUNT(*) AS records FROM trips GROUP BY 1
            UNION ALL SELECT 'bad_parquet', 'NOT_RECOVERABLE_CORRUPT_METADATA', 0
            UNION ALL SELECT 'bad_parquet', 'NOT_RECOVERABLE_EMPTY_FILE', 0"""),
        "inventory_by_status": _q("""
            SELECT 'SUCCESS' AS read_status, COUNT(*) AS records FROM trips
            UNION ALL SELECT 'NOT_RECOVERABLE_CORRUPT_METADATA', 0
            UNION ALL SELECT 'NOT_RECOVERABLE_EMPTY_FILE', 0"""),
        "inventory_listing": _q("""
            SELECT service_type, 'SUCCESS' AS read_status,
                   CAST(CASE service_type WHEN 'yellow' THEN 19 WHEN 'fhvhv' THEN 23
                        ELSE CASE WHEN y = '2025' THEN 19 ELSE 20 END END AS INTEGER) AS column_count,
                   y AS partition_year, m AS partition_month, COUNT(*) AS records
            FROM (SELECT *, regexp_extract(source_file, '_(\\d{4})-', 1) AS y,
                         regexp_extract(source_file, '-(\\d{2})\\.', 1) AS m FROM trips)
            GROUP BY 1, 2, 3, 4, 5
            UNION ALL SELECT 'bad_parquet', 'NOT_RECOVERABLE_CORRUPT_METADATA', 0, NULL, NULL, 0
            UNION ALL SELECT 'bad_parquet', 'NOT_RECOVERABLE_EMPTY_FILE', 0, NULL, NULL, 0"""),
        "verification_report": _q(
            " UNION ALL ".join(
                f"SELECT '{name}' AS query, (SELECT COUNT(*) FROM ({body})) AS rows, 'OK' AS status"
                for name, body in {
                    "v1_revenue_by_service": "SELECT DISTINCT service_type FROM gold_trips_clean",
                    "v2_quality_by_period": "SELECT DISTINCT service_type, year, month FROM gold_trips_clean",
                    "v3_top_routes": "SELECT DISTINCT pickup_location_id, dropoff_location_id FROM gold_trips_clean LIMIT 20",
                    "v4_inventory_status": "SELECT DISTINCT service_type FROM trips UNION ALL VALUES ('corrupt'), ('empty')",
                    "v5_rejection_reasons": "SELECT DISTINCT rejection_rule, service_type FROM quality_rejected_records LIMIT 20",
                    "v6_top_days": "SELECT DISTINCT service_type, pickup_datetime::DATE FROM gold_trips_clean LIMIT 10",
                    "v7_suspicious_rate": "SELECT DISTINCT service_type FROM gold_trips_clean",
                    "v8_date_integrity": "SELECT DISTINCT service_type, year, month FROM gold_trips_clean",
                }.items()
            ),
            "recovered",
        ),
        "detect_service": _q("""
            SELECT file_path, trips, CASE
                WHEN contains(lower(file_path), 'yellow') THEN 'yellow'
                WHEN contains(lower(file_path), 'green') THEN 'green'
                WHEN contains(lower(file_path), 'fhvhv') THEN 'fhvhv'
                WHEN contains(lower(file_path), 'bad') THEN 'bad_parquet' ELSE 'unknown' END AS service_type
            FROM distinct_paths"""),
        "partition_from_path": _q("""
            SELECT file_path, trips,
              CASE WHEN contains(file_path, '/year=') THEN regexp_extract(file_path, '/year=([^/]*)/', 1)
                   WHEN regexp_matches(file_path, '-\\d{4}-[^-/]*\\.parquet$')
                   THEN regexp_extract(file_path, '-(\\d{4})-[^-/]*\\.parquet$', 1) END AS partition_year,
              CASE WHEN contains(file_path, '/month=') THEN regexp_extract(file_path, '/month=([^/]*)/', 1)
                   WHEN regexp_matches(file_path, '[-/]\\d{2}\\.parquet$')
                   THEN regexp_extract(file_path, '[-/](\\d{2})\\.parquet$', 1) END AS partition_month
            FROM distinct_paths"""),
        "classify_read_error": f"""
            SELECT doc_id, s AS read_status,
                   starts_with(s, 'RECOVERABLE') OR s = 'PARTIALLY_RECOVERABLE' AS is_recoverable,
                   {action} AS recommended_action
            FROM (SELECT doc_id, {status} AS s FROM (SELECT doc_id, lower(text) AS t FROM documents))""",
        "type_compat": f"""
            SELECT expected, actual, COUNT(*) AS pairs, {_aliases("expected")} = {_aliases("actual")} AS compatible
            FROM (SELECT ['long','double','string','timestamp','integer','boolean','date'][l_linenumber] AS expected,
                         ['bigint','Float','varchar','datetime','int32','bool','decimal(10,2)','date'][l_suppkey % 8 + 1]
                           AS actual FROM lineitem)
            GROUP BY expected, actual""",
        "fhvhv_total": _q("""
            SELECT source_file, pickup_datetime, fare_amount AS base_passenger_fare, total_amount
            FROM conformed WHERE service_type = 'fhvhv'"""),
        "safe_cast": _q("""
            SELECT source_file, vendor_id, pickup_datetime,
              CASE WHEN payment_type IS DISTINCT FROM 3 THEN dropoff_datetime END AS dropoff_datetime,
              CASE WHEN payment_type IS DISTINCT FROM 3 THEN pickup_location_id END AS pickup_location_id,
              payment_type,
              CASE WHEN payment_type IS DISTINCT FROM 3 THEN fare_amount END AS fare_amount, total_amount
            FROM conformed WHERE service_type = 'yellow'"""),
        "union_feeds": _q(f"""
            SELECT {period}, COUNT(*) AS trips, COUNT(passenger_count) AS with_passengers,
              {_rsum("fare_amount")} AS fares, {_rsum("tip_amount")} AS tips
            FROM conformed GROUP BY {period}"""),
        "bronze_from_files": _q(f"""
            SELECT {period}, COUNT(*) AS trips, COUNT(airport_fee) AS with_airport_fee,
              {_rsum("fare_amount")} AS fares, {_rsum("total_amount")} AS totals
            FROM recovered GROUP BY {period}"""),
        "idempotent_load": _q("""
            SELECT p AS process_id, rejection_rule_id, COUNT(*) AS rows
            FROM quality_rejected_records, (VALUES ('ETL-A'), ('ETL-B')) AS runs(p)
            GROUP BY 1, 2"""),
        "pruned_scan": _q("""
            SELECT pickup_datetime, total_amount, trip_distance
            FROM silver WHERE service_type = 'yellow' AND year = 2023"""),
        "final_stats": _q(f"""
            SELECT (SELECT COUNT(*) FROM gold_trips_clean) AS gold_trips,
                   (SELECT COUNT(*) FROM quality_rejected_records) AS rejected_records,
                   CAST({len(_TABLES)} AS BIGINT) AS files_inventoried,
                   (SELECT COUNT(*) FROM gold_daily_revenue) AS daily_revenue_rows,
                   (SELECT COUNT(*) FROM gold_location_performance) AS location_rows,
                   {_rnd("(SELECT AVG(quality_percentage) FROM quality_metrics_summary)")} AS avg_quality_pct"""),
        "trip_id": _q("SELECT trip_id, service_type, source_file FROM keyed"),
        "trip_duration": _q("SELECT trip_id, trip_duration_minutes FROM measured"),
        "average_speed": _q("SELECT trip_id, average_speed_mph FROM measured"),
        "fare_per_mile": _q("SELECT trip_id, fare_per_mile FROM measured"),
        "tip_percentage": _q("SELECT trip_id, tip_percentage FROM measured"),
        "airport_trips": _q("SELECT trip_id, is_airport_trip FROM measured WHERE is_airport_trip"),
        "suspicious_trips": _q("SELECT trip_id, is_suspicious_trip FROM measured WHERE is_suspicious_trip"),
        "partition_recompute": _q("""
            SELECT source_file, year, month, COUNT(*) AS trips FROM keyed GROUP BY 1, 2, 3"""),
        "normalize_amounts": _q("""
            SELECT trip_id, extra_amount, mta_tax, improvement_surcharge, congestion_surcharge, ehail_fee, airport_fee
            FROM keyed"""),
        "normalize_strings": _q("""
            SELECT service_type, store_and_fwd_flag, quality_status, COUNT(*) AS trips FROM keyed GROUP BY 1, 2, 3"""),
        "dedup_trips": _q("""
            SELECT trip_id, trip_distance, tip_amount, tolls_amount, payment_type, total_amount FROM deduped"""),
        "survivors": _q("""
            SELECT d.trip_id, copies, trip_distance, tip_amount, tolls_amount, payment_type, total_amount FROM deduped d
            JOIN (SELECT trip_id, COUNT(*) AS copies FROM keyed GROUP BY 1) k ON d.trip_id = k.trip_id"""),
        "merged_unique_trips": _q(f"""
            SELECT {period}, COUNT(DISTINCT trip_id) AS unique_trips, true AS within_bound FROM gold_trips_clean GROUP BY {period}"""),
        "incremental_run": _q("""
            SELECT CASE WHEN service_type = 'yellow' AND y <> '2024' THEN 'ETL-A' ELSE 'ETL-B' END AS process_id, service_type,
              y AS partition_year, m AS partition_month, COUNT(*) AS records,
              CAST(SUM(COUNT(*)) OVER (PARTITION BY service_type) AS BIGINT) AS bronze_of_service
            FROM (SELECT service_type, split_part(split_part(source_file, '_', 3), '-', 1) AS y,
                    split_part(split_part(source_file, '-', 2), '.', 1) AS m FROM trips)
            WHERE NOT (service_type = 'green' AND y = '2025') GROUP BY 1, 2, 3, 4"""),
        "manifest_files": _q("""
            SELECT file_name, COALESCE(expected, 0) AS expected, COALESCE(delivered, 0) AS delivered,
              CASE WHEN expected IS NULL THEN 'UNEXPECTED' WHEN delivered IS NULL THEN 'MISSING'
                   WHEN delivered > expected THEN 'REPEATED' ELSE 'EXPECTED' END AS status
            FROM (SELECT s || '_tripdata_' || strftime(DATE '2017-01-01' + to_months(CAST(i AS INTEGER)), '%Y-%m') || '.parquet' AS file_name, 1 AS expected
                  FROM (SELECT DISTINCT service_type AS s FROM trips), range(36) AS r(i))
            FULL JOIN (SELECT source_file AS file_name, COUNT(DISTINCT payment_type % 2) AS delivered FROM trips GROUP BY 1) USING (file_name)"""),
        "schema_versions": _q("""
            SELECT service_type, COUNT(DISTINCT (service_type = 'yellow' AND source_file LIKE '%_2024-%')
                OR (service_type = 'green' AND source_file LIKE '%_2025-%')) AS versions, COUNT(*) AS records FROM trips GROUP BY 1"""),
        "file_contents": _q("""
            SELECT service_type, true AS all_readable, true AS all_different, true AS measured, COUNT(*) AS records FROM trips GROUP BY 1"""),
        "inventory_load": _q("""
            SELECT 'ETL-A' AS process_id, source_file AS file_name, CASE WHEN COUNT(*) % 3 = 0 THEN 0 ELSE COUNT(*) END AS record_count,
              CAST(19 AS INTEGER) AS column_count, CASE WHEN COUNT(*) % 3 <> 0 THEN MAX(pickup_datetime) END AS processed_at
            FROM trips GROUP BY source_file"""),
        "dedup_stats": _q(f"""
            SELECT b AS rows_before, a AS rows_after, b - a AS duplicates_removed,
                   {_pct("(b - a)", "b")} AS duplicate_pct
            FROM (SELECT COUNT(*) AS b, COUNT(DISTINCT trip_id) AS a FROM keyed)"""),
        "valid_trips": _q("SELECT trip_id, service_type, quality_status FROM valid"),
        "quality_status": _q("""
            SELECT service_type, is_suspicious_trip, quality_status, COUNT(*) AS trips FROM valid GROUP BY 1, 2, 3"""),
        "rejected_records": _q("SELECT * FROM quality_rejected_records"),
        "quality_metrics": _q("SELECT * FROM quality_metrics_summary"),
        "quality_metrics_join": _q("SELECT * FROM quality_metrics_summary"),
        "quality_metrics_by_period": _q(f"""
            SELECT c.service_type, c.year, c.month, input_records,
              input_records - total_records AS duplicate_records, total_records, valid_records,
              total_records - valid_records AS rejected_records, null_critical_records, suspicious_records,
              {_pct("valid_records", "total_records")} AS quality_percentage
            FROM (SELECT {period}, COUNT(*) AS total_records, COUNT(*) FILTER (NOT rejected) AS valid_records,
                         COUNT(*) FILTER (null_critical) AS null_critical_records,
                         COUNT(*) FILTER (NOT rejected AND is_suspicious_trip) AS suspicious_records
                  FROM checked GROUP BY {period}) c
            JOIN (SELECT {period}, COUNT(*) AS input_records FROM keyed GROUP BY {period}) k
              ON c.service_type = k.service_type AND c.year IS NOT DISTINCT FROM k.year
             AND c.month IS NOT DISTINCT FROM k.month"""),
        "rejection_rate_gate": _q(f"""
            SELECT *, rejection_pct <= 80 AS within_limit FROM (
              SELECT {period}, COUNT(*) AS trips, COUNT(*) FILTER (rejected) AS rejected_trips,
                {_pct("COUNT(*) FILTER (rejected)", "COUNT(*)")} AS rejection_pct
              FROM checked GROUP BY {period})"""),
        "gold_trips_clean": _q("SELECT * FROM gold_trips_clean"),
        "gold_daily_revenue": _q("SELECT * FROM gold_daily_revenue"),
        "gold_location_performance": _q("SELECT * FROM gold_location_performance"),
        "bronze_distribution": _q("""
            SELECT service_type, COUNT(*) AS total_records, MIN(pickup_datetime) AS first_pickup,
                   MAX(pickup_datetime) AS last_pickup FROM trips GROUP BY 1"""),
        "suspicious_profile": _q(f"""
            SELECT service_type, is_suspicious_trip, COUNT(*) AS trips, {_ravg("trip_distance")} AS avg_distance,
                   {_ravg("total_amount")} AS avg_total FROM silver GROUP BY 1, 2"""),
        "suspicious_sample": _q("""
            SELECT trip_id, service_type, trip_duration_minutes, average_speed_mph, trip_distance, total_amount,
                   tip_percentage FROM silver WHERE is_suspicious_trip ORDER BY trip_id LIMIT 5"""),
        "phase_counters": _q(f"""
            SELECT *, records_in - records_out AS duplicates_removed,
              {_pct("suspicious_trips", "records_out")} AS suspicious_pct,
              {_pct("airport_trips", "records_out")} AS airport_pct,
              {_pct("valid_records", "(valid_records + rejected_records)")} AS quality_pct
            FROM (SELECT (SELECT COUNT(*) FROM keyed) AS records_in,
                    (SELECT COUNT(*) FROM silver) AS records_out,
                    (SELECT COUNT(*) FROM silver WHERE is_suspicious_trip) AS suspicious_trips,
                    (SELECT COUNT(*) FROM silver WHERE is_airport_trip) AS airport_trips,
                    (SELECT COUNT(*) FROM valid) AS valid_records,
                    (SELECT COUNT(*) FROM quality_rejected_records) AS rejected_records)"""),
        "v1_revenue_by_service": _q(_V1),
        "pipeline_revenue": _q(_V1, "recovered"),
        "v2_quality_by_period": _q(f"""
            SELECT service_type, year, month, total_records, valid_records, rejected_records, suspicious_records,
                   {_rnd("quality_percentage")} AS quality_pct FROM quality_metrics_summary"""),
        "v3_top_routes": _q(f"""
            SELECT pickup_location_id, dropoff_location_id, COUNT(*) AS total_trips,
                   {_rsum("total_amount")} AS total_revenue, {_ravg("trip_duration_minutes")} AS avg_duration
            FROM gold_trips_clean GROUP BY 1, 2 ORDER BY total_revenue DESC, 1, 2 LIMIT 20"""),
        "v5_rejection_reasons": _q("""
            SELECT rejection_category, rejection_rule, service_type, COUNT(*) AS rejected_records
            FROM quality_rejected_records GROUP BY 1, 2, 3 ORDER BY rejected_records DESC, 1, 2, 3 LIMIT 20"""),
        "v6_top_days": _q("""
            SELECT trip_date, service_type, total_trips, total_revenue, average_fare AS avg_fare,
                   quality_percentage AS quality_pct
            FROM gold_daily_revenue ORDER BY total_revenue DESC, trip_date, service_type LIMIT 10"""),
        "v7_suspicious_rate": _q(f"""
            SELECT service_type, COUNT(*) AS total_trips, COUNT(*) FILTER (is_suspicious_trip) AS suspicious,
              {_pct("COUNT(*) FILTER (is_suspicious_trip)", "COUNT(*)")} AS suspicious_pct
            FROM gold_trips_clean GROUP BY 1"""),
        "v8_date_integrity": _q("""
            SELECT service_type, year, month, COUNT(*) AS trips, CAST(MIN(pickup_datetime) AS DATE) AS earliest,
                   CAST(MAX(pickup_datetime) AS DATE) AS latest FROM gold_trips_clean GROUP BY 1, 2, 3"""),
        "rejection_reasons": _q("""
            SELECT rejection_category, rejection_rule, COUNT(*) AS rejected_records
            FROM quality_rejected_records GROUP BY 1, 2"""),
        "rejection_share": _q(f"""
            SELECT rejection_category, n AS total_rejected, d AS services_affected,
              {_pct("n", "(SELECT COUNT(*) FROM quality_rejected_records)")} AS pct_of_total
            FROM (SELECT rejection_category, COUNT(*) AS n, COUNT(DISTINCT service_type) AS d
                  FROM quality_rejected_records GROUP BY 1)"""),
        "top_routes_service": _q(f"""
            SELECT pickup_location_id, dropoff_location_id, service_type, COUNT(*) AS trips,
                   {_rsum("total_amount")} AS revenue
            FROM gold_trips_clean GROUP BY 1, 2, 3 ORDER BY revenue DESC, 1, 2, 3 LIMIT 5"""),
        "monthly_service_stats": _q(f"""
            SELECT {period}, COUNT(*) AS trips, {_rsum("total_amount", 0)} AS total_revenue,
              {_ravg("trip_duration_minutes", 1)} AS avg_duration_min, {_ravg("average_speed_mph", 1)} AS avg_speed_mph
            FROM valid GROUP BY {period}"""),
        "unique_trips": _q(f"SELECT {period}, COUNT(DISTINCT trip_id) AS unique_trips FROM valid GROUP BY {period}"),
        "global_quality": _q(f"""
            SELECT *, {_pct("valid_records", "total_records")} AS valid_pct,
              {_pct("rejected_records", "total_records")} AS rejected_pct,
              {_pct("suspicious_records", "total_records")} AS suspicious_pct
            FROM (SELECT CAST(SUM(total_records) AS BIGINT) AS total_records,
                         CAST(SUM(valid_records) AS BIGINT) AS valid_records,
                         CAST(SUM(rejected_records) AS BIGINT) AS rejected_records,
                         CAST(SUM(suspicious_records) AS BIGINT) AS suspicious_records
                  FROM quality_metrics_summary)"""),
        "quality_by_service": _q(f"""
            SELECT service_type, {_rnd("AVG(quality_percentage)")} AS avg_quality_pct
            FROM quality_metrics_summary GROUP BY 1"""),
        "normal_vs_suspicious": _q("""
            SELECT service_type, COUNT(*) AS total_trips, COUNT(*) FILTER (is_suspicious_trip) AS suspicious,
                   COUNT(*) - COUNT(*) FILTER (is_suspicious_trip) AS normal FROM gold_trips_clean GROUP BY 1"""),
        "payment_type_check": _q("""
            SELECT trip_id, service_type, 'invalid_payment_type' AS rejection_rule,
                   CAST(payment_type AS VARCHAR) AS original_value,
                   'payment_type NOT IN (1, 2, 3, 4, 5, 6)' AS technical_reason
            FROM silver WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6)"""),
        "passenger_count_check": _q("""
            SELECT trip_id, service_type, 'invalid_passenger_count' AS rejection_rule,
                   CAST(passenger_count AS VARCHAR) AS original_value,
                   'passenger_count < 0 OR passenger_count > 9' AS technical_reason
            FROM silver WHERE passenger_count < 0 OR passenger_count > 9"""),
    }
    minima = {"duration": "trip_duration_minutes", "fare": "fare_amount", "total": "total_amount", "distance": "trip_distance"}
    for name, column in minima.items():
        found[f"minimum_{name}_check"] = _q(f"""
            SELECT trip_id, service_type, '{name}_below_minimum' AS rejection_rule,
                   CAST({column} AS VARCHAR) AS original_value, '{column} < 0.0' AS technical_reason
            FROM silver WHERE {column} < 0""")
    for service in ("yellow", "green", "fhvhv"):
        found[f"conform_{service}"] = _q(f"SELECT * FROM conformed WHERE service_type = '{service}'")
    for rule in _RULES:
        found[f"reject_{rule[0].lower().replace('-', '_')}"] = _q(
            "SELECT trip_id, service_type, source_file, original_value FROM quality_rejected_records "
            f"WHERE rejection_rule_id = '{rule[0]}'"
        )
    marks = {"br_009": ("trip_distance", "<= 0"), "br_011": ("average_speed_mph", "> 100"), "br_012": ("tip_percentage", "> 100")}
    for key, (column, test) in marks.items():
        found[f"flag_{key}"] = _q(
            f"SELECT trip_id, service_type, is_suspicious_trip, {column} AS flagged_value FROM silver WHERE {column} {test}"
        )
    return found


_V1 = f"""
    SELECT service_type, COUNT(*) AS total_trips, {_rsum("total_amount")} AS total_revenue,
           {_ravg("fare_amount")} AS avg_fare, {_ravg("trip_duration_minutes")} AS avg_duration_min,
           {_ravg("trip_distance")} AS avg_distance_miles
    FROM gold_trips_clean GROUP BY service_type"""
