"""Fixed values of the trip model: schemas, feed contracts, rule catalogue, file statuses.

Everything here is data, in natural order, so that it can be read, reviewed and diffed.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERVICES = ("yellow", "green", "fhvhv")

STRING, DOUBLE, BIGINT, INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
BOOLEAN, DATE, TIMESTAMP = T.BooleanType(), T.DateType(), T.TimestampType()


@dataclass(frozen=True)
class Field:
    """A column that a feed is expected to deliver; canonical is the column of the trip model that it fills, if any."""

    name: str
    type: str
    canonical: str | None
    critical: bool = False


@dataclass(frozen=True)
class Rule:
    """One rule as data; `predicate` is Spark SQL text that is true for an offending row. Names in braces are limits."""

    rule_id: str
    name: str
    column: str
    stage: str
    category: str
    severity: str
    predicate: str
    technical_reason: str = ""
    business_reason: str = ""

    def broken(self) -> Column:
        """True or NULL or False, as the predicate says."""
        return F.expr(f"({self.predicate})")

    def with_limits(self, limits: dict[str, object]) -> Rule:
        texts = {c: getattr(self, c).format(**limits) for c in ("predicate", "technical_reason", "business_reason")}
        return replace(self, **texts)


# --- Fixed values: canonical trip model (28 fields, in order) ---------------------------------

CANONICAL_SCHEMA = T.StructType([
    T.StructField("trip_id", STRING),
    T.StructField("service_type", STRING),
    T.StructField("vendor_id", STRING),
    T.StructField("pickup_datetime", TIMESTAMP),
    T.StructField("dropoff_datetime", TIMESTAMP),
    T.StructField("passenger_count", DOUBLE),
    T.StructField("trip_distance", DOUBLE),
    T.StructField("pickup_location_id", BIGINT),
    T.StructField("dropoff_location_id", BIGINT),
    T.StructField("rate_code_id", DOUBLE),
    T.StructField("store_and_fwd_flag", STRING),
    T.StructField("payment_type", BIGINT),
    T.StructField("fare_amount", DOUBLE),
    T.StructField("extra_amount", DOUBLE),
    T.StructField("mta_tax", DOUBLE),
    T.StructField("tip_amount", DOUBLE),
    T.StructField("tolls_amount", DOUBLE),
    T.StructField("improvement_surcharge", DOUBLE),
    T.StructField("total_amount", DOUBLE),
    T.StructField("congestion_surcharge", DOUBLE),
    T.StructField("airport_fee", DOUBLE),
    T.StructField("ehail_fee", DOUBLE),
    T.StructField("trip_type", DOUBLE),
    T.StructField("year", INT),
    T.StructField("month", INT),
    T.StructField("source_file", STRING),
    T.StructField("ingestion_timestamp", TIMESTAMP),
    T.StructField("quality_status", STRING),
])

# Canonical names whose source column must exist for a file to be recoverable.
CRITICAL_COLUMNS = (
    "pickup_datetime", "dropoff_datetime",
    "pickup_location_id", "dropoff_location_id",
    "fare_amount", "total_amount",
)

# --- Fixed values: feed contracts -------------------------------------------------------------

FEED_CONTRACTS = {
    "yellow": (
        Field("VendorID", "long", "vendor_id"),
        Field("tpep_pickup_datetime", "timestamp", "pickup_datetime", critical=True),
        Field("tpep_dropoff_datetime", "timestamp", "dropoff_datetime", critical=True),
        Field("passenger_count", "double", "passenger_count"),
        Field("trip_distance", "double", "trip_distance", critical=True),
        Field("RatecodeID", "double", "rate_code_id"),
        Field("store_and_fwd_flag", "string", "store_and_fwd_flag"),
        Field("PULocationID", "long", "pickup_location_id", critical=True),
        Field("DOLocationID", "long", "dropoff_location_id", critical=True),
        Field("payment_type", "long", "payment_type"),
        Field("fare_amount", "double", "fare_amount", critical=True),
        Field("extra", "double", "extra_amount"),
        Field("mta_tax", "double", "mta_tax"),
        Field("tip_amount", "double", "tip_amount"),
        Field("tolls_amount", "double", "tolls_amount"),
        Field("improvement_surcharge", "double", "improvement_surcharge"),
        Field("total_amount", "double", "total_amount", critical=True),
        Field("congestion_surcharge", "double", "congestion_surcharge"),
        Field("Airport_fee", "double", "airport_fee"),
    ),
    "green": (
        Field("VendorID", "long", "vendor_id"),
        Field("lpep_pickup_datetime", "timestamp", "pickup_datetime", critical=True),
        Field("lpep_dropoff_datetime", "timestamp", "dropoff_datetime", critical=True),
        Field("store_and_fwd_flag", "string", "store_and_fwd_flag"),
        Field("RatecodeID", "double", "rate_code_id"),
        Field("PULocationID", "long", "pickup_location_id", critical=True),
        Field("DOLocationID", "long", "dropoff_location_id", critical=True),
        Field("passenger_count", "double", "passenger_count"),
        Field("trip_distance", "double", "trip_distance", critical=True),
        Field("fare_amount", "double", "fare_amount", critical=True),
        Field("extra", "double", "extra_amount"),
        Field("mta_tax", "double", "mta_tax"),
        Field("tip_amount", "double", "tip_amount"),
        Field("tolls_amount", "double", "tolls_amount"),
        Field("ehail_fee", "double", "ehail_fee"),
        Field("improvement_surcharge", "double", "improvement_surcharge"),
        Field("total_amount", "double", "total_amount", critical=True),
        Field("payment_type", "double", "payment_type"),
        Field("trip_type", "double", "trip_type"),
        Field("congestion_surcharge", "double", "congestion_surcharge"),
    ),
    "fhvhv": (
        Field("hvfhs_license_num", "string", "vendor_id", critical=True),
        Field("dispatching_base_num", "string", None),
        Field("originating_base_num", "string", None),
        Field("request_datetime", "timestamp", None),
        Field("on_scene_datetime", "timestamp", None),
        Field("pickup_datetime", "timestamp", "pickup_datetime", critical=True),
        Field("dropoff_datetime", "timestamp", "dropoff_datetime", critical=True),
        Field("PULocationID", "long", "pickup_location_id", critical=True),
        Field("DOLocationID", "long", "dropoff_location_id", critical=True),
        Field("trip_miles", "double", "trip_distance", critical=True),
        Field("trip_time", "long", None),
        Field("base_passenger_fare", "double", "fare_amount", critical=True),
        Field("tolls", "double", "tolls_amount"),
        Field("bcf", "double", None),
        Field("sales_tax", "double", "mta_tax"),
        Field("congestion_surcharge", "double", "congestion_surcharge"),
        Field("airport_fee", "double", "airport_fee"),
        Field("tips", "double", "tip_amount"),
        Field("driver_pay", "double", None),
        Field("shared_request_flag", "string", None),
        Field("shared_match_flag", "string", None),
        Field("wav_request_flag", "string", None),
        Field("wav_match_flag", "string", None),
    ),
}

# Components of the derived total of the feed that has no total of its own, in summation order.
DERIVED_TOTAL_COMPONENTS = (
    "fare_amount", "tolls_amount", "mta_tax", "congestion_surcharge",
    "airport_fee", "tip_amount", "bcf",
)

# Spellings that count as the same type when a file is compared with its contract.
TYPE_ALIASES = {
    "long": ("long", "bigint", "int64", "longtype()"),
    "double": ("double", "float64", "doubletype()", "float"),
    "string": ("string", "str", "stringtype()", "varchar"),
    "timestamp": ("timestamp", "timestamptype()", "datetime"),
    "integer": ("integer", "int", "int32", "integertype()"),
    "boolean": ("boolean", "bool", "booleantype()"),
}

# --- Fixed values: derived metrics ------------------------------------------------------------

AIRPORT_LOCATION_IDS = (1, 132, 138)
OPTIONAL_AMOUNTS = (
    "extra_amount", "mta_tax", "improvement_surcharge", "congestion_surcharge", "ehail_fee",
)
TRIP_KEY = (
    "service_type", "pickup_datetime", "dropoff_datetime",
    "pickup_location_id", "dropoff_location_id", "fare_amount", "source_file",
)

# A trip is suspicious when any of these holds (SQL three-valued OR).
SUSPICIOUS_CONDITIONS = (
    "trip_distance <= 0",
    "total_amount <= 0",
    "fare_amount < 0",
    "trip_duration_minutes <= 0",
    "trip_duration_minutes > {max_duration}",
    "average_speed_mph > {max_speed}",
    "tip_percentage > {max_tip}",
    "pickup_datetime >= dropoff_datetime",
)

# --- Fixed values: rejection rules ------------------------------------------------------------

REJECTION_RULES = (
    Rule(
        "BR-001", "null_pickup_datetime", "pickup_datetime", "BRONZE", "NULL_CRITICAL_FIELD", "CRITICAL",
        "pickup_datetime IS NULL",
        "IS NULL",
        "La fecha de recogida es obligatoria para cualquier análisis",
    ),
    Rule(
        "BR-002", "null_dropoff_datetime", "dropoff_datetime", "BRONZE", "NULL_CRITICAL_FIELD", "CRITICAL",
        "dropoff_datetime IS NULL",
        "IS NULL",
        "La fecha de llegada es obligatoria para calcular duración y tarifas",
    ),
    Rule(
        "BR-003", "null_pickup_location", "pickup_location_id", "BRONZE", "NULL_CRITICAL_FIELD", "CRITICAL",
        "pickup_location_id IS NULL",
        "IS NULL",
        "La zona de recogida es necesaria para análisis geoespacial",
    ),
    Rule(
        "BR-004", "null_dropoff_location", "dropoff_location_id", "BRONZE", "NULL_CRITICAL_FIELD", "CRITICAL",
        "dropoff_location_id IS NULL",
        "IS NULL",
        "La zona de destino es necesaria para análisis de rutas",
    ),
    Rule(
        "BR-014", "null_fare_amount", "fare_amount", "BRONZE", "NULL_CRITICAL_FIELD", "CRITICAL",
        "fare_amount IS NULL",
        "IS NULL",
        "La tarifa es crítica para análisis de ingresos",
    ),
    Rule(
        "BR-015", "null_total_amount", "total_amount", "BRONZE", "NULL_CRITICAL_FIELD", "CRITICAL",
        "total_amount IS NULL",
        "IS NULL",
        "El total pagado es fundamental para reportes financieros",
    ),
    Rule(
        "BR-005", "invalid_date_order", "pickup_datetime", "SILVER", "INVALID_DATE_ORDER", "CRITICAL",
        "pickup_datetime >= dropoff_datetime",
        "pickup_datetime >= dropoff_datetime",
        "Imposible que la recogida ocurra después o igual que la llegada",
    ),
    Rule(
        "BR-006", "out_of_range_year", "year", "SILVER", "OUT_OF_RANGE_DATE", "HIGH",
        "year < {year_min} OR year > {year_max}",
        "year < {year_min} OR year > {year_max}",
        "Solo se procesan datos del período {year_min}-{year_max}",
    ),
    Rule(
        "BR-007", "negative_fare_amount", "fare_amount", "SILVER", "NEGATIVE_AMOUNT", "HIGH",
        "fare_amount < 0",
        "fare_amount < 0",
        "Una tarifa negativa indica error de registro o fraude potencial",
    ),
    Rule(
        "BR-008", "invalid_total_amount", "total_amount", "SILVER", "INVALID_AMOUNT", "HIGH",
        "total_amount <= 0",
        "total_amount <= 0",
        "Un pago de cero o negativo no puede corresponder a un viaje real",
    ),
    Rule(
        "BR-010", "invalid_duration", "trip_duration_minutes", "SILVER", "INVALID_DURATION", "MEDIUM",
        "trip_duration_minutes <= 0 OR trip_duration_minutes > {max_duration}",
        "trip_duration_minutes <= 0 OR > {max_duration}",
        "Viajes de 0 o más de {max_duration} min son operacionalmente imposibles",
    ),
)

# Rules that only mark a trip, or are enforced by deduplication, never by rejection.
MARKING_RULES = (
    Rule(
        "BR-009", "zero_or_negative_distance", "trip_distance", "SILVER", "INVALID_DISTANCE", "MEDIUM",
        "trip_distance <= 0",
    ),
    Rule(
        "BR-011", "unrealistic_speed", "average_speed_mph", "SILVER", "UNREALISTIC_SPEED", "MEDIUM",
        "average_speed_mph > {max_speed}",
    ),
    Rule(
        "BR-012", "excessive_tip_percentage", "tip_percentage", "SILVER", "EXCESSIVE_TIP", "LOW",
        "tip_percentage > {max_tip}",
    ),
)

# Checks the configuration declares limits for; switched on by name only.
OPT_IN_RULES = (
    Rule(
        "CFG-PAYMENT", "invalid_payment_type", "payment_type", "SILVER", "INVALID_PAYMENT_TYPE", "LOW",
        "payment_type NOT IN ({payment_types})",
        "payment_type NOT IN ({payment_types})",
        "Payment type outside the configured list",
    ),
    Rule(
        "CFG-PASSENGERS", "invalid_passenger_count", "passenger_count", "SILVER", "INVALID_PASSENGER_COUNT", "LOW",
        "passenger_count < {min_passengers} OR passenger_count > {max_passengers}",
        "passenger_count < {min_passengers} OR passenger_count > {max_passengers}",
        "Passenger count outside the configured range",
    ),
    Rule(
        "CFG-MIN-DURATION", "duration_below_minimum", "trip_duration_minutes", "SILVER", "DURATION_BELOW_MINIMUM", "LOW",
        "trip_duration_minutes < {min_duration}",
        "trip_duration_minutes < {min_duration}",
        "Duration below the configured minimum",
    ),
    Rule(
        "CFG-MIN-FARE", "fare_below_minimum", "fare_amount", "SILVER", "FARE_BELOW_MINIMUM", "LOW",
        "fare_amount < {min_fare}",
        "fare_amount < {min_fare}",
        "Fare below the configured minimum",
    ),
    Rule(
        "CFG-MIN-TOTAL", "total_below_minimum", "total_amount", "SILVER", "TOTAL_BELOW_MINIMUM", "LOW",
        "total_amount < {min_total}",
        "total_amount < {min_total}",
        "Total below the configured minimum",
    ),
    Rule(
        "CFG-MIN-DISTANCE", "distance_below_minimum", "trip_distance", "SILVER", "DISTANCE_BELOW_MINIMUM", "LOW",
        "trip_distance < {min_distance}",
        "trip_distance < {min_distance}",
        "Distance below the configured minimum",
    ),
)

# --- Fixed values: file audit -----------------------------------------------------------------

STATUS_SUCCESS = "SUCCESS"
STATUS_EMPTY = "NOT_RECOVERABLE_EMPTY_FILE"
STATUS_NOT_FOUND = "NOT_RECOVERABLE_FILE_NOT_FOUND"
STATUS_UNKNOWN = "NOT_RECOVERABLE_UNKNOWN"
STATUS_MISSING_COLUMNS = "RECOVERABLE_MISSING_COLUMNS"

# Ordered: the first status with a keyword inside the lower-cased message wins.
READ_ERROR_KEYWORDS = (
    ("NOT_RECOVERABLE_CORRUPT_METADATA", ("magic number", "corrupt", "invalid header", "bad magic")),
    ("NOT_RECOVERABLE_EMPTY_FILE", ("no files found", "empty", "file is empty", "0 rows")),
    ("NOT_RECOVERABLE_UNSUPPORTED_FORMAT", ("codec", "unsupported", "not supported", "brotli", "lz4")),
    ("RECOVERABLE_SCHEMA_MISMATCH", ("schema", "field", "column name")),
    ("RECOVERABLE_MISSING_COLUMNS", ("missing", "not found", "column")),
    ("RECOVERABLE_TYPE_CASTING", ("type", "cast", "cannot", "convert")),
    ("PARTIALLY_RECOVERABLE", ("partial",)),
)

RECOMMENDED_ACTIONS = {
    "SUCCESS": "Ninguna — archivo válido",
    "NOT_RECOVERABLE_CORRUPT_METADATA": "Solicitar re-extracción del archivo fuente. Verificar integridad con parquet-tools.",
    "NOT_RECOVERABLE_EMPTY_FILE": "Verificar en fuente si el mes tiene datos. Podría ser un mes sin viajes.",
    "NOT_RECOVERABLE_UNSUPPORTED_FORMAT": "Actualizar versión de PySpark o verificar codec disponible.",
    "RECOVERABLE_SCHEMA_MISMATCH": "Aplicar reconstrucción de esquema canónico en Fase 2.",
    "RECOVERABLE_MISSING_COLUMNS": "Completar columnas faltantes con NULL en Fase 2.",
    "RECOVERABLE_TYPE_CASTING": "Aplicar conversión de tipos controlada en Fase 2.",
    "PARTIALLY_RECOVERABLE": "Intentar lectura parcial y enviar registros inválidos a cuarentena.",
    "NOT_RECOVERABLE_UNKNOWN": "Analizar el error manualmente. Considerar re-descarga.",
}
DEFAULT_ACTION = "Analizar manualmente."
MESSAGE_NOT_FOUND = "Archivo no encontrado en disco"
MESSAGE_EMPTY = "Archivo vacío (0 bytes)"
SOURCE_SYSTEM_TRIPS = "NYC_TLC"
SOURCE_SYSTEM_BAD_FILES = "Apache_Parquet_Testing"
SCHEMA_QUARANTINE_REASON = "SCHEMA_NOT_RECOVERABLE_OR_HOMOLOGATION_FAILED"

# --- Fixed values: published tables -----------------------------------------------------------

PUBLISHED_TABLES = {
    "gold_trips_clean": T.StructType([
        T.StructField("trip_id", STRING),
        T.StructField("service_type", STRING),
        T.StructField("pickup_datetime", TIMESTAMP),
        T.StructField("dropoff_datetime", TIMESTAMP),
        T.StructField("trip_duration_minutes", DOUBLE),
        T.StructField("trip_distance", DOUBLE),
        T.StructField("pickup_location_id", BIGINT),
        T.StructField("dropoff_location_id", BIGINT),
        T.StructField("payment_type", BIGINT),
        T.StructField("fare_amount", DOUBLE),
        T.StructField("tip_amount", DOUBLE),
        T.StructField("total_amount", DOUBLE),
        T.StructField("tip_percentage", DOUBLE),
        T.StructField("average_speed_mph", DOUBLE),
        T.StructField("fare_per_mile", DOUBLE),
        T.StructField("is_airport_trip", BOOLEAN),
        T.StructField("is_suspicious_trip", BOOLEAN),
        T.StructField("year", INT),
        T.StructField("month", INT),
        T.StructField("source_file", STRING),
        T.StructField("processing_date", DATE),
        T.StructField("quality_status", STRING),
    ]),
    "gold_daily_revenue": T.StructType([
        T.StructField("service_type", STRING),
        T.StructField("trip_date", DATE),
        T.StructField("total_trips", BIGINT),
        T.StructField("total_revenue", DOUBLE),
        T.StructField("average_fare", DOUBLE),
        T.StructField("average_tip", DOUBLE),
        T.StructField("average_trip_distance", DOUBLE),
        T.StructField("average_trip_duration", DOUBLE),
        T.StructField("suspicious_trips", BIGINT),
        T.StructField("quality_percentage", DOUBLE),
    ]),
    "gold_location_performance": T.StructType([
        T.StructField("service_type", STRING),
        T.StructField("pickup_location_id", BIGINT),
        T.StructField("dropoff_location_id", BIGINT),
        T.StructField("total_trips", BIGINT),
        T.StructField("total_revenue", DOUBLE),
        T.StructField("average_fare", DOUBLE),
        T.StructField("average_distance", DOUBLE),
        T.StructField("average_duration", DOUBLE),
        T.StructField("suspicious_trip_count", BIGINT),
        T.StructField("average_speed_mph", DOUBLE),
    ]),
    "quality_rejected_records": T.StructType([
        T.StructField("process_id", STRING),
        T.StructField("trip_id", STRING),
        T.StructField("service_type", STRING),
        T.StructField("source_file", STRING),
        T.StructField("rejection_stage", STRING),
        T.StructField("rejection_rule_id", STRING),
        T.StructField("rejection_rule", STRING),
        T.StructField("rejection_column", STRING),
        T.StructField("original_value", STRING),
        T.StructField("technical_reason", STRING),
        T.StructField("business_reason", STRING),
        T.StructField("rejection_category", STRING),
        T.StructField("rejected_at", TIMESTAMP),
    ]),
    "quality_metrics_summary": T.StructType([
        T.StructField("process_id", STRING),
        T.StructField("service_type", STRING),
        T.StructField("year", INT),
        T.StructField("month", INT),
        T.StructField("total_records", BIGINT),
        T.StructField("valid_records", BIGINT),
        T.StructField("rejected_records", BIGINT),
        T.StructField("duplicate_records", BIGINT),
        T.StructField("null_critical_records", BIGINT),
        T.StructField("suspicious_records", BIGINT),
        T.StructField("quality_percentage", DOUBLE),
        T.StructField("processed_at", TIMESTAMP),
    ]),
    "audit_file_inventory": T.StructType([
        T.StructField("process_id", STRING),
        T.StructField("source_system", STRING),
        T.StructField("service_type", STRING),
        T.StructField("file_name", STRING),
        T.StructField("file_path", STRING),
        T.StructField("file_size_mb", DOUBLE),
        T.StructField("partition_year", STRING),
        T.StructField("partition_month", STRING),
        T.StructField("read_status", STRING),
        T.StructField("record_count", BIGINT),
        T.StructField("column_count", INT),
        T.StructField("schema_hash", STRING),
        T.StructField("error_message", STRING),
        T.StructField("processed_at", TIMESTAMP),
    ]),
}


def published_schema(table: str) -> T.StructType:
    return PUBLISHED_TABLES[table]


def feed_contract(service: str) -> list[dict]:
    """The contract of one feed as rows: service_type, name, type, canonical (or None), critical."""
    return [{"service_type": service, **asdict(f)} for f in FEED_CONTRACTS[service]]


def source_names(service: str) -> dict[str, str]:
    """canonical name -> source column name, for one feed."""
    return {f.canonical: f.name for f in FEED_CONTRACTS[service] if f.canonical}
