"""Schema diagnosis: the columns of each file against the contract of its feed.

Works on a frame with one row per file and its column list as an array, so every comparison is a
row-local array expression; the only join is with the contracts, one row per feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions import paths

CONTRACT_DDL = "service_type STRING, name STRING, type STRING, canonical STRING, critical BOOLEAN"
DOCUMENT_DDL = (
    "service_type STRING, valid_from STRING, valid_to STRING, "
    "fields ARRAY<STRUCT<name: STRING, type: STRING, critical: BOOLEAN>>, column_mapping_to_canonical MAP<STRING, STRING>"
)


def contract_fields(spark: SparkSession) -> DataFrame:
    """The feed contracts, one row per expected column."""
    rows = [r for service in C.SERVICES for r in C.feed_contract(service)]
    return spark.createDataFrame(rows, CONTRACT_DDL)


def read_contract(spark: SparkSession, path: str, service: str | None = None) -> DataFrame:
    """Contracts kept as JSON documents (`fields`, `column_mapping_to_canonical`), as rows.

    A document names its feed in `service_type`, unless one is given, and may hold from and until a delivery month
    (`valid_from`, `valid_to`, as 2024-01, both included). `path` is a document or a folder of them.
    """
    documents = spark.read.schema(DOCUMENT_DDL).option("multiLine", True).json(path)
    named = F.col("service_type") if service is None else F.lit(service)
    return documents.select(named.alias("service_type"), "valid_from", "valid_to", F.col("column_mapping_to_canonical").alias("mapping"), F.explode("fields").alias("f")).select(
        "service_type",
        F.col("f.name").alias("name"),
        F.col("f.type").alias("type"),
        F.try_element_at("mapping", F.col("f.name")).alias("canonical"),
        F.coalesce(F.col("f.critical"), F.lit(False)).alias("critical"),
        "valid_from",
        "valid_to",
    )


def contract_registry(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The built-in contracts, valid at any time, and the versions below path, which go before them while they are valid."""
    built_in = contract_fields(spark).withColumns({"valid_from": F.lit(None).cast("string"), "valid_to": F.lit(None).cast("string")})
    return built_in if path is None else built_in.unionByName(read_contract(spark, path))


def source_names(contracts: DataFrame) -> dict[str, dict[str, tuple[str, ...]]]:
    """Feed -> canonical column -> source columns that versions of its contract name, the newest version's first."""
    rows = contracts.filter("canonical IS NOT NULL").orderBy(F.col("valid_from").desc_nulls_last(), "name").collect()
    names: dict[str, dict[str, tuple[str, ...]]] = {}
    for r in rows:
        known = names.setdefault(r.service_type, {})
        known[r.canonical] = tuple(dict.fromkeys((*known.get(r.canonical, ()), r.name)))
    return names


def mapping_matrix(contracts: DataFrame) -> DataFrame:
    """Canonical column x feed -> source column name."""
    return (
        contracts.filter(F.col("canonical").isNotNull())
        .groupBy("canonical")
        .pivot("service_type", list(C.SERVICES))
        .agg(F.first("name"))
        .orderBy("canonical")
    )


def _contract_by_feed(contracts: DataFrame) -> DataFrame:
    """One row per feed: the versions of its contract, the one that begins last at the end."""
    critical = F.col("canonical").isin(*C.CRITICAL_COLUMNS)
    validity = [c if c in contracts.columns else F.lit(None).cast("string").alias(c) for c in ("valid_from", "valid_to")]
    versions = contracts.select("service_type", "name", "type", "canonical", "critical", *validity).groupBy("service_type", "valid_from", "valid_to").agg(
        F.collect_list(F.struct("name", "type")).alias("expected"),
        F.collect_list(F.when(critical, F.col("name"))).alias("critical_names"),
        F.collect_list(F.when(F.col("critical"), F.col("name"))).alias("declared_critical"),
    )
    one = F.struct("valid_from", "valid_to", "expected", "critical_names", "declared_critical")
    return versions.groupBy("service_type").agg(F.array_sort(F.collect_list(one)).alias("versions"))


def _delivered(path: Column) -> Column:
    """Delivery month of a file, as 2024-01, where its path tells it."""
    return F.concat(paths.partition_value(path, "year"), F.lit("-"), F.lpad(paths.partition_value(path, "month"), 2, "0"))


def diagnose(files: DataFrame, contracts: DataFrame) -> DataFrame:
    """One diagnosis row per file.

    `files` needs: service_type, file_path, file_name, schema_hash and
    columns array<struct<name,type>>. Names are compared in exact case. A file of a feed without a
    contract gets status NO_EXPECTED_SCHEMA and counts as recoverable.

    Where contracts have versions (valid_from, valid_to), a file is held against the one that is valid in its delivery month,
    of several the one that begins last; a file whose path tells no month, against the latest.
    """
    month = _delivered(F.col("file_path"))
    valid = lambda v: (
        month.isNull() | (F.coalesce(v["valid_from"] <= month, F.lit(True)) & F.coalesce(month <= v["valid_to"], F.lit(True)))
    )
    joined = files.join(_contract_by_feed(contracts), "service_type", "left").withColumn(
        "version", F.try_element_at(F.filter("versions", valid), F.lit(-1))
    ).withColumns({c: F.col(f"version.{c}") for c in ("expected", "critical_names", "declared_critical")})
    actual_names = F.transform("columns", lambda c: c["name"])
    expected_names = F.transform("expected", lambda c: c["name"])

    def actual(c: Column) -> Column:
        # the first of them where a file repeats a name
        return F.lower(F.get(F.filter("columns", lambda x: x["name"] == c["name"]), 0)["type"])

    def same_type(c: Column) -> Column:
        # an un-zoned timestamp holds the same instants under the pinned UTC session
        unzoned = F.lower(c["type"]).eqNullSafe("timestamp") & (actual(c) == "timestampntztype()")
        return paths.types_compatible(c["type"], actual(c)) | unzoned

    shared = F.filter("expected", lambda c: F.array_contains(actual_names, c["name"]))
    missing = F.array_sort(F.array_except(expected_names, actual_names))
    missing_critical = F.array_sort(F.array_intersect(missing, F.col("critical_names")))
    mismatches = F.transform(
        F.filter(shared, lambda c: ~same_type(c)),
        lambda c: F.struct(
            c["name"].alias("column"), F.lower(c["type"]).alias("expected"), actual(c).alias("actual")
        ),
    )
    unzoned_columns = F.transform(
        F.filter(shared, lambda c: actual(c) == "timestampntztype()"), lambda c: c["name"]
    )
    has_contract = F.col("expected").isNotNull()
    return joined.select(
        "service_type",
        "file_path",
        "file_name",
        "schema_hash",
        F.when(has_contract, "DIAGNOSED").otherwise("NO_EXPECTED_SCHEMA").alias("status"),
        F.size("columns").alias("actual_columns"),
        F.size("expected").alias("expected_columns"),
        missing.alias("missing_columns"),
        F.array_sort(F.array_except(actual_names, expected_names)).alias("extra_columns"),
        mismatches.alias("type_mismatches"),
        missing_critical.alias("missing_critical"),
        F.array_sort(F.array_intersect(missing, F.col("declared_critical"))).alias(
            "missing_declared_critical"
        ),
        unzoned_columns.alias("unzoned_timestamps"),
        F.col("version.valid_from").alias("contract_version"),
    ).select(
        "*",
        F.coalesce((F.size("missing_columns") > 0) | (F.size("type_mismatches") > 0), F.lit(False)).alias(
            "has_issues"
        ),
        F.coalesce(F.size("missing_critical") == 0, F.lit(True)).alias("is_recoverable"),
    )
