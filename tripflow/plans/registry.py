"""The engine's queries over one folder of driver tables, by name.

Every query derives its trips from the whole lineitem and orders tables (see `sources.fixture`) and
runs the library's own operators on them. Run-dependent values (process id, times) are fixed here
so that results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..config import Settings, Thresholds
from ..functions import paths
from ..functions.amounts import exact_sum
from ..operators import conform, diagnose, enrich, marts, quality
from ..session import adopt
from ..sources import feeds, files, fixture
from ..sources.layers import commit_run, read_layer, write_layer
from . import pipeline, publish, reports

Query = Callable[[SparkSession, str], DataFrame]

LIMITS = Thresholds()
RULES = quality.rejection_rules(LIMITS)
RUN = "ETL-20240101-000000-0000ABCD"


def _at() -> Column:
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


class Flow:
    """The trips of one table folder at each stage, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = adopt(spark), sf_dir

    def bronze(self) -> DataFrame:
        return fixture.trips(self.spark, self.sf_dir)

    def keyed(self) -> DataFrame:
        return enrich.normalize(self.bronze())

    def silver(self) -> DataFrame:
        return enrich.to_silver(self.bronze(), LIMITS, F.lit("2024-01-01").cast("date"))

    def counted(self) -> DataFrame:
        """Silver with the copies of each trip, in one pass."""
        return enrich.to_silver_with_copies(self.bronze(), LIMITS, F.lit("2024-01-01").cast("date"))

    def metrics_of(self, *columns: str) -> DataFrame:
        """Derived columns of every input trip, without deduplication."""
        return enrich.with_metrics(self.keyed(), LIMITS).select("trip_id", *columns)

    def with_stored_silver(self) -> Flow:
        """This flow with silver written once, by period; what follows reads it."""
        target, flow = scratch(self.spark, "silver"), Flow(self.spark, self.sf_dir)
        records = fixture.line_count(self.spark, self.sf_dir)
        silver = enrich.to_silver(self.bronze(), LIMITS, F.lit("2024-01-01").cast("date"), records)
        write_layer(silver, target, ("service_type", "year", "month"), sort_by=("pickup_datetime",))
        flow.silver = lambda: self.spark.read.schema(self.silver().schema).parquet(target)
        return flow

    def valid(self) -> DataFrame:
        return quality.valid_trips(self.silver(), RULES)

    def gold(self) -> DataFrame:
        return marts.gold_trips_clean(self.valid())

    def evidence(self) -> DataFrame:
        return quality.rejected_records(self.silver(), RULES, RUN, _at())

    def quality(self) -> DataFrame:
        return quality.quality_metrics(self.silver(), RULES, RUN, _at())

    def inventory(self) -> DataFrame:
        """Inventory of the table folder itself."""
        footers = files.scan_footers(files.listing(self.spark, self.sf_dir))
        return files.audit(footers, RUN, _at())

    def report(self, name: str) -> DataFrame:
        """A named report, with only the tables it needs."""
        build = {
            "gold_trips_clean": self.gold,
            "gold_daily_revenue": lambda: marts.gold_daily_revenue(self.valid()),
            "gold_location_performance": lambda: marts.gold_location_performance(self.valid()),
            "quality_rejected_records": self.evidence,
            "quality_metrics_summary": self.quality,
            "audit_file_inventory": self.inventory,
        }
        return reports.report(name, {t: build[t]() for t in reports.needs(name)})


# ---------------------------------------------------------------- files derived from the tables

_raw_roots: dict[tuple[str, str], str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that every executor sees: below spark.checkpoint.dir, or the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tripflow/{name}-{uuid4().hex[:12]}"


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    """Raw feed files over the tables' trips, written once per session and table folder.

    One folder per feed and delivery month under the feed's own names; the last year of green lacks
    its total (not recoverable), yellow of 2024 comes with another vendor type, without the
    airport fee and with an unknown column (recoverable), and two files are not Parquet at all.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _raw_roots:
        return _raw_roots[key]
    root, stored = scratch(spark, "raw"), scratch(spark, "lines")
    # joined and laid out once, as narrow as they are; every feed is then written from that without a shuffle
    lines = fixture.lines_with_orders(spark, sf_dir, by_delivery=True)
    write_layer(lines, stored, ("service_type", "source_file"))
    bronze = fixture.derive(spark.read.schema(lines.schema).parquet(stored))
    delivered = {
        "year": F.regexp_extract("source_file", r"_(\d{4})-\d{2}\.", 1),
        "month": F.regexp_extract("source_file", r"-(\d{2})\.", 1),
    }
    for service in C.SERVICES:
        feed = fixture.raw_feed(bronze, service).withColumns(delivered).drop("source_file", "ingestion_timestamp")
        drifted = F.col("year") == {"green": "2025", "yellow": "2024"}.get(service, "none")
        write_layer(feed.filter(~drifted), f"{root}/{service}", ("year", "month"))
        late = feed.filter(drifted)
        if service == "green":
            write_layer(late.drop("total_amount"), f"{root}/drift/green", ("year", "month"))
        elif service == "yellow":
            late = late.withColumn("VendorID", F.col("VendorID").cast("int")).drop("Airport_fee")
            write_layer(late.withColumn("cbd_fee", F.lit(0.75)), f"{root}/drift/yellow", ("year", "month"))
    files.write_bytes(f"{root}/bad_parquet/wrong_magic.parquet", b"not a parquet file " * 20)
    files.write_bytes(f"{root}/bad_parquet/empty.parquet", b"")
    _raw_roots[key] = root
    return root


_inventories: dict[tuple[str, str], str] = {}


def _raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory of the raw files, taken once per session and table folder."""
    adopt(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _inventories:
        rows, path = files.inventory(spark, raw_files(spark, sf_dir), RUN, processed_at=_at()), scratch(spark, "inventory")
        rows.write.parquet(path)
        _inventories[key] = path
    return spark.read.parquet(_inventories[key])


def _diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw_inventory(spark, sf_dir).filter("ingested")
    return diagnose.diagnose(rows, diagnose.contract_fields(spark))


def _joined(column: str) -> Column:
    return F.array_join(column, ",").alias(column)


def _by_delivery(diagnosis: DataFrame, *columns: str | Column) -> DataFrame:
    """A diagnosis per feed and delivery month; the files of one month share one schema here."""
    path = F.col("file_path")
    return diagnosis.select(
        "service_type",
        paths.partition_value(path, "year").alias("partition_year"),
        paths.partition_value(path, "month").alias("partition_month"),
        *columns,
    ).distinct()


def schema_diagnosis(spark, sf_dir):
    mismatches = F.transform("type_mismatches", lambda m: F.concat_ws(" ", m["column"], m["expected"], m["actual"]))
    return _by_delivery(
        _diagnosis(spark, sf_dir),
        "status", "actual_columns", "expected_columns", _joined("missing_columns"), _joined("extra_columns"),
        F.array_join(mismatches, ",").alias("type_mismatches"), _joined("missing_critical"),
        "has_issues", "is_recoverable",
    )


def versioned_diagnosis(spark, sf_dir):
    """The diagnosis with a second version of one contract, from a document, valid from a delivery month on."""
    late = [f for f in C.feed_contract("yellow") if f["name"] != "Airport_fee"]
    fields = [(f["name"], "integer" if f["name"] == "VendorID" else f["type"], f["critical"]) for f in late] + [("cbd_fee", "double", False)]
    mapping = {f["name"]: f["canonical"] for f in late if f["canonical"]}
    folder = scratch(spark, "contracts")
    spark.createDataFrame([("yellow", "2024-01", None, fields, mapping)], diagnose.DOCUMENT_DDL).coalesce(1).write.json(folder)
    found = diagnose.diagnose(_raw_inventory(spark, sf_dir).filter("ingested"), diagnose.contract_registry(spark, folder))
    return _by_delivery(found, "contract_version", "expected_columns", _joined("missing_columns"), _joined("extra_columns"), "has_issues", "is_recoverable")


def contract_fields(spark, sf_dir):
    """Each contract column with the files and records that delivered it."""
    contracts = diagnose.contract_fields(spark)
    delivered = (
        _raw_inventory(spark, sf_dir)
        .filter("ingested")
        .select("service_type", "record_count", F.explode("columns").alias("c"))
        .groupBy("service_type", F.col("c.name").alias("name"))
        .agg(F.sum("record_count").alias("records"))
    )
    return contracts.join(delivered, ["service_type", "name"], "left").withColumn(
        "records", F.coalesce("records", F.lit(0))
    )


def mapping_matrix(spark, sf_dir):
    """The mapping matrix, of the columns that arrived in some file."""
    return diagnose.mapping_matrix(contract_fields(spark, sf_dir).filter("records > 0"))


def schema_quarantine(spark, sf_dir):
    evidence = files.schema_quarantine(_diagnosis(spark, sf_dir), _at())
    return _by_delivery(evidence, _joined("missing_critical"), "quarantine_reason", "stage", "quarantine_timestamp")


# How many files a delivery has, their sizes and a reader's own words depend on the writer and are left to tests; the
# queries below return what follows from the trips.


def file_quarantine(spark, sf_dir):
    evidence = files.file_quarantine(_raw_inventory(spark, sf_dir), _at())
    return evidence.select(
        "process_id", "file_name", "service_type", "read_status", "record_count", "quarantine_timestamp",
        "quarantine_stage", "recommended_action", "is_recoverable",
    )


def _inventory_report(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reports.report(name, {"audit_file_inventory": _raw_inventory(spark, sf_dir)})


def inventory_listing(spark, sf_dir):
    """The listing by delivery: the records of a month's files, which share status and columns."""
    delivery = ("service_type", "read_status", "column_count", "partition_year", "partition_month")
    return _inventory_report(spark, sf_dir, "inventory_listing").groupBy(*delivery).agg(F.sum("record_count").alias("records"))


def _bronze_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = _raw_inventory(spark, sf_dir).filter("ingested")
    found = diagnose.diagnose(inventory, diagnose.contract_fields(spark)).filter("is_recoverable")
    usable = inventory.join(found.select("file_path"), "file_path", "left_semi")
    bronze, _ = feeds.conform_groups(feeds.feed_groups(spark, usable, _raw_inventory(spark, sf_dir)), _at())
    return bronze


_runs: dict[tuple[str, str], tuple[Settings, pipeline.Run]] = {}


def _finished_run(spark: SparkSession, sf_dir: str) -> tuple[Settings, pipeline.Run]:
    """A whole run over the raw files, done once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _runs:
        return _runs[key]
    settings = Settings(
        root=scratch(spark, "lake"), raw_dir=raw_files(spark, sf_dir), database=f"tripflow_{uuid4().hex[:12]}"
    )
    _runs[key] = settings, pipeline.run(spark, settings, process_id=RUN)
    return _runs[key]


def incremental_run(spark, sf_dir):
    """Two incremental runs into one lake, the first over one feed only: which run took which delivery."""
    lake = {"root": scratch(spark, "incremental"), "database": f"tripflow_{uuid4().hex[:12]}", "incremental": True}
    root = raw_files(spark, sf_dir)
    for process_id, raw_dir in (("ETL-A", f"{root}/yellow"), ("ETL-B", root)):
        settings = Settings(raw_dir=raw_dir, **lake)
        pipeline.run(spark, settings, end=4, process_id=process_id)
    taken = read_layer(spark, settings.layer("audit", "ledger")).groupBy(
        "process_id", "service_type", "partition_year", "partition_month"
    ).agg(F.sum("record_count").alias("records"))
    bronze = read_layer(spark, settings.layer("bronze"), merge_schema=True)
    arrived = bronze.groupBy("service_type").agg(F.count("*").alias("bronze_of_service"))
    return taken.join(arrived, "service_type")


def manifest_files(spark, sf_dir):
    """Trips' file names as deliveries, by odd and even line, against a manifest of the months of three years."""
    trips = Flow(spark, sf_dir).bronze()
    delivered = trips.select(F.col("source_file").alias("file_name"), F.col("payment_type") % 2).distinct()
    months = spark.range(36).select(F.date_format(F.add_months(F.lit("2017-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM").alias("month"))
    services = trips.select("service_type").distinct()
    expected = services.join(months, F.length("service_type") > 0).select(F.concat("service_type", F.lit("_tripdata_"), "month", F.lit(".parquet")).alias("file_name"))
    return files.compare_manifest(expected, delivered)


def schema_versions(spark, sf_dir):
    """Schema hashes and records of each feed's readable files."""
    return (
        _raw_inventory(spark, sf_dir).filter("ingested").groupBy("service_type")
        .agg(F.count_distinct("schema_hash").alias("versions"), F.sum("record_count").alias("records"))
    )


def file_contents(spark, sf_dir):
    """Per feed: whether all bytes could be read, no two files hold the same, and sizes were measured; and the records."""
    readable = _raw_inventory(spark, sf_dir).filter("ingested").select("service_type", "file_path", "record_count", "file_size_mb")
    hashes = files.file_hashes(readable)
    return readable.join(hashes, "file_path").groupBy("service_type").agg(
        F.every(F.col("file_hash") != "UNREADABLE").alias("all_readable"),
        (F.count_distinct("file_hash") == F.count("*")).alias("all_different"),
        F.every(F.col("file_size_mb") >= 0).alias("measured"),
        F.sum("record_count").alias("records"),
    )


def inventory_load(spark, sf_dir):
    """Inventory records as text, some of them unreadable, loaded twice under one run."""
    counted = Flow(spark, sf_dir).bronze().groupBy("source_file").agg(F.count("*").alias("n"), F.max("pickup_datetime").alias("last"))
    odd = F.col("n") % 3 == 0
    records = counted.select(
        F.col("source_file").alias("file_name"), F.when(odd, "many").otherwise(F.col("n").cast("string")).alias("record_count"),
        F.when(odd, "later").otherwise(F.col("last").cast("string")).alias("processed_at"), F.lit("19").alias("column_count"),
    )
    table = f"inventory_{uuid4().hex[:12]}"
    publish.create_table(spark, table, "audit_file_inventory", scratch(spark, "inventory"))
    for _ in range(2):
        publish.load_inventory(spark, records, table, "ETL-A")
    return spark.table(table).select("process_id", "file_name", "record_count", "column_count", "processed_at")


def merged_unique_trips(spark, sf_dir):
    """Distinct trips from sketches of two overlapping runs, beside the exact number: their error stays in its bound."""
    flow = Flow(spark, sf_dir).with_stored_silver()
    path, period = scratch(spark, "sketches"), ["service_type", "year", "month"]
    for process_id, part in (("ETL-A", "payment_type <= 4"), ("ETL-B", "payment_type >= 3")):
        commit_run(reports.trip_sketches(flow.gold().where(part)), path, process_id)
    merged = reports.merged_unique_trips(read_layer(spark, path)).withColumnRenamed("unique_trips", "estimate")
    exact = reports.unique_trips(flow.gold())
    off = F.abs(F.col("estimate") - F.col("unique_trips"))
    return exact.join(merged, period).select(*period, "unique_trips", (off <= 1 + F.col("unique_trips") * 0.05).alias("within_bound"))


# ---------------------------------------------------------------- query bodies

def file_inventory(spark, sf_dir):
    rows = Flow(spark, sf_dir).inventory()
    return rows.select("file_name", "service_type", "read_status", "record_count", "column_count")


def file_row_counts(spark, sf_dir):
    return (
        _raw_inventory(spark, sf_dir)
        .groupBy("service_type", "partition_year", "partition_month", "read_status")
        .agg(F.sum("record_count").alias("records"), F.max("column_count").alias("column_count"))
    )


def schema_hash(spark, sf_dir):
    adopt(spark)
    return files.scan_footers(files.listing(spark, sf_dir)).select(
        paths.file_name(F.col("file_path")).alias("file_name"), "schema_hash"
    )


def file_hash(spark, sf_dir):
    adopt(spark)
    return files.file_hashes(files.listing(spark, sf_dir)).select(
        paths.file_name(F.col("file_path")).alias("file_name"), "file_hash"
    )


def deep_validate(spark, sf_dir):
    rows = Flow(spark, sf_dir).inventory()
    return files.deep_validate(rows).select(
        paths.file_name(F.col("file_path")).alias("file_name"), "decoded_rows", "decode_status"
    )


def _sample_paths(flow: Flow) -> DataFrame:
    """A file path per trip, in the layouts the path rules tell apart."""
    period = F.regexp_extract("source_file", r"_(\d{4}-\d{2})\.", 1)
    year, month = F.substring(period, 1, 4), F.substring(period, 6, 2)
    hive = F.concat(
        F.lit("/raw/"), "service_type", F.lit("/year="), year, F.lit("/month="), month, F.lit("/part-0.parquet")
    )
    path = (
        F.when(F.col("payment_type") == 1, hive)
        .when(F.col("payment_type") == 2, F.concat(F.lit("/raw/"), "source_file"))
        .when(F.col("payment_type") == 3, F.concat(F.lit("/raw/bad_parquet/x-"), period, F.lit(".parquet")))
        .when(F.col("payment_type") == 4, F.concat(F.lit("/raw/misc/FHVHV-"), period, F.lit(".parquet")))
        .when(F.col("payment_type") == 5, F.concat(F.lit("/raw/misc/trips-"), year, F.lit("-1.parquet")))
        .otherwise(F.concat(F.lit("/raw/misc/"), month, F.lit(".parquet")))
    )
    return flow.bronze().select(path.alias("file_path"))


def detect_service(spark, sf_dir):
    found = _sample_paths(Flow(spark, sf_dir)).groupBy("file_path").agg(F.count("*").alias("trips"))
    return found.withColumn("service_type", paths.detect_service(F.col("file_path")))


def partition_from_path(spark, sf_dir):
    found = _sample_paths(Flow(spark, sf_dir)).groupBy("file_path").agg(F.count("*").alias("trips"))
    path = F.col("file_path")
    return found.withColumns(
        {
            "partition_year": paths.partition_value(path, "year"),
            "partition_month": paths.partition_value(path, "month"),
        }
    )


def classify_read_error(spark, sf_dir):
    adopt(spark)
    status = paths.classify_read_error(F.col("text"))
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        status.alias("read_status"),
        paths.is_recoverable(status).alias("is_recoverable"),
        paths.recommended_action(status).alias("recommended_action"),
    )


def type_compat(spark, sf_dir):
    adopt(spark)
    expected = F.array(*[F.lit(t) for t in ("long", "double", "string", "timestamp", "integer", "boolean", "date")])
    actual = F.array(
        *[F.lit(t) for t in ("bigint", "Float", "varchar", "datetime", "int32", "bool", "decimal(10,2)", "date")]
    )
    pairs = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.element_at(expected, F.col("l_linenumber")).alias("expected"),
        F.element_at(actual, (F.col("l_suppkey") % 8 + 1).cast("int")).alias("actual"),
    )
    return (
        pairs.groupBy("expected", "actual")
        .agg(F.count("*").alias("pairs"))
        .withColumn("compatible", paths.types_compatible(F.col("expected"), F.col("actual")))
    )


def _conformed(service: str) -> Query:
    def body(spark, sf_dir):
        raw = fixture.raw_feed(Flow(spark, sf_dir).bronze(), service)
        return conform.conform(raw, service, F.col("source_file"), F.col("ingestion_timestamp"))

    return body


def fhvhv_total(spark, sf_dir):
    raw = fixture.raw_feed(Flow(spark, sf_dir).bronze(), "fhvhv")
    return raw.select(
        "source_file", "pickup_datetime", "base_passenger_fare",
        conform.derived_total(raw, "fhvhv").alias("total_amount"),
    )


def safe_cast(spark, sf_dir):
    """A yellow feed delivered as text, with words where numbers and times belong."""
    raw = fixture.raw_feed(Flow(spark, sf_dir).bronze(), "yellow")
    spoiled = F.col("payment_type") == 3
    as_text = raw.select(
        *[F.col(s["name"]).cast("string").alias(s["name"]) for s in C.feed_contract("yellow")],
        "source_file", "ingestion_timestamp",
    ).withColumns(
        {
            "fare_amount": F.when(spoiled, "n/a").otherwise(F.col("fare_amount").cast("string")),
            "PULocationID": F.when(spoiled, "zone").otherwise(F.col("PULocationID").cast("string")),
            "tpep_dropoff_datetime": F.when(spoiled, "later").otherwise(
                F.col("tpep_dropoff_datetime").cast("string")
            ),
        }
    )
    done = conform.conform(as_text, "yellow", F.col("source_file"), F.col("ingestion_timestamp"))
    return done.select(
        "source_file", "vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
        "payment_type", "fare_amount", "total_amount",
    )


def union_feeds(spark, sf_dir):
    flow = Flow(spark, sf_dir)
    bronze = flow.bronze()
    parts = [
        conform.conform(fixture.raw_feed(bronze, s), s, F.col("source_file"), F.col("ingestion_timestamp"))
        for s in C.SERVICES
    ]
    return (
        conform.union_feeds(parts)
        .groupBy("service_type", "year", "month")
        .agg(
            F.count("*").alias("trips"),
            F.count("passenger_count").alias("with_passengers"),
            F.round(exact_sum("fare_amount"), 2).alias("fares"),
            F.round(exact_sum("tip_amount"), 2).alias("tips"),
        )
    )


def bronze_from_files(spark, sf_dir):
    return (
        _bronze_from_files(spark, sf_dir)
        .groupBy("service_type", "year", "month")
        .agg(
            F.count("*").alias("trips"),
            F.count("airport_fee").alias("with_airport_fee"),
            F.round(exact_sum("fare_amount"), 2).alias("fares"),
            F.round(exact_sum("total_amount"), 2).alias("totals"),
        )
    )


def idempotent_load(spark, sf_dir):
    """Two runs, one of them loaded twice: the table must hold each run once."""
    flow = Flow(spark, sf_dir)
    stored = scratch(spark, "rows")
    flow.evidence().drop("process_id").write.parquet(stored)
    rows = spark.read.parquet(stored)
    table = f"evidence_{uuid4().hex[:12]}"
    publish.create_table(spark, table, "quality_rejected_records", scratch(spark, "evidence"))
    for process_id in ("ETL-A", "ETL-B", "ETL-A"):
        publish.idempotent_load(spark, rows, table, process_id)
    return spark.table(table).groupBy("process_id", "rejection_rule_id").agg(F.count("*").alias("rows"))


def pruned_scan(spark, sf_dir):
    """Silver written by period, read back with a partition filter and three columns."""
    return (
        Flow(spark, sf_dir).with_stored_silver().silver()
        .filter((F.col("service_type") == "yellow") & (F.col("year") == 2023))
        .select("pickup_datetime", "total_amount", "trip_distance")
    )


def verification_report(spark, sf_dir):
    _, run = _finished_run(spark, sf_dir)
    return reports.verification_frame(spark, run.checks).drop("seconds")


def pipeline_revenue(spark, sf_dir):
    """Revenue by service after a whole run from raw files to published tables."""
    settings, _ = _finished_run(spark, sf_dir)
    return reports.report("v1_revenue_by_service", reports.catalog_tables(spark, settings.database))


def quality_metrics_join(spark, sf_dir):
    flow = Flow(spark, sf_dir).with_stored_silver()
    return quality.quality_metrics_from(flow.gold(), flow.evidence(), RUN, _at())


def final_stats(spark, sf_dir):
    return Flow(spark, sf_dir).with_stored_silver().report("final_stats")


def _rule_query(rule: quality.Rule) -> Query:
    def body(spark, sf_dir):
        return (
            Flow(spark, sf_dir)
            .evidence()
            .filter(F.col("rejection_rule_id") == rule.rule_id)
            .select("trip_id", "service_type", "source_file", "original_value")
        )

    return body


def _flag_query(rule: quality.Rule) -> Query:
    def body(spark, sf_dir):
        return quality.broken_by(Flow(spark, sf_dir).silver(), rule).select(
            "trip_id", "service_type", "is_suspicious_trip", F.col(rule.column).alias("flagged_value")
        )

    return body


def _opt_in_query(rule: quality.Rule) -> Query:
    def body(spark, sf_dir):
        evidence = quality.rejected_records(Flow(spark, sf_dir).silver(), (rule,), RUN, _at())
        return evidence.select("trip_id", "service_type", "rejection_rule", "original_value", "technical_reason")

    return body


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "file_inventory": file_inventory,
        "file_row_counts": file_row_counts,
        "schema_hash": schema_hash,
        "file_hash": file_hash,
        "deep_validate": deep_validate,
        "detect_service": detect_service,
        "partition_from_path": partition_from_path,
        "classify_read_error": classify_read_error,
        "type_compat": type_compat,
        "fhvhv_total": fhvhv_total,
        "safe_cast": safe_cast,
        "union_feeds": union_feeds,
        "bronze_from_files": bronze_from_files,
        "idempotent_load": idempotent_load,
        "pruned_scan": pruned_scan,
        "verification_report": verification_report,
        "pipeline_revenue": pipeline_revenue,
        "final_stats": final_stats,
        "incremental_run": incremental_run,
        "manifest_files": manifest_files,
        "schema_versions": schema_versions,
        "file_contents": file_contents,
        "inventory_load": inventory_load,
        "merged_unique_trips": merged_unique_trips,
    }
    found |= {f"conform_{s}": _conformed(s) for s in C.SERVICES}
    found |= {
        "contract_fields": contract_fields,
        "mapping_matrix": mapping_matrix,
        "schema_diagnosis": schema_diagnosis,
        "versioned_diagnosis": versioned_diagnosis,
        "schema_quarantine": schema_quarantine,
        "file_quarantine": file_quarantine,
        "v4_inventory_status": lambda s, d: _inventory_report(s, d, "v4_inventory_status").drop("files", "size_mb"),
        "inventory_by_status": lambda s, d: _inventory_report(s, d, "inventory_by_status").drop("files", "size_mb"),
        "problem_files": lambda s, d: _inventory_report(s, d, "problem_files").drop("error_message"),
        "inventory_listing": inventory_listing,
    }
    found |= {
        "trip_id": lambda s, d: Flow(s, d).keyed().select("trip_id", "service_type", "source_file"),
        "trip_duration": lambda s, d: Flow(s, d).metrics_of("trip_duration_minutes"),
        "average_speed": lambda s, d: Flow(s, d).metrics_of("average_speed_mph"),
        "fare_per_mile": lambda s, d: Flow(s, d).metrics_of("fare_per_mile"),
        "tip_percentage": lambda s, d: Flow(s, d).metrics_of("tip_percentage"),
        "airport_trips": lambda s, d: Flow(s, d).metrics_of("is_airport_trip").filter("is_airport_trip"),
        "suspicious_trips": lambda s, d: Flow(s, d).metrics_of("is_suspicious_trip").filter("is_suspicious_trip"),
        "partition_recompute": lambda s, d: enrich.recompute_partitions(Flow(s, d).bronze())
        .groupBy("source_file", "year", "month")
        .agg(F.count("*").alias("trips")),
        "normalize_amounts": lambda s, d: enrich.with_trip_id(enrich.normalize_amounts(Flow(s, d).bronze())).select(
            "trip_id", *C.OPTIONAL_AMOUNTS, "airport_fee"
        ),
        "normalize_strings": lambda s, d: enrich.normalize_strings(Flow(s, d).bronze())
        .groupBy("service_type", "store_and_fwd_flag", "quality_status")
        .agg(F.count("*").alias("trips")),
        "dedup_trips": lambda s, d: enrich.dedup_trips(Flow(s, d).keyed()).select(
            "trip_id", "trip_distance", "tip_amount", "tolls_amount", "payment_type", "total_amount"
        ),
        "dedup_stats": lambda s, d: enrich.dedup_stats(Flow(s, d).keyed()),
        "valid_trips": lambda s, d: Flow(s, d).valid().select("trip_id", "service_type", "quality_status"),
        "quality_status": lambda s, d: Flow(s, d)
        .valid()
        .groupBy("service_type", "is_suspicious_trip", "quality_status")
        .agg(F.count("*").alias("trips")),
        "rejected_records": lambda s, d: Flow(s, d).evidence(),
        "quality_metrics": lambda s, d: Flow(s, d).quality(),
        "quality_metrics_join": quality_metrics_join,
        "quality_metrics_by_period": lambda s, d: quality.quality_metrics_by_period(Flow(s, d).counted(), RULES),
        "survivors": lambda s, d: enrich.survivors(Flow(s, d).keyed()).select(
            "trip_id", "copies", "trip_distance", "tip_amount", "tolls_amount", "payment_type", "total_amount"
        ),
        "rejection_rate_gate": lambda s, d: quality.rejection_rate_gate(Flow(s, d).silver(), RULES, LIMITS),
        "gold_trips_clean": lambda s, d: Flow(s, d).gold(),
        "gold_daily_revenue": lambda s, d: marts.gold_daily_revenue(Flow(s, d).valid()),
        "gold_location_performance": lambda s, d: marts.gold_location_performance(Flow(s, d).valid()),
        "bronze_distribution": lambda s, d: reports.bronze_distribution(Flow(s, d).bronze()),
        "suspicious_profile": lambda s, d: reports.suspicious_profile(Flow(s, d).silver()),
        "suspicious_sample": lambda s, d: reports.suspicious_sample(Flow(s, d).silver()),
        "phase_counters": lambda s, d: reports.phase_counters(
            Flow(s, d).counted(), quality.is_rejected(RULES), quality.violations(RULES)
        ),
    }
    table_reports = (
        "v1_revenue_by_service", "v2_quality_by_period", "v3_top_routes", "v5_rejection_reasons", "v6_top_days",
        "v7_suspicious_rate", "v8_date_integrity", "rejection_reasons", "rejection_share", "top_routes_service",
        "monthly_service_stats", "unique_trips", "global_quality", "quality_by_service", "normal_vs_suspicious",
    )
    found |= {name: lambda s, d, n=name: Flow(s, d).report(n) for name in table_reports}
    found |= {f"reject_{r.rule_id.lower().replace('-', '_')}": _rule_query(r) for r in RULES}
    found |= {f"flag_{r.rule_id.lower().replace('-', '_')}": _flag_query(r) for r in quality.marking_rules(LIMITS)}
    checks = {"CFG-PAYMENT": "payment_type_check", "CFG-PASSENGERS": "passenger_count_check"}
    checks |= {f"CFG-MIN-{name.upper()}": f"minimum_{name}_check" for name in ("duration", "fare", "total", "distance")}
    found |= {checks[r.rule_id]: _opt_in_query(r) for r in quality.opt_in_rules(LIMITS)}
    return found
