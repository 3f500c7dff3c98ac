"""Whole runs from files to tables, re-entry, idempotence and published tables."""

import time

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_files import yellow

from tripflow.config import ExpectedFile, Settings, load_settings
from tripflow.operators import quality
from tripflow.plans import pipeline, publish, reports
from tripflow.session import new_process_id
from tripflow.sources import files
from tripflow.sources.layers import read_layer

import pyarrow.parquet as pq


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    first = root / "raw/yellow/year=2023/month=01"
    first.mkdir(parents=True)
    table = yellow(200)
    pq.write_table(pa.concat_tables([table, table.slice(0, 10)]), first / "yellow_tripdata_2023-01.parquet")
    pq.write_table(yellow(5, fare_amount=pa.array([-1.0] * 5)), root / "raw/yellow/negative.parquet")
    pq.write_table(yellow(7, VendorID=pa.array([3] * 7, pa.int32()), cbd_fee=pa.array([0.5] * 7)), root / "raw/yellow/drifted.parquet")
    pq.write_table(yellow(9, fare_amount=None), root / "raw/yellow/missing_critical.parquet")
    pq.write_table(yellow(9, total_amount=pa.array([[1.0]] * 9)), root / "raw/yellow/list_total.parquet")
    files.write_bytes(str(root / "raw/bad_parquet/wrong.parquet"), b"x" * 300)
    settings = Settings(root=str(root), database="lake_db", expected_files=(ExpectedFile("fhvhv", "gone.parquet", "2023", "01"),))
    return settings, pipeline.run(spark, settings, process_id="ETL-20240101-000000-AAAAAAAA")


def test_counts_of_a_run(lake):
    _, run = lake
    assert run.status == "SUCCESS"
    assert run.phases["phase_1"]["inventory"] == 7
    bronze = run.phases["phase_2_3"]
    assert (bronze["bronze_records"], bronze["files_conformed"]) == (222, 3)
    silver = run.phases["phase_4"]
    assert (silver["records_in"], silver["records_out"], silver["duplicates_removed"]) == (222, 212, 10)
    gold = run.phases["phase_5_6"]
    assert (gold["valid_records"], gold["rejected_records"]) == (207, 5)
    assert run.phases["phase_7"] == {"queries_ok": 8, "queries_total": 8, "elapsed_sec": run.phases["phase_7"]["elapsed_sec"]}


def test_layers_and_evidence(spark, lake):
    settings, run = lake
    schemas = read_layer(spark, settings.layer("quarantine", "schemas"))
    found = {r.file_name: r for r in schemas.collect()}
    assert set(found) == {"missing_critical.parquet", "list_total.parquet"}
    assert found["list_total.parquet"].homologation_error
    assert found["missing_critical.parquet"].missing_critical == ["fare_amount"]
    unreadable = read_layer(spark, settings.layer("quarantine", "files"))
    assert {r.file_name for r in unreadable.collect()} == {"wrong.parquet", "gone.parquet"}
    assert read_layer(spark, settings.layer("silver")).count() == 212
    assert rows(read_layer(spark, settings.layer("audit", "run_metrics")).agg(F.count("*"))) == [(5,)]
    assert rows(read_layer(spark, settings.layer("audit", "verification")).filter("status = 'OK'").agg(F.sum("rows"))) != [(0,)]
    assert pipeline.latest_inventory(spark, settings).count() == 7


def test_valid_and_rejected_partition_silver(spark, lake):
    settings, _ = lake
    silver = read_layer(spark, settings.layer("silver"))
    kept = spark.table("lake_db.gold_trips_clean").select("trip_id")
    rejected = spark.table("lake_db.quality_rejected_records").select("trip_id").distinct()
    assert kept.intersect(rejected).count() == 0
    assert kept.union(rejected).exceptAll(silver.select("trip_id")).count() == 0
    assert kept.count() + rejected.count() == silver.count() == silver.select("trip_id").distinct().count()


def test_published_columns(spark, lake):
    for table, schema in reports.PUBLISHED_TABLES.items():
        assert set(spark.table(f"lake_db.{table}").columns) == set(schema.fieldNames())
    total = spark.table("lake_db.gold_daily_revenue").agg(F.sum("total_trips"), F.round(F.sum("total_revenue"), 2)).first()
    assert tuple(total) == (207, 207 * 22.0)


def test_rerun_with_the_same_id_changes_nothing(spark, lake):
    settings, run = lake
    tables = ("gold_trips_clean", "gold_daily_revenue", "quality_rejected_records", "quality_metrics_summary", "audit_file_inventory")
    before = {t: spark.table(f"lake_db.{t}").count() for t in tables}
    again = pipeline.run(spark, settings, process_id=run.process_id)
    assert again.status == "SUCCESS"
    assert {t: spark.table(f"lake_db.{t}").count() for t in tables} == before


def test_another_run_keeps_the_audit_of_the_first(spark, lake):
    settings, run = lake
    other = pipeline.run(spark, settings, start=5, process_id="ETL-20240102-000000-BBBBBBBB")
    assert set(other.phases) == {"phase_5_6", "phase_7"}
    per_run = spark.table("lake_db.quality_rejected_records").groupBy("process_id").count()
    assert dict(rows(per_run)) == {run.process_id: 5, other.process_id: 5}
    assert spark.table("lake_db.gold_trips_clean").count() == 207


def test_missing_layers_fail_and_leave_a_record(spark, tmp_path):
    settings = Settings(root=str(tmp_path))
    with pytest.raises(RuntimeError, match="no silver"):
        pipeline.run(spark, settings, start=5, process_id="ETL-X")
    assert rows(read_layer(spark, settings.layer("audit", "run_metrics")), "status") == [("FAILED",)]
    with pytest.raises(RuntimeError, match="bronze is empty"):
        pipeline.run(spark, settings, process_id="ETL-Y")
    with pytest.raises(RuntimeError, match="bronze is empty"):
        pipeline.run(spark, settings, start=2, end=2, process_id="ETL-Z")
    with pytest.raises(RuntimeError, match="no inventory"):
        pipeline.run(spark, Settings(root=str(tmp_path / "new")), start=2, end=2, process_id="ETL-Z")
    with pytest.raises(RuntimeError, match="no bronze"):
        pipeline.run(spark, Settings(root=str(tmp_path / "new")), start=4, end=4, process_id="ETL-Z")


def test_deep_validation_keeps_damaged_files_out(spark, tmp_path):
    root = tmp_path / "raw" / "yellow"
    root.mkdir(parents=True)
    pq.write_table(yellow(20), root / "good.parquet")
    pq.write_table(yellow(5000), root / "damaged.parquet", compression="none", use_dictionary=False)
    column = pq.ParquetFile(root / "damaged.parquet").metadata.row_group(0).column(4)
    content = bytearray((root / "damaged.parquet").read_bytes())
    content[column.data_page_offset : column.data_page_offset + 60] = b"\xff" * 60
    (root / "damaged.parquet").write_bytes(bytes(content))
    settings = Settings(root=str(tmp_path), deep_validate=True)
    run = pipeline.run(spark, settings, end=2)
    assert run.phases["phase_2_3"]["bronze_records"] == 20


def test_clustered_bronze_writes_few_files(spark, lake, tmp_path):
    settings, _ = lake
    clustered = Settings(root=str(tmp_path), raw_dir=settings.raw, cluster_bronze=True)
    pipeline.run(spark, clustered, end=2)
    assert len(list(tmp_path.glob("bronze/**/*.parquet"))) == 1


# ------------------------------------------------------------------ loads

def evidence(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("trip_id"), F.lit("yellow").alias("service_type"))


def test_load_replaces_only_its_run(spark):
    publish.create_table(spark, "default.k7", "quality_rejected_records")
    assert publish.idempotent_load(spark, evidence(spark, 3), "default.k7", "A") == 3
    assert publish.idempotent_load(spark, evidence(spark, 4), "default.k7", "B", {"source_file": "f"}) == 4
    assert publish.idempotent_load(spark, evidence(spark, 2), "default.k7", "A") == 2
    found = spark.table("default.k7").groupBy("process_id").agg(F.count("*"), F.count("source_file"), F.count("rejected_at"))
    assert sorted(rows(found)) == [("A", 2, 0, 0), ("B", 4, 4, 0)]
    with pytest.raises(ValueError, match="no column x"):
        publish.idempotent_load(spark, evidence(spark, 1).withColumn("x", F.lit(1)), "default.k7", "A")


@pytest.mark.parametrize("process_id", ["it's", "a\\b", "{rows}"])
def test_load_takes_any_run_name(spark, process_id):
    publish.create_table(spark, "default.k7_names", "quality_rejected_records")
    for n in (3, 2):
        assert publish.idempotent_load(spark, evidence(spark, n), "default.k7_names", process_id) == n
    assert spark.table("default.k7_names").where(F.col("process_id") == process_id).count() == 2


def test_failed_metrics_do_not_hide_the_error(spark, tmp_path, monkeypatch):
    def fail(*_):
        raise OSError("disk full")

    monkeypatch.setattr(pipeline, "_save_metrics", fail)
    with pytest.raises(Exception) as caught:
        pipeline.run(spark, Settings(root=str(tmp_path / "none"), database="no_db"), start=5)
    assert "disk full" not in str(caught.value) and any("disk full" in n for n in caught.value.__notes__)


def test_load_of_a_table_without_runs_replaces_it(spark, lake):
    settings, _ = lake
    publish.create_table(spark, "default.daily", "gold_daily_revenue")
    for _ in range(2):
        publish.load_directory(spark, settings.layer("gold", "daily"), "default.daily", "A")
    assert spark.table("default.daily").count() == spark.table("lake_db.gold_daily_revenue").count()


def test_inventory_records_as_text(spark):
    publish.create_table(spark, "default.inv", "audit_file_inventory")
    records = spark.createDataFrame(
        [("a", "12", "x", "1.5", "2024-01-01 00:00:00"), ("b", "many", "3", "big", "yesterday")],
        "file_name string, record_count string, column_count string, file_size_mb string, processed_at string",
    )
    assert publish.load_inventory(spark, records, "default.inv", "A") == 2
    found = sorted(rows(spark.table("default.inv"), "file_name", "record_count", "column_count", "file_size_mb", F.isnull("processed_at")))
    assert found == [("a", 12, 0, 1.5, False), ("b", 0, 3, 0.0, True)]


# ------------------------------------------------------------------ reports and settings

def test_a_broken_report_does_not_stop_the_rest(spark, lake):
    tables = reports.catalog_tables(spark, "lake_db")
    tables["gold_daily_revenue"] = spark.range(1)
    status = {c.name: c.status[:5] for c in reports.verify(tables)}
    assert status["v6_top_days"] == "ERROR" and status["v8_date_integrity"] == "OK" and len(status) == 8
    assert reports.verification_frame(spark, reports.verify(tables, ("v1_revenue_by_service",))).first().rows == 1


def test_a_slow_report_does_not_delay_the_others(spark, lake, monkeypatch):
    tables = reports.catalog_tables(spark, "lake_db")
    ended, sleeping = {}, __import__("threading").Event()

    def slow(df):
        sleeping.wait(60)
        return df.limit(1)

    def told(name, build):
        def run(df):
            ended[name] = time.monotonic()
            if len(ended) == 7:
                sleeping.set()  # the slow report ends only when all others have begun
            return build(df)

        return run

    for name in reports.VERIFICATION:
        table, build = reports.REPORTS[name]
        monkeypatch.setitem(reports.REPORTS, name, (table, slow if name == "v1_revenue_by_service" else told(name, build)))
    checks = reports.verify(tables)
    assert [c.name for c in checks] == list(reports.VERIFICATION) and {c.status for c in checks} == {"OK"} and sleeping.is_set()
    assert all(c.seconds > 0 for c in checks)


def test_ad_hoc_sql_and_approximate_counts(spark, lake):
    assert reports.query(spark, "SELECT COUNT(*) AS n FROM lake_db.gold_trips_clean").first().n == 207
    approx = reports.approximate_unique_trips(spark.table("lake_db.gold_trips_clean")).agg(F.sum("unique_trips")).first()[0]
    assert abs(approx - 207) <= 10


def test_settings_files(spark, tmp_path):
    path = tmp_path / "settings.json"
    path.write_text(
        '{"root": "/lake", "database": "d", "quality_rules": {"max_speed_mph": 80, "valid_payment_types": [1, 2]},'
        ' "data_sources": {"yellow": {"files": [{"name": "a.parquet", "year": "2023", "month": "01"}]}},'
        ' "bad_parquet_sources": {"files": ["b.parquet"]}, "opt_in_rules": ["CFG-PAYMENT"]}'
    )
    found = load_settings(spark, str(path))
    assert (found.thresholds.max_speed, found.thresholds.payment_types, found.thresholds.max_tip) == (80, (1, 2), 100)
    assert [e.service_type for e in found.expected_files] == ["yellow", "bad_parquet"]
    assert (found.raw, found.layer("gold", "trips"), found.database) == ("/lake/raw", "/lake/gold/trips", "d")
    assert [r.rule_id for r in quality.rejection_rules(found.thresholds, found.opt_in_rules)][-1] == "CFG-PAYMENT"


def test_process_ids():
    first, second = new_process_id(), new_process_id()
    assert first != second and len(first) == len("ETL-20240101-000000-AAAAAAAA") and first.startswith("ETL-")
