"""File audit on good, damaged and missing files."""

import hashlib
import json

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tripflow.config import ExpectedFile
from tripflow.sources import feeds, files


def yellow(n=200, **extra):
    stamp = pd.Timestamp("2023-01-05 10:00:00")
    columns = {
        "VendorID": pa.array([1] * n, pa.int64()),
        "tpep_pickup_datetime": pa.array([stamp] * n, pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([stamp + pd.Timedelta(minutes=30)] * n, pa.timestamp("us")),
        "trip_distance": pa.array([5.0] * n),
        "PULocationID": pa.array(range(1, n + 1), pa.int64()),
        "DOLocationID": pa.array([20] * n, pa.int64()),
        "fare_amount": pa.array([20.0] * n),
        "total_amount": pa.array([22.0] * n),
        "payment_type": pa.array([1] * n, pa.int64()),
        **extra,
    }
    return pa.table({k: v for k, v in columns.items() if v is not None})


@pytest.fixture
def raw(tmp_path):
    def put(path, table=None, content=None, **options):
        target = tmp_path / "raw" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        if table is not None:
            pq.write_table(table, target, **options)
        else:
            target.write_bytes(content)
        return target

    put("yellow/year=2023/month=01/yellow_tripdata_2023-01.parquet", yellow())
    put("green/green_tripdata_2023-02.parquet", yellow())
    put("bad_parquet/wrong_magic.parquet", content=b"text " * 100)
    whole = put("misc/other.parquet", yellow())
    put("bad_parquet/truncated.parquet", content=whole.read_bytes()[: whole.stat().st_size // 2])
    put("bad_parquet/empty.parquet", content=b"")
    put("yellow/nanos.parquet", yellow(request=pa.array([1] * 200, pa.timestamp("ns"))))
    put("yellow/with space.parquet", yellow())
    put("notes.txt", content=b"not listed")
    damaged = put("yellow/damaged_pages.parquet", yellow(5000), compression="none", use_dictionary=False)
    column = pq.ParquetFile(damaged).metadata.row_group(0).column(4)
    content = bytearray(damaged.read_bytes())
    content[column.data_page_offset : column.data_page_offset + 60] = b"\xff" * 60
    damaged.write_bytes(bytes(content))
    put.root = str(tmp_path / "raw")
    return put


def by_name(df):
    return {r.file_name: r for r in df.collect()}


def test_inventory(spark, raw):
    expected = (ExpectedFile("yellow", "yellow_tripdata_2023-01.parquet", "2023", "01"), ExpectedFile("fhvhv", "gone.parquet", "2023", "01"))
    found = by_name(files.inventory(spark, raw.root, "P", expected))
    assert len(found) == 10
    first = found["yellow_tripdata_2023-01.parquet"]
    assert (first.read_status, first.record_count, first.column_count, first.service_type) == ("SUCCESS", 200, 9, "yellow")
    assert (first.partition_year, first.partition_month, first.source_system, first.ingested) == ("2023", "01", "NYC_TLC", True)
    assert found["green_tripdata_2023-02.parquet"].partition_month == "02"
    for name in ("wrong_magic.parquet", "truncated.parquet"):
        bad = found[name]
        assert (bad.read_status, bad.record_count, bad.source_system) == ("NOT_RECOVERABLE_CORRUPT_METADATA", 0, "Apache_Parquet_Testing")
        assert bad.error_message and bad.schema_hash is None
    assert found["empty.parquet"].read_status == "NOT_RECOVERABLE_EMPTY_FILE"
    assert found["nanos.parquet"].read_status == "NOT_RECOVERABLE_UNSUPPORTED_FORMAT"
    assert (found["gone.parquet"].read_status, found["gone.parquet"].file_size_mb) == ("NOT_RECOVERABLE_FILE_NOT_FOUND", 0.0)
    assert (found["other.parquet"].read_status, found["other.parquet"].ingested) == ("SUCCESS", False)
    assert found["damaged_pages.parquet"].read_status == "SUCCESS"
    assert found["with space.parquet"].record_count == 200


def test_no_raw_folder(spark, tmp_path):
    found = files.inventory(spark, str(tmp_path / "none"), "P", (ExpectedFile("green", "a.parquet"),))
    assert rows(found, "file_name", "read_status") == [("a.parquet", "NOT_RECOVERABLE_FILE_NOT_FOUND")]


def test_schema_hash_equals_that_of_the_schema_spark_reads(spark, raw, tmp_path):
    spark.sql(
        "SELECT 1 AS a, 'x' AS b, TIMESTAMP'2023-01-01 00:00:00' AS c, DATE'2023-01-01' AS d, CAST(1 AS DECIMAL(9,2)) AS e, "
        "CAST(1 AS SMALLINT) AS f, true AS g, TIMESTAMP_NTZ'2023-01-01 00:00:00' AS h, CAST(1 AS FLOAT) AS i"
    ).coalesce(1).write.parquet(str(tmp_path / "spark"))
    scanned = files.scan_footers(files.listing(spark, raw.root + "/green", str(tmp_path / "spark"))).collect()
    assert len(scanned) == 2
    for r in scanned:
        schema = spark.read.parquet(r.file_path).schema
        assert r.schema_hash == hashlib.md5(json.dumps(schema.jsonValue(), sort_keys=True).encode()).hexdigest()


def test_file_hash(spark, raw):
    paths = [raw.root + "/bad_parquet/wrong_magic.parquet", raw.root + "/absent.parquet"]
    found = dict(rows(files.file_hashes(spark.createDataFrame([(p,) for p in paths], 'file_path STRING'))))
    assert found == {paths[0]: hashlib.md5(b"text " * 100).hexdigest(), paths[1]: "UNREADABLE"}


def test_deep_validation_finds_damaged_pages(spark, raw):
    inventory = files.inventory(spark, raw.root, "P")
    status = {r.file_path.rsplit("/", 1)[1]: r.decode_status for r in files.deep_validate(inventory).collect()}
    assert status["damaged_pages.parquet"] == "FAILED"
    assert status["yellow_tripdata_2023-01.parquet"] == "OK"
    assert "wrong_magic.parquet" not in status


def test_quarantine_evidence(spark, raw):
    found = by_name(files.file_quarantine(files.inventory(spark, raw.root, "P")))
    assert set(found) == {"wrong_magic.parquet", "truncated.parquet", "empty.parquet", "nanos.parquet"}
    assert found["empty.parquet"].quarantine_stage == "EXTRACTION"
    assert found["empty.parquet"].recommended_action.startswith("Verificar en fuente")
    assert found["empty.parquet"].is_recoverable is False


def test_feed_of_several_schemas(spark, tmp_path):
    root = tmp_path / "raw" / "yellow"
    root.mkdir(parents=True)
    pq.write_table(yellow(3), root / "a.parquet")
    pq.write_table(yellow(3), root / "b.parquet")
    pq.write_table(yellow(4, VendorID=pa.array([2] * 4, pa.int32()), extra=pa.array(["x"] * 4)), root / "c.parquet")
    pq.write_table(yellow(5, fare_amount=pa.array([[1.0]] * 5)), root / "d.parquet")
    inventory = files.inventory(spark, str(tmp_path / "raw"), "P").filter("ingested")
    groups = feeds.feed_groups(spark, inventory)
    assert sorted(g.files for g in groups) == [1, 1, 2]
    bronze, failed = feeds.conform_groups(groups)
    broken = spark.createDataFrame(failed, "service_type STRING, schema_hash STRING, reason STRING")
    assert rows(inventory.join(broken, ["service_type", "schema_hash"]), "file_name") == [("d.parquet",)]
    counts = dict(rows(bronze.groupBy("source_file").agg(F.count("*"))))
    assert counts == {"a.parquet": 3, "b.parquet": 3, "c.parquet": 4}
    assert rows(bronze.filter("vendor_id = '2'").agg(F.count("*"), F.count("extra_amount"))) == [(4, 0)]
