"""Conformance of the three dialects, schema diagnosis and the path rules."""

import json

import pytest
from conftest import SF, one, rows
from pyspark.sql import functions as F

from tripflow import contracts as C
from tripflow.functions import paths
from tripflow.operators import conform, diagnose
from tripflow.sources import fixture


def conformed(df, service, file="f.parquet"):
    return conform.conform(df, service, F.lit(file), F.lit("2024-01-01").cast("timestamp"))


@pytest.fixture(scope="module")
def bronze(spark):
    return fixture.trips(spark, SF)


@pytest.mark.parametrize("service", C.SERVICES)
def test_round_trip_through_a_dialect(bronze, service):
    raw = fixture.raw_feed(bronze, service)
    assert [c for c in raw.columns][: len(C.feed_contract(service))] == [s["name"] for s in C.feed_contract(service)]
    done = conformed(raw, service)
    expected = [(f.name, f.dataType) for f in C.CANONICAL_SCHEMA if f.name != "trip_id"]
    assert [(f.name, f.dataType) for f in done.schema] == expected
    mapped = [c for c in C.source_names(service) if c not in ("airport_fee",)]
    original = bronze.filter(F.col("service_type") == service).select(*mapped)
    assert done.select(*mapped).exceptAll(original).count() == 0


def test_derived_total_with_and_without_bcf(spark):
    raw = spark.createDataFrame(
        [(10.0, 1.0, 0.5, None, 2.0, 1.0)], "base_passenger_fare double, tolls double, sales_tax double, airport_fee double, tips double, bcf double"
    ).withColumns({"pickup_datetime": F.lit(None).cast("timestamp"), "congestion_surcharge": F.lit(2.5)})
    assert one(conformed(raw, "fhvhv"), "total_amount") == 17.0
    assert one(conformed(raw.drop("bcf"), "fhvhv"), "total_amount") == 16.0
    assert one(conformed(raw.drop("bcf", "tips"), "fhvhv"), "total_amount") == 14.0


def test_values_that_cannot_be_cast_become_null(spark):
    raw = spark.createDataFrame([("x", "2023-01-05 10:00:00", "12.5", "1")], "VendorID string, tpep_pickup_datetime string, fare_amount string, RatecodeID string")
    row = conformed(raw.withColumn("total_amount", F.lit("n/a")), "yellow").first()
    assert (row.vendor_id, row.fare_amount, row.total_amount, row.rate_code_id, row.year) == ("x", 12.5, None, 1.0, 2023)


def test_names_match_without_case_and_canonical_names_pass(spark):
    raw = spark.createDataFrame([(1.25, 3.0, 7.0)], "airport_fee double, PASSENGER_COUNT double, ehail_fee double")
    row = conformed(raw, "yellow").first()
    assert (row.airport_fee, row.passenger_count, row.ehail_fee) == (1.25, 3.0, 7.0)


def test_unzoned_timestamps_are_utc(spark):
    raw = spark.sql("SELECT TIMESTAMP_NTZ'2023-05-05 10:00:00' AS tpep_pickup_datetime")
    assert str(one(conformed(raw, "yellow"), "pickup_datetime")) == "2023-05-05 10:00:00"


def test_union_fills_absent_columns(spark):
    both = conform.union_feeds([spark.sql("SELECT 1 AS a"), spark.sql("SELECT 2 AS a, 3 AS b")])
    assert sorted(rows(both), key=str) == [(1, None), (2, 3)]


# ------------------------------------------------------------------ diagnosis

FILES = "service_type string, file_path string, file_name string, schema_hash string, columns array<struct<name:string,type:string>>"


def file_row(service, columns, name="f"):
    return (service, f"/raw/{name}", name, "h", list(columns.items()))


def contract_types(service):
    spelled = {"long": "longtype()", "double": "doubletype()", "string": "stringtype()", "timestamp": "timestamptype()"}
    return {s["name"]: spelled[s["type"]] for s in C.feed_contract(service)}


def diagnosed(spark, *files):
    frame = diagnose.diagnose(spark.createDataFrame(list(files), FILES), diagnose.contract_fields(spark))
    return {r.file_name: r for r in frame.collect()}


def test_diagnosis(spark):
    exact = contract_types("yellow")
    drifted = {**exact, "VendorID": "integertype()", "cbd_fee": "doubletype()", "tpep_pickup_datetime": "timestampntztype()"}
    del drifted["Airport_fee"]
    lower = {("airport_fee" if k == "Airport_fee" else k): v for k, v in exact.items()}
    broken = {k: v for k, v in exact.items() if k not in ("fare_amount", "PULocationID")}
    no_total = {k: v for k, v in contract_types("fhvhv").items() if k != "trip_miles"}
    found = diagnosed(
        spark,
        file_row("yellow", exact, "exact"),
        file_row("yellow", drifted, "drifted"),
        file_row("yellow", lower, "lower"),
        file_row("yellow", broken, "broken"),
        file_row("fhvhv", no_total, "miles"),
        file_row("tram", {"a": "longtype()"}, "tram"),
    )
    assert (found["exact"].has_issues, found["exact"].is_recoverable, found["exact"].expected_columns) == (False, True, 19)
    d = found["drifted"]
    assert (d.missing_columns, d.extra_columns) == (["Airport_fee"], ["cbd_fee"])
    assert [tuple(m) for m in d.type_mismatches] == [("VendorID", "long", "integertype()")]
    assert (d.unzoned_timestamps, d.has_issues, d.is_recoverable) == (["tpep_pickup_datetime"], True, True)
    assert (found["lower"].missing_columns, found["lower"].extra_columns) == (["Airport_fee"], ["airport_fee"])
    assert (found["broken"].missing_critical, found["broken"].is_recoverable) == (["PULocationID", "fare_amount"], False)
    m = found["miles"]
    assert (m.is_recoverable, m.missing_critical, m.missing_declared_critical) == (True, [], ["trip_miles"])
    t = found["tram"]
    assert (t.status, t.has_issues, t.is_recoverable) == ("NO_EXPECTED_SCHEMA", False, True)


def test_an_extra_column_alone_is_no_issue(spark):
    found = diagnosed(spark, file_row("green", {**contract_types("green"), "x": "longtype()"}))
    assert (found["f"].has_issues, found["f"].extra_columns) == (False, ["x"])


def test_contract_documents(spark, tmp_path):
    document = {
        "fields": [{"name": "VendorID", "type": "long", "critical": False}, {"name": "fare_amount", "type": "double", "critical": True}, {"name": "x", "type": "string"}],
        "column_mapping_to_canonical": {"VendorID": "vendor_id", "fare_amount": "fare_amount"},
    }
    path = tmp_path / "yellow.json"
    path.write_text(json.dumps(document, indent=1))
    found = rows(diagnose.read_contract(spark, str(path), "yellow"), "name", "type", "canonical", "critical")
    assert found == [("VendorID", "long", "vendor_id", False), ("fare_amount", "double", "fare_amount", True), ("x", "string", None, False)]


def test_mapping_matrix(spark):
    matrix = {r.canonical: (r.yellow, r.green, r.fhvhv) for r in diagnose.mapping_matrix(diagnose.contract_fields(spark)).collect()}
    assert matrix["trip_distance"] == ("trip_distance", "trip_distance", "trip_miles")
    assert matrix["airport_fee"] == ("Airport_fee", None, "airport_fee")
    assert matrix["total_amount"] == ("total_amount", "total_amount", None)
    assert len(matrix) == 21


# ------------------------------------------------------------------ paths, messages, types

def evaluated(spark, values, build):
    frame = spark.createDataFrame([(v,) for v in values], "v string").select(build(F.col("v")))
    return [r[0] for r in frame.collect()]


def test_service_from_path(spark):
    cases = {
        "/raw/x/Yellow_2023.parquet": "yellow",
        "/raw/yellow/part.parquet": "yellow",
        "/raw/green/part.parquet": "green",
        "/raw/green/yellow.parquet": "yellow",
        "/raw/fhvhv/a.parquet": "fhvhv",
        "/raw/bad_parquet/a.parquet": "bad_parquet",
        "/raw/misc/bad.parquet": "bad_parquet",
        "/raw/misc/other.parquet": "unknown",
    }
    assert evaluated(spark, cases, paths.detect_service) == list(cases.values())


def test_partition_from_path(spark):
    cases = {
        "/raw/year=2023/month=01/a.parquet": ("2023", "01"),
        "/raw/year=2023/x_tripdata_2022-02.parquet": ("2023", "02"),
        "/raw/trips-2022-11.parquet": ("2022", "11"),
        "/raw/yellow_tripdata_2023-01.parquet": (None, "01"),
        "/raw/2023-1.parquet": ("2023", None),
        "/raw/none.parquet": (None, None),
    }
    years = evaluated(spark, cases, lambda p: paths.partition_value(p, "year"))
    months = evaluated(spark, cases, lambda p: paths.partition_value(p, "month"))
    assert list(zip(years, months)) == list(cases.values())


def test_error_classes_go_in_order(spark):
    cases = {
        "Parquet MAGIC NUMBER wrong, schema missing": "NOT_RECOVERABLE_CORRUPT_METADATA",
        "file is empty": "NOT_RECOVERABLE_EMPTY_FILE",
        "codec missing": "NOT_RECOVERABLE_UNSUPPORTED_FORMAT",
        "bad schema: cannot cast": "RECOVERABLE_SCHEMA_MISMATCH",
        "key not found": "RECOVERABLE_MISSING_COLUMNS",
        "cannot do it": "RECOVERABLE_TYPE_CASTING",
        "only partial": "PARTIALLY_RECOVERABLE",
        "boom": "NOT_RECOVERABLE_UNKNOWN",
    }
    assert evaluated(spark, cases, paths.classify_read_error) == list(cases.values())
    flags = evaluated(spark, cases.values(), paths.is_recoverable)
    assert flags == [False, False, False, True, True, True, True, False]


def test_actions_have_a_default(spark):
    found = evaluated(spark, ["SUCCESS", "NOT_RECOVERABLE_FILE_NOT_FOUND"], paths.recommended_action)
    assert found == [C.RECOMMENDED_ACTIONS["SUCCESS"], C.DEFAULT_ACTION]


def test_type_aliases(spark):
    pairs = [("long", "LongType()", True), ("double", "float", True), ("double", "longtype()", False), ("date", "date", True), ("integer", "bigint", False)]
    frame = spark.createDataFrame([p[:2] for p in pairs], "e string, a string")
    got = [r[0] for r in frame.select(paths.types_compatible(F.col("e"), F.col("a"))).collect()]
    assert got == [p[2] for p in pairs]


def test_a_contract_document_changes_a_run(spark, tmp_path):
    """A feed that renames a critical column from a month on is set aside, until a document of that version is named."""
    import json

    import pyarrow.parquet as pq
    from test_files import yellow

    from tripflow.config import Settings
    from tripflow.plans import pipeline

    for month, rename in (("2023-12", False), ("2024-01", True)):
        year, number = month.split("-")
        folder = tmp_path / "raw" / "yellow" / f"year={year}" / f"month={number}"
        folder.mkdir(parents=True)
        table = yellow(10)
        pq.write_table(table.rename_columns([{"fare_amount": "fare"}.get(c, c) if rename else c for c in table.column_names]), folder / f"yellow_tripdata_{month}.parquet")
    before = pipeline.run(spark, Settings(root=str(tmp_path)), end=2, process_id="ETL-1")
    assert before.phases["phase_2_3"]["bronze_records"] == 10
    fields = C.feed_contract("yellow")
    document = {
        "service_type": "yellow", "valid_from": "2024-01", "fields": [{"name": {"fare_amount": "fare"}.get(f["name"], f["name"]), "type": f["type"]} for f in fields],
        "column_mapping_to_canonical": {{"fare_amount": "fare"}.get(f["name"], f["name"]): f["canonical"] for f in fields if f["canonical"]},
    }
    (tmp_path / "contracts").mkdir()
    (tmp_path / "contracts" / "yellow_2024.json").write_text(json.dumps(document, indent=1))
    after = pipeline.run(spark, Settings(root=str(tmp_path), contracts=str(tmp_path / "contracts")), end=2, process_id="ETL-2")
    assert after.phases["phase_2_3"]["bronze_records"] == 20
    from tripflow.sources.layers import read_layer

    bronze = read_layer(spark, str(tmp_path / "bronze"))
    assert bronze.filter("fare_amount IS NULL").count() == 0
    found = read_layer(spark, str(tmp_path / "audit" / "diagnostics")).filter("process_id = 'ETL-2'")
    assert {r.file_name[-15:-8]: r.contract_version for r in found.collect()} == {"2023-12": None, "2024-01": "2024-01"}
