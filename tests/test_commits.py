"""Layers by version, loads that fail, feeds of very many files, and incremental runs."""

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from test_files import yellow

from tripflow.config import ExpectedFile, Settings
from tripflow.plans import pipeline, publish
from tripflow.sources import feeds, files
from tripflow.sources.layers import commit_layer, commit_run, commits, current, partition_folder, read_layer, write_layer

DDL = "service_type string, year int, n int"
BY = ("service_type", "year")


def frame(spark, *values):
    return spark.createDataFrame(list(values), DDL)


def held(spark, path, schema=None):
    found = read_layer(spark, path, schema=schema)
    return None if found is None else sorted(tuple(r) for r in found.select("service_type", "year", "n").collect())


def failing(df):
    """df, whose last rows cannot be made."""
    return df.withColumn("n", F.when(F.col("n") < 500, F.col("n")).otherwise(F.raise_error("lost in mid-write").cast("int")))


def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path):
    path, old = str(tmp_path / "layer"), [("green", 2023, 1), ("yellow", 2023, 2)]
    assert held(spark, path) is None and current(spark, path) is None
    commit_layer(frame(spark, *old), path, BY)
    many = spark.range(1000).select(F.lit("yellow").alias("service_type"), F.lit(2024).alias("year"), F.col("id").cast("int").alias("n")).repartition(8)
    with pytest.raises(Exception, match="lost in mid-write"):
        commit_layer(failing(many), path, BY)
    assert held(spark, path) == old and len(commits(spark, path)) == 1
    reader = read_layer(spark, path)  # planned before the next commit
    commit_layer(frame(spark, ("green", None, 5)), path, BY)
    assert held(spark, path) == [("green", None, 5)] and reader.count() == 2


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "layer")
    commit_layer(frame(spark, ("green", 2023, 1), ("yellow", 2023, 2), ("yellow", None, 3)), path, BY, by_partition=True)
    key = lambda s, y: partition_folder(service_type=s, year=y)
    assert set(current(spark, path)) == {key("green", 2023), key("yellow", 2023), key("yellow", None)}
    commit_layer(frame(spark, ("yellow", 2023, 9)), path, BY, by_partition=True, only={key("yellow", 2023), key("yellow", None)})
    assert held(spark, path) == [("green", 2023, 1), ("yellow", 2023, 9)]
    schema = read_layer(spark, path).schema
    commit_layer(frame(spark).where("false"), path, BY, by_partition=True, only={key("green", 2023)})
    assert held(spark, path) == [("yellow", 2023, 9)]
    commit_layer(frame(spark).where("false"), path, BY, by_partition=True)
    assert held(spark, path, schema) == []


def test_odd_run_names(spark, tmp_path):
    path = str(tmp_path / "audit")
    for name in ("a=b/c", "it's 100%", "ETL-1"):
        stored = commit_run(frame(spark, ("green", 1, 1)), path, name)
        assert rows(stored, "process_id", "n") == [(name, 1)]
    assert read_layer(spark, path).count() == 3


@pytest.mark.parametrize("like", ["quality_rejected_records", "gold_daily_revenue"])
def test_a_load_that_fails_changes_nothing(spark, like):
    table = f"default.failing_{like}"
    publish.create_table(spark, table, like)
    some = spark.range(3).select(F.lit("green").alias("service_type"))
    assert publish.idempotent_load(spark, some, table, "A") == 3
    broken = spark.range(100).select(F.when(F.col("id") < 50, "x").otherwise(F.raise_error("lost in mid-write")).alias("service_type"))
    with pytest.raises(Exception, match="lost in mid-write"):
        publish.idempotent_load(spark, broken, table, "A")
    assert spark.table(table).count() == 3
    assert publish.idempotent_load(spark, some.limit(1), table, "A") == 1 and spark.table(table).count() == 1


# ------------------------------------------------------------------ feeds


def test_five_thousand_files_reach_the_driver_as_folders(spark, tmp_path, monkeypatch):
    small = yellow(1)
    for month in range(1, 11):
        folder = tmp_path / "raw" / "yellow" / "year=2023" / f"month={month:02d}"
        folder.mkdir(parents=True)
        pq.write_table(small, folder / "f0.parquet")
        content = (folder / "f0.parquet").read_bytes()
        for i in range(1, 500):
            (folder / f"f{i}.parquet").write_bytes(content)
    mixed = tmp_path / "raw" / "yellow" / "mixed"
    mixed.mkdir()
    pq.write_table(small, mixed / "good.parquet")
    (mixed / "bad.parquet").write_bytes(b"no parquet")
    seen = []
    for name in ("collect", "toLocalIterator"):
        def counted(self, *args, method=getattr(DataFrame, name), **more):
            found = list(method(self, *args, **more))
            seen.append(len(found))
            return iter(found) if method.__name__ == "toLocalIterator" else found

        monkeypatch.setattr(DataFrame, name, counted)
    inventory = commit_run(files.inventory(spark, str(tmp_path / "raw"), "P"), str(tmp_path / "inventory"), "P")
    groups = feeds.feed_groups(spark, inventory.filter("ingested"), inventory)
    bronze, failed = feeds.conform_groups(groups)
    assert sum(seen) < 100 and not failed
    assert sorted((len(g.folders), g.files, g.records) for g in groups) == [(1, 1, 1), (10, 5000, 5000)]
    # a file that comes after the audit is not read
    pq.write_table(small, tmp_path / "raw" / "yellow" / "year=2023" / "month=01" / "late.parquet")
    assert bronze.count() == 5001
    assert feeds.conform_groups(feeds.feed_groups(spark, inventory.filter("ingested"), inventory))[0].count() == 5001


def test_folders_above_others_are_read_by_name(spark, tmp_path):
    root = tmp_path / "raw" / "green"
    (root / "below").mkdir(parents=True)
    pq.write_table(yellow(2), root / "green_a.parquet")
    pq.write_table(yellow(3, VendorID=None), root / "below" / "green_b.parquet")
    inventory = files.inventory(spark, str(tmp_path / "raw"), "P")
    groups = feeds.feed_groups(spark, inventory.filter("ingested"), inventory)
    assert sorted(g.frame.count() for g in groups) == sorted(g.records for g in groups) == [2, 3]


def test_manifest(spark, tmp_path):
    for folder in ("yellow/a", "yellow/b", "green"):
        (tmp_path / folder).mkdir(parents=True)
    for name in ("yellow/a/once.parquet", "yellow/a/twice.parquet", "yellow/b/twice.parquet", "green/extra.parquet"):
        pq.write_table(yellow(1), tmp_path / name)
    expected = tuple(ExpectedFile("yellow", n) for n in ("once.parquet", "twice.parquet", "gone.parquet"))
    delivered = files.listing(spark, str(tmp_path)).select(F.element_at(F.split("file_path", "/"), -1).alias("file_name"))
    found = files.compare_manifest(files.manifest(spark, str(tmp_path), expected), delivered)
    assert {tuple(r) for r in found.collect()} == {
        ("once.parquet", 1, 1, "EXPECTED"), ("twice.parquet", 1, 2, "REPEATED"), ("gone.parquet", 1, 0, "MISSING"), ("extra.parquet", 0, 1, "UNEXPECTED"),
    }
    assert files.compare_manifest(files.manifest(spark, str(tmp_path), ()), delivered.where("false")).count() == 0


# ------------------------------------------------------------------ incremental runs


@pytest.fixture
def lake(tmp_path):
    folder = tmp_path / "raw" / "yellow"
    folder.mkdir(parents=True)

    def put(name, n, **columns):
        pq.write_table(yellow(n, **columns), folder / name)

    put("a.parquet", 20)
    put("b.parquet", 30)
    return Settings(root=str(tmp_path), database=f"inc_{abs(hash(str(tmp_path))) % 10**8}", incremental=True), put


def counts(spark, settings, layer):
    return dict(rows(read_layer(spark, settings.layer(layer)).groupBy("source_file").agg(F.count("*"))))


def test_a_second_run_reads_only_new_files(spark, lake):
    settings, put = lake
    first = pipeline.run(spark, settings, process_id="ETL-1")
    assert first.phases["phase_2_3"]["files_conformed"] == 2
    put("c.parquet", 5)
    put("copy_of_a.parquet", 20)  # bytes that have been read
    second = pipeline.run(spark, settings, process_id="ETL-2")
    facts = second.phases["phase_2_3"]
    assert (facts["files_conformed"], facts["bronze_records"]) == (1, 5)
    assert counts(spark, settings, "bronze") == {"a.parquet": 20, "b.parquet": 30, "c.parquet": 5}
    everything = Settings(root=settings.root + "/whole", raw_dir=settings.raw, database=settings.database + "_whole")
    pipeline.run(spark, everything, process_id="ETL-3", end=4)
    whole = read_layer(spark, everything.layer("silver")).filter("source_file <> 'copy_of_a.parquet'").drop("ingestion_timestamp")
    silver = read_layer(spark, settings.layer("silver")).drop("ingestion_timestamp").select(whole.columns)
    assert silver.exceptAll(whole).count() == whole.exceptAll(silver).count() == 0
    assert spark.table(f"{settings.database}.gold_trips_clean").count() == silver.count()
    third = pipeline.run(spark, settings, process_id="ETL-4")
    assert third.phases["phase_2_3"]["files_conformed"] == 0 and "phase_4" not in third.phases and third.status == "SUCCESS"
    # bytes are hashed once for a path, size and time
    assert read_layer(spark, settings.layer("audit", "hashes")).groupBy("file_path").agg(F.count_distinct("file_hash").alias("n")).where("n > 1").count() == 0


def test_a_rerun_and_a_run_that_fails(spark, lake, monkeypatch):
    settings, put = lake
    pipeline.run(spark, settings, process_id="ETL-1", end=2)
    put("c.parquet", 5)
    real = pipeline.commit_layer
    monkeypatch.setattr(pipeline, "commit_layer", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        pipeline.run(spark, settings, process_id="ETL-2", end=2)
    monkeypatch.setattr(pipeline, "commit_layer", real)
    # the ledger of the failed run does not count; a later phase 2 starts from the latest inventory
    assert pipeline.run(spark, settings, start=2, end=2, process_id="ETL-3").phases["phase_2_3"]["files_conformed"] == 1
    assert pipeline.run(spark, settings, end=2, process_id="ETL-3").phases["phase_2_3"]["files_conformed"] == 1
    assert counts(spark, settings, "bronze") == {"a.parquet": 20, "b.parquet": 30, "c.parquet": 5}


def test_a_whole_load_starts_anew(spark, lake):
    settings, put = lake
    whole = Settings(root=settings.root, database=settings.database)
    pipeline.run(spark, whole, process_id="ETL-1", end=4)
    run = pipeline.run(spark, settings, process_id="ETL-2", end=4)
    assert run.phases["phase_2_3"]["files_conformed"] == 2 and run.phases["phase_4"]["records_in"] == 50
    assert counts(spark, settings, "bronze") == {"a.parquet": 20, "b.parquet": 30}


def test_counts_are_those_of_what_was_written(spark, lake):
    settings, _ = lake
    run = pipeline.run(spark, settings, process_id="ETL-1", end=6)
    silver = read_layer(spark, settings.layer("silver"))
    facts = run.phases["phase_4"]
    assert (facts["records_out"], facts["suspicious_trips"]) == (silver.count(), silver.filter("is_suspicious_trip").count())
    assert run.phases["phase_5_6"]["valid_records"] == read_layer(spark, settings.layer("gold", "trips")).count()


def test_a_file_that_changes_after_its_audit_ends_the_run(spark, lake):
    settings, put = lake
    inventory = pipeline.extract(spark, settings, "ETL-1")
    put("b.parquet", 31)
    with pytest.raises(Exception, match="changed since"):
        pipeline.to_bronze(spark, settings, inventory, "ETL-1")
    assert read_layer(spark, settings.layer("bronze")) is None


def test_plain_folders_are_layers_too(spark, tmp_path):
    write_layer(frame(spark, ("green", 2023, 1)), str(tmp_path / "plain"), BY)
    assert held(spark, str(tmp_path / "plain")) == [("green", 2023, 1)]
